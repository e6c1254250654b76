"""adlake: marketing and operations analytics as Spark DataFrame plans.

Layout
------
sources/    table resolver, file readers (CSV, JSON) and partition-aware sinks
functions/  Column-level helpers (Sunday weeks, NULL-safe maths, text parsing)
operators/  DataFrame -> DataFrame relational building blocks
plans/      composite data products (marts) and the query catalog
timeseries/ many-series rolling stats, decomposition, ACF/PACF, ADF, ARIMA
ml/         feature engineering and Spark ML tree pipelines
streaming/  Structured Streaming variants of the alert and ingestion jobs
"""

from adlake.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
