"""Encodings and imputation for model features (SF25, ML1, ML3).

Category domains are small by nature (a categorical column); where a domain
is computed from the data it is a distinct aggregate, never a collect of rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.reshape import global_rank


def category_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """pandas ``astype('category').cat.codes``: 0-based code in sorted order
    of the distinct non-NULL values; NULL -> -1.  The distinct values are
    ranked by ranges, then joined back."""
    cats = df.where(F.col(col).isNotNull()).select(F.col(col).alias("_v")).distinct()
    codes = global_rank(cats, "_v", "_code").withColumn("_code", F.col("_code").cast("int"))
    j = df.join(codes, df[col] == codes["_v"], "left")
    return j.withColumn(out, F.coalesce(F.col("_code"), F.lit(-1))).drop("_v", "_code")


def dummies(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """``get_dummies`` over a known domain: one 0/1 int column per value
    (NULL input -> NULL indicators)."""
    p = prefix or col
    return df.select("*", *[(F.col(col) == v).cast("int").alias(f"{p}_{v}") for v in values])


def impute_with_mode(df: DataFrame, col: str) -> DataFrame:
    """Fill NULLs with the most frequent value (ties: greatest value).  The
    mode is a scalar subquery over a partial aggregate; nothing is collected
    to the driver."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
    mode = counts.agg(F.max(F.struct("_n", col))[col].alias("_mode"))
    return df.withColumn(col, F.coalesce(F.col(col), mode.scalar()))
