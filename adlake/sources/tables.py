"""Table resolution (SC1) and small catalog probes (SC10).

Every relation is read lazily with ``spark.read.parquet`` so that Catalyst can
prune columns and push filters into the scan; nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """In whichever store the path is."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath))


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """``name.parquet`` (a file or folder) or else the folder ``name``."""
    single = f"{base.rstrip('/')}/{name}.parquet"
    return single if path_exists(spark, single) else f"{base.rstrip('/')}/{name}"


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Resolve a logical table name under ``base`` (a folder of parquet
    tables) to a lazy DataFrame."""
    return spark.read.parquet(table_path(spark, base, name))


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.base, name)

    def __getitem__(self, name: str) -> DataFrame:
        return load(self.spark, self.base, name)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """SC10: catalog table, or a folder that holds a readable table."""
    if "/" not in name_or_path and "\\" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    return path_exists(spark, name_or_path)
