"""SparkSession construction, the shared scratch folder and lineage cuts.

The library never hard-codes cluster settings: on a cluster the session is
built by the platform and `get_spark` only fills in values that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only when the session does not define them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "adlake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared file system; it is an error
    if it does not, as a folder of one machine would lose the rows that other
    executors write.  A scratch folder is made for a local master alone.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="adlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/adlake/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Evaluate ``df`` once into the shared folder and read it back: lineage
    ends there, and no executor that is lost takes rows with it."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """`materialise`, and what was shuffled for it leaves the disks at once, not when
    the driver next collects its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return materialise(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
