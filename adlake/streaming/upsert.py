"""ST2: append ingestion with upsert by date: every micro-batch of landed files
replaces the table from its first day on (by scope value, if there is one)."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adlake.sources.sinks import replace_from
from adlake.sources.versioned import VersionedTable


def run_upsert_by_date(spark: SparkSession, source: str, schema: StructType, path: str, date_col: str, checkpoint: str,
                       scope: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] | None = None,
                       max_files: int = 1, available_now: bool = True) -> StreamingQuery:
    """``max_files`` files make a micro-batch, in the order they landed.  A
    batch that is run again after a failure gives the same table."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        replace_from(prepare(batch) if prepare else batch, path, date_col, scope=scope)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def run_versioned_upsert(spark: SparkSession, source: str, schema: StructType, path: str, date_col: str, checkpoint: str, name: str = "upsert",
                         scope: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] | None = None,
                         max_files: int = 1, available_now: bool = True) -> StreamingQuery:
    """The same on a `VersionedTable`: readers see a micro-batch whole or not
    at all, and a batch that is run again is skipped by its number, so rows
    dated before its start are added once, too.  ``name`` tells streams into
    one table apart."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        VersionedTable(spark, path).replace_from(prepare(batch) if prepare else batch, date_col, scope=scope, batch=(name, batch_id))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
