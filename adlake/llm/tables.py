"""Reading the given tables and writing intermediate ones to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import checkpoint_dir


def own_columns(df: DataFrame, *without: str) -> list[Column]:
    """All columns of `df` by their exact names, but those of `without`."""
    return [F.col(f"`{c}`") for c in df.columns if c not in without]


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it (names
    that differ in case alone are one)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of 8 MB where the session has Spark's
    default of 64 MB: a batch is held several times over, by every task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "67108864b").rstrip("b") or 0) == 64 << 20:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/adlake-llm/{name}-{uuid.uuid4().hex}"


ROWS_PER_FILE = 50_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it again: lineage
    ends there and any executor can be lost afterwards.

    `rows`, a bound of the rows where one is known, keeps a small table from
    becoming as many files as there are shuffle partitions; a table of more
    rows than partitions x ROWS_PER_FILE is written by all of them."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if rows is not None:
        df = df.coalesce(rows // ROWS_PER_FILE + 1)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILTER_BUCKETS = 1 << 20


def maybe_in(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose hash `key` (long) may be among `keys`, before a join that
    would shuffle them all: a semi-join with the remainders of the keys, a
    broadcast of at most FILTER_BUCKETS numbers however many keys there are.
    With very many keys it keeps everything, and the join decides alone."""
    some = keys.select(F.pmod(F.col(key), F.lit(FILTER_BUCKETS)).alias("_bucket")).distinct()
    return (rows.withColumn("_bucket", F.pmod(F.col(key), F.lit(FILTER_BUCKETS)))
            .join(F.broadcast(some), "_bucket", "left_semi").drop("_bucket"))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A document's identity: its id and 128 bits of its text.  Rows equal in
    both are one document; a null id is a value like any other, below all."""
    return F.struct(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("k1"),
                    F.xxhash64(F.lit("2"), F.col(text)).alias("k2"))
