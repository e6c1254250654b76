"""Sinks (SK1-SK8): partitioned writes, partition replacement, quarantine.

Parquet tables have no DELETE, so "delete date >= start, then append" becomes a
partition-scoped overwrite.  The order keeps the table whole at every step:
the batch is evaluated once into the shared scratch folder, its partitions are
written through Spark's commit protocol, and only then the partitions that the
batch no longer has are removed.  A failed write leaves the old table.

Every partitioned write is shuffled by its partition columns first: one file
for each partition, and more only for a large one, whatever the number of tasks
before.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import materialise
from adlake.sources.tables import table_exists

ROWS_PER_FILE = 2_000_000
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL partition


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], **options):
    """Rebalanced by the partition columns: AQE splits large partitions."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    return _plain_writer(df, mode, partition_by, **options)


def _plain_writer(df: DataFrame, mode: str, partition_by: Sequence[str], **options):
    w = df.write.mode(mode).options(**options)
    return w.partitionBy(*partition_by) if partition_by else w


def write_full(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SK1: full replace of a (day-)partitioned table."""
    _writer(df, "overwrite", partition_by, partitionOverwriteMode="static").parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """SK2: overwrite only the partitions present in ``df`` (dynamic)."""
    _writer(df, "overwrite", partition_by, partitionOverwriteMode="dynamic").parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                       max_records_per_file: int | None = None) -> None:
    """SK5/SK7: append with day partitioning; optional file batching."""
    options = {"maxRecordsPerFile": int(max_records_per_file)} if max_records_per_file else {}
    _writer(df, "append", partition_by, **options).parquet(path)


def partition_folders(spark: SparkSession, path: str, cols: Sequence[str]) -> list[tuple[tuple, object]]:
    """(values as text, hadoop path) of every leaf partition folder.  Escaped
    characters are read back; the NULL partition's value is None."""
    fs, root = _fs(spark, path)
    found = [((), root)] if fs.exists(root) else []
    for col in cols:
        below = []
        for values, folder in found:
            for st in fs.listStatus(folder):
                name, _, text = st.getPath().getName().partition("=")
                if st.isDirectory() and unquote(name) == col:
                    below.append(((*values, None if text == NULL_PARTITION else unquote(text)), st.getPath()))
        found = below
    return found


def _spread(df: DataFrame, parts: Sequence[str], counts: Mapping[tuple, int], rows_per_file: int) -> DataFrame:
    """Shuffle by partition over all tasks, as many small partitions are many
    small files that one task would write in turn; a partition of more than
    ``rows_per_file`` rows is salted over several tasks."""
    salt = F.lit(0)
    for key, n in counts.items():
        if n > rows_per_file:
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(parts, key)])
            salt = F.when(same, F.pmod(F.xxhash64(*df.columns), F.lit(-(-n // rows_per_file)))).otherwise(salt)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("_salt", salt).repartition(tasks, *[F.col(f"`{c}`") for c in parts], F.col("_salt")).drop("_salt")


Start = str | dt.date | None


def replace_from(df: DataFrame, path: str, date_col: str, start: Start | Mapping[object, Start] = None,
                 scope: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> dict[tuple, dt.date] | None:
    """SK3/SK4: the table becomes (old rows with date < start) and the batch,
    separately for each ``scope`` value (e.g. country) that the batch has.

    ``start`` is one date, or a date for each scope value, or by default the
    batch's least date in that scope.  Rows with a NULL date are never
    replaced.  Batch rows dated before ``start``, or not at all, are appended
    to the partitions that stay.  An empty batch changes nothing.  Returns the
    starts used, or None for an empty batch.

    The (scope, date) partitions and their counts come to the driver, no rows.  A
    run repeated after success gives the same table, but for rows dated before
    ``start``, which are appended again."""
    spark = df.sparkSession
    parts = [*scope, date_col]
    batch = materialise(df, "replace-batch")
    least = {tuple(r[: len(scope)]): r["_least"]
             for r in batch.groupBy(*scope).agg(F.min(F.to_date(date_col)).alias("_least"), F.count("*").alias("_n")).collect() if r["_n"]}
    if not least:
        return None

    def given(key: tuple) -> Start:
        if isinstance(start, Mapping):
            return start.get(key, start.get(key[0] if len(key) == 1 else key, least[key]))
        return least[key] if start is None else start

    starts = {k: dt.date.fromisoformat(str(v)) for k in least if (v := given(k)) is not None}
    sizes = {tuple(r[: len(parts)]): r["_n"] for r in batch.groupBy(*parts).agg(F.count("*").alias("_n")).collect()}
    batch = _spread(batch, parts, sizes, rows_per_file)
    if not table_exists(spark, path):
        _plain_writer(batch, "append", parts).parquet(path)
        return starts

    def replaced(key: tuple, day: dt.date) -> Column:
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(scope, key)]
        return reduce(lambda a, b: a & b, [*same, F.to_date(date_col) >= F.lit(day)])

    is_new = F.coalesce(reduce(lambda a, b: a | b, [replaced(k, d) for k, d in starts.items()], F.lit(False)), F.lit(False))
    fresh, early = batch.where(is_new), batch.where(~is_new)
    late = {k for k in sizes if k[:-1] in starts and k[-1] is not None and dt.date.fromisoformat(str(k[-1])) >= starts[k[:-1]]}
    present = {tuple(None if v is None else str(v) for v in k) for k in late}
    if late:
        _plain_writer(fresh, "overwrite", parts, partitionOverwriteMode="dynamic").parquet(path)
    if len(late) < len(sizes):
        _plain_writer(early, "append", parts).parquet(path)
    by_text = {tuple(None if v is None else str(v) for v in k): d for k, d in starts.items()}
    fs, _ = _fs(spark, path)
    for values, folder in partition_folders(spark, path, parts):
        day = by_text.get(values[:-1])
        if day is not None and values[-1] is not None and dt.date.fromisoformat(values[-1]) >= day and values not in present:
            fs.delete(folder, True)
    return starts


def max_dates(table: DataFrame, scope: str, date_col: str) -> dict[object, dt.date]:
    """SC8: the incremental cursor, the greatest loaded date by scope value."""
    rows = table.groupBy(scope).agg(F.max(F.to_date(date_col)).alias("_day")).collect()
    return {r[scope]: r["_day"] for r in rows if r["_day"] is not None}


def split_quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """SK6: valid rows, and invalid rows with the names of the failed rules."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]),
                      lambda x: x.isNotNull())
    tagged = df.withColumn("_failed", failed)
    valid = tagged.where(F.size("_failed") == 0).drop("_failed")
    invalid = tagged.where(F.size("_failed") > 0).withColumnRenamed("_failed", "failed_rules")
    return valid, invalid


def append_with_quarantine(df: DataFrame, path: str, quarantine_path: str, rules: dict[str, Column],
                           partition_by: Sequence[str] = (), max_records_per_file: int | None = None) -> None:
    valid, invalid = split_quarantine(df, rules)
    append_partitioned(valid, path, partition_by, max_records_per_file)
    append_partitioned(invalid, quarantine_path, partition_by, max_records_per_file)


def write_csv_report(df: DataFrame, folder: str, name: str, as_of: str) -> str:
    """SK8: CSV with header into a dated folder (one file per task)."""
    out = f"{folder.rstrip('/')}/{name}_{as_of}"
    df.write.mode("overwrite").option("header", True).csv(out)
    return out
