"""Reshaping helpers: chunking, nested unnest, safe ordinals (RS2, RS3, RS6)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.session import materialise


def positions(df: DataFrame, group: Sequence[str], order_key: str, bucket_width: int = 1 << 16) -> DataFrame:
    """Exact 0-based row position of each row inside ``group`` ordered by a
    numeric ``order_key`` (ties broken arbitrarily but consistently by the
    window sort), without sorting a whole group in one task.  A NULL group is
    a group like any other; rows with a NULL ``order_key`` come first.

    Rows are split into key-range buckets; a small per-(group, bucket) count
    table gives each bucket's offset (a running sum over buckets), and the
    row number is taken inside a bucket, whose size is bounded by
    ``bucket_width`` distinct keys."""
    b = F.floor(F.col(order_key) / bucket_width).cast("bigint")
    x = df.withColumn("_b", b)
    counts = x.groupBy(*group, "_b").agg(F.count("*").alias("_cnt"))
    wg = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_b", F.coalesce(F.sum("_cnt").over(wg), F.lit(0)).alias("_off"))
    wb = Window.partitionBy(*group, "_b").orderBy(order_key)
    inner = x.withColumn("_rn", F.row_number().over(wb) - 1)
    keys = [*group, "_b"]
    right = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in keys], "_off")
    same = reduce(lambda a, c: a & c, [inner[c].eqNullSafe(right[f"_o_{c}"]) for c in keys])
    return (inner.join(right, same).withColumn("pos", (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_b", "_rn", "_off", *[f"_o_{c}" for c in keys]))


def global_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """0-based position of each row in the order of ``col`` (NULL last; ties in
    any order).  Rows are range-partitioned and numbered inside their range; a
    range is shifted by the counts of the ranges before it, one row each."""
    ranges = materialise(df.repartitionByRange(F.col(col).isNull(), F.col(col)).withColumn("_gr_part", F.spark_partition_id()), "rank")
    own = Window.partitionBy("_gr_part").orderBy(F.col(col).asc_nulls_last())
    before = Window.orderBy("_gr_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (ranges.groupBy("_gr_part").agg(F.count("*").alias("_gr_n"))
             .select("_gr_part", F.coalesce(F.sum("_gr_n").over(before), F.lit(0)).alias("_gr_shift")))
    return (ranges.withColumn("_gr_no", F.row_number().over(own) - 1).join(shift, "_gr_part")
            .withColumn(out, (F.col("_gr_no") + F.col("_gr_shift")).cast("bigint")).drop("_gr_part", "_gr_no", "_gr_shift"))


def chunk_groups(df: DataFrame, group: Sequence[str], order_key: str, size: int,
                 out: str = "batch_id") -> DataFrame:
    """RS6: consecutive chunks of ``size`` rows per group (keywords scored in
    batches of three)."""
    p = positions(df, group, order_key)
    return p.withColumn(out, F.floor(F.col("pos") / size).cast("bigint")).drop("pos")


def safe_ordinal(arr, n: int):
    """RS3: ``arr[SAFE_ORDINAL(n)]`` — 1-based, NULL when out of range."""
    return F.get(arr, n - 1)
