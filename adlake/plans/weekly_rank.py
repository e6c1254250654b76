"""MA3: weekly keyword rank (latest reading per product/phrase/week).

Inputs: ``rank_raw`` (timestamp_ingested, asin, phrase, rank STRING,
niche_id), ``niche_master`` (niche_id, marketplace_id), ``date_dimension``
(full_date, week_number, year).  ``incremental`` restricts the scan to the
readings of the run week(s) at or after ``as_of``; the sink then overwrites
exactly the affected week partitions (see ``sources.sinks``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.core import sunday_week
from adlake.operators.relational import latest_per_key
from adlake.sources.sinks import append_partitioned, write_full, write_partitions
from adlake.sources.tables import table_exists


def week_bounds(date_dimension: DataFrame) -> DataFrame:
    return (date_dimension.groupBy("week_number", "year")
            .agg(F.min("full_date").alias("wc_date"), F.max("full_date").alias("we_date")))


def weekly_rank(rank_raw: DataFrame, niche_master: DataFrame, date_dimension: DataFrame,
                market: str, incremental: bool = False, as_of: str | None = None) -> DataFrame:
    r = rank_raw.join(niche_master.where(F.col("marketplace_id") == market).select("niche_id"), "niche_id", "inner")
    ts = F.col("timestamp_ingested")
    r = r.select(F.year(ts).alias("year"), sunday_week(F.to_date(ts)).alias("week"), "timestamp_ingested",
                 "asin", "phrase", "rank")
    if incremental:
        # whole weeks that contain a reading on/after as_of (the sink replaces whole weeks)
        since = F.to_date(F.lit(as_of))
        weeks = (r.where(F.to_date(ts) >= since).select("year", "week").distinct())
        r = r.join(weeks, ["year", "week"], "left_semi")
    latest = latest_per_key(r, ["year", "week", "asin", "phrase"], "timestamp_ingested", payload=["rank"])
    wb = week_bounds(date_dimension).withColumnRenamed("week_number", "week")
    j = latest.join(wb, ["year", "week"], "left")
    return j.select(F.concat(F.col("wc_date").cast("string"), F.col("asin").cast("string"), F.col("phrase")).alias("unique_key"),
                    "year", "week", "wc_date", "we_date", "asin", "phrase",
                    F.col("rank").try_cast("bigint").alias("h10_rank"))


def refresh_weekly_rank(rank_raw: DataFrame, niche_master: DataFrame, date_dimension: DataFrame, market: str,
                        path: str, as_of: str) -> str:
    """SK2: the incremental model run.  The first run writes the whole table;
    later ones compute every week that has a reading since ``as_of`` anew, from
    all of that week's readings, and overwrite exactly those (year, week)
    partitions.  Returns "full" or "incremental"."""
    spark = rank_raw.sparkSession
    if not table_exists(spark, path):
        write_full(weekly_rank(rank_raw, niche_master, date_dimension, market), path, ["year", "week"])
        return "full"
    write_partitions(weekly_rank(rank_raw, niche_master, date_dimension, market, True, as_of), path, ["year", "week"])
    return "incremental"


def land_readings(rank_raw: DataFrame, source: str) -> None:
    """Readings appended to a source table partitioned by day."""
    append_partitioned(rank_raw.withColumn("day", F.to_date("timestamp_ingested")), source, ["day"])


def readings_since(spark: SparkSession, source: str, mark: dt.date | None) -> DataFrame:
    """The source from a day on: only its partitions are listed and read."""
    rows = spark.read.parquet(source)
    return rows if mark is None else rows.where(F.col("day") >= F.lit(mark))


def high_water_mark(spark: SparkSession, path: str) -> dt.date | None:
    """The first day of the last week in the target; None without a target.  Its
    (year, week) partitions are folder names, so two weeks at most are read."""
    if not table_exists(spark, path):
        return None
    table = spark.read.parquet(path)
    last = table.select("year", "week").distinct().orderBy(F.desc("year"), F.desc("week")).first()
    if last is None:
        return None
    return table.where((F.col("year") == last["year"]) & (F.col("week") == last["week"])).agg(F.min("wc_date")).first()[0]


def run_incremental(spark: SparkSession, source: str, niche_master: DataFrame, date_dimension: DataFrame, market: str, path: str) -> dt.date | None:
    """SK2: one run of the incremental model.  The mark is read from the target:
    the week it begins may have new readings, weeks before may not; from there
    on whole weeks are computed and overwrite their (year, week) partitions.
    Without a target, or in one without a dated week, all are.  Returns the mark."""
    mark = high_water_mark(spark, path)
    rows = weekly_rank(readings_since(spark, source, mark).drop("day"), niche_master, date_dimension, market)
    (write_full if mark is None else write_partitions)(rows, path, ["year", "week"])
    return mark
