import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from adlake.sources.files import read_csv, read_csv_renamed, read_json_records, rows_from_json_grid
from adlake.sources.sinks import (append_partitioned, append_with_quarantine, max_dates, replace_from, split_quarantine,
                                  write_csv_report, write_full, write_partitions)
from adlake.sources.tables import table_exists


def day(n):
    return dt.date(2024, 1, n)


def _days(spark, start, n, v):
    return spark.createDataFrame([(day(start) + dt.timedelta(days=i), v) for i in range(n)], "d date, v int")


def held(spark, path, schema="v int, d date"):
    return sorted(((r.d and r.d.day, r.v) for r in spark.read.schema(schema).parquet(path).collect()), key=lambda x: (x[0] or 0, x[1]))


def test_replace_from_removes_stale_partitions_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    replace_from(_days(spark, 1, 10, 1), path, "d")                  # Jan 1..10
    batch = _days(spark, 5, 2, 2)                                    # Jan 5..6 corrected
    for _ in range(2):                                               # re-run: same result
        assert replace_from(batch, path, "d") == {(): day(5)}
        assert held(spark, path) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2)]
    assert replace_from(batch.where(F.lit(False)), path, "d") is None  # empty batch: no change
    assert len(spark.read.parquet(path).collect()) == 6


def test_replace_from_keeps_null_and_early_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(None, 0), (day(1), 1), (day(2), 1), (day(9), 1)], "d date, v int")
    replace_from(old, path, "d")
    batch = spark.createDataFrame([(day(1), 7), (day(5), 7), (None, 7)], "d date, v int")
    replace_from(batch, path, "d", start=day(4))
    got = held(spark, path)
    assert got == [(None, 0), (None, 7), (1, 1), (1, 7), (2, 1), (5, 7)]


def test_replace_from_by_scope_with_own_starts_and_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["a/b=c", "x y%", None]
    rows = [(n, day(i), 1) for n in names for i in (1, 5, 9)]
    make = lambda r: spark.createDataFrame(r, "region string, d date, v int")
    replace_from(make(rows), path, "d", scope=["region"])
    cursor = max_dates(make(rows), "region", "d")
    assert cursor == {n: day(9) for n in names}
    replace_from(make([("a/b=c", day(6), 2), (None, day(9), 2)]), path, "d", start={"a/b=c": day(4), None: day(9)}, scope=["region"])
    got = sorted(((r.region, r.d.day, r.v) for r in spark.read.parquet(path).collect()), key=str)
    want = [("a/b=c", 1, 1), ("a/b=c", 6, 2), *[("x y%", i, 1) for i in (1, 5, 9)], (None, 1, 1), (None, 5, 1), (None, 9, 2)]
    assert got == sorted(want, key=str)


def test_failed_batch_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_from(_days(spark, 1, 4, 1), path, "d")
    broken = _days(spark, 2, 2, 2).withColumn("v", F.when(F.dayofmonth("d") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        replace_from(broken, path, "d")
    assert held(spark, path) == [(i, 1) for i in range(1, 5)]


def test_one_file_a_partition_but_for_large_ones(spark, tmp_path):
    rows = spark.range(0, 8000, 1, 8).select(F.date_add(F.lit(day(1)), (F.col("id") % 30).cast("int")).alias("d"), F.col("id").cast("int").alias("v"))
    for name, write in (("replace", lambda p: replace_from(rows, p, "d")), ("append", lambda p: append_partitioned(rows, p, ["d"])),
                        ("full", lambda p: write_full(rows, p, ["d"])), ("some", lambda p: write_partitions(rows, p, ["d"]))):
        write(str(tmp_path / name))
        assert len(glob.glob(f"{tmp_path}/{name}/d=*/*.parquet")) == 30, name
    replace_from(rows, str(tmp_path / "salted"), "d", rows_per_file=70)
    assert spark.read.parquet(str(tmp_path / "salted")).count() == 8000
    assert len(glob.glob(f"{tmp_path}/salted/d=2024-01-01/*.parquet")) > 1


def test_full_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full(_days(spark, 1, 3, 1), path, ["d"])
    write_partitions(_days(spark, 2, 1, 2), path, ["d"])
    assert held(spark, path) == [(1, 1), (2, 2), (3, 1)]
    write_full(_days(spark, 9, 1, 3), path, ["d"])
    assert held(spark, path) == [(9, 3)]
    append_partitioned(_days(spark, 9, 1, 4), path, ["d"], max_records_per_file=1)
    assert held(spark, path) == [(9, 3), (9, 4)]


def test_quarantine_split(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    good, bad = split_quarantine(df, {"positive": F.col("v") > 0})
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, tuple(r.failed_rules)) for r in bad.collect()) == [(2, ("positive",)), (3, ("positive",))]
    for _ in range(2):
        append_with_quarantine(df, str(tmp_path / "g"), str(tmp_path / "b"), {"positive": F.col("v") > 0}, max_records_per_file=1)
    assert spark.read.parquet(str(tmp_path / "g")).count() == 2
    assert spark.read.parquet(str(tmp_path / "b")).count() == 4 and len(glob.glob(f"{tmp_path}/b/*.parquet")) >= 4


def test_weekly_rank_overwrites_whole_weeks(spark, tmp_path):
    from adlake.plans.weekly_rank import refresh_weekly_rank
    path = str(tmp_path / "rank")
    reading = lambda rows: spark.createDataFrame([(dt.datetime(2024, 1, d, 8), 1, p, r, 5) for d, p, r in rows],
                                                 "timestamp_ingested timestamp, asin long, phrase string, rank string, niche_id long")
    niche = spark.createDataFrame([(5, "m")], "niche_id long, marketplace_id string")
    dates = spark.createDataFrame([(day(i), int(day(i).strftime("%U")), 2024) for i in range(1, 22)], "full_date date, week_number int, year int")
    first = [(2, "a", "9"), (8, "a", "7"), (8, "b", "3")]
    assert refresh_weekly_rank(reading(first), niche, dates, "m", path, "2024-01-08") == "full"
    later = first + [(10, "a", "x")]                                 # same week as the 8th, other day
    assert refresh_weekly_rank(reading(later), niche, dates, "m", path, "2024-01-10") == "incremental"
    got = sorted((r.week, r.phrase, r.h10_rank) for r in spark.read.parquet(path).collect())
    assert got == [(0, "a", 9), (1, "a", None), (1, "b", 3)]         # "b" was read earlier in the week and stays
    again = refresh_weekly_rank(reading(later), niche, dates, "m", path, "2024-01-10")
    assert again == "incremental" and spark.read.parquet(path).count() == 3


def test_readers(spark, tmp_path):
    from pyspark.sql.types import StructType
    text = tmp_path / "r.csv"
    text.write_text("report of the day\nDate,Amount,Name\n2024-01-01,5,x\nbad,oops,y\n2024-01-02,,z\n")
    rows, rejected = read_csv_renamed(spark, str(text), StructType.fromDDL("d date, amount int, name string"))
    assert sorted((str(r.d), r.amount, r.name) for r in rows.collect()) == [("2024-01-01", 5, "x"), ("2024-01-02", None, "z")]
    assert [(r.d, r.amount, r.name, r.failed_rules) for r in rejected.collect()] == [("bad", "oops", "y", ["d", "amount"])]
    rows, rejected = read_csv_renamed(spark, str(text), StructType.fromDDL("a string, b string, c string"), ["Date", "Amount", "Name"])
    assert rows.count() == 3 and rejected.count() == 0
    assert read_csv(spark, str(text), StructType.fromDDL("a string")).count() == 4
    (tmp_path / "j.json").write_text('{"a": 1, "b": "x"}\n{"b": "y"}\n')
    got = read_json_records(spark, str(tmp_path / "j.json"), StructType.fromDDL("a int, b string")).collect()
    assert sorted((r.a, r.b) for r in got if r.a) == [(1, "x")] and len(got) == 2
    grid = spark.createDataFrame([('[["1","a"],["2"]]',), (None,)], "g string")
    assert [tuple(r) for r in rows_from_json_grid(grid, "g", ["n", "s"]).collect()] == [(0, "1", "a"), (1, "2", None)]
    out = write_csv_report(spark.createDataFrame([(1, "p")], "n int, s string"), str(tmp_path), "rep", "2024-01-01")
    assert out.endswith("rep_2024-01-01") and spark.read.option("header", True).csv(out).collect()[0].s == "p"


def test_incremental_model_reads_only_new_partitions(spark, tmp_path):
    from adlake.plans.weekly_rank import high_water_mark, land_readings, readings_since, run_incremental, weekly_rank
    source, path = str(tmp_path / "raw"), str(tmp_path / "model")
    make = lambda rows: spark.createDataFrame([(dt.datetime(2024, 1, d, h), 1, p, r, 5) for d, h, p, r in rows],
                                              "timestamp_ingested timestamp, asin long, phrase string, rank string, niche_id long")
    niche = spark.createDataFrame([(5, "m")], "niche_id long, marketplace_id string")
    dates = spark.createDataFrame([(day(i), int(day(i).strftime("%U")), 2024) for i in range(1, 29)], "full_date date, week_number int, year int")
    assert high_water_mark(spark, path) is None
    landings = [[(2, 8, "a", "9"), (8, 8, "a", "7"), (8, 9, "b", "3")], [(10, 8, "a", "x"), (16, 8, "c", "1")], [(16, 9, "c", "2"), (25, 1, "a", "4")], [(25, 1, "a", "4")]]
    marks, everything = [], []
    for rows in landings:
        land_readings(make(rows), source)
        everything += rows
        marks.append(run_incremental(spark, source, niche, dates, "m", path))
        cols = ["year", "week", "asin", "phrase", "h10_rank", "unique_key"]
        got = sorted(map(tuple, spark.read.parquet(path).select(*cols).collect()), key=str)
        assert got == sorted(map(tuple, weekly_rank(make(everything), niche, dates, "m").select(*cols).collect()), key=str)
    assert marks == [None, day(7), day(14), day(21)]
    scan = weekly_rank(readings_since(spark, source, day(14)).drop("day"), niche, dates, "m")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-14" in plan
