import datetime as dt

from pyspark.sql import functions as F

from adlake.functions import core as C
from adlake.functions import features as FE


def test_sunday_week_matches_strftime_U(spark):
    start = dt.date(2019, 12, 20)
    days = [start + dt.timedelta(days=i) for i in range(0, 1854, 7)] + [dt.date(2024, 1, 6), dt.date(2024, 1, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", C.sunday_week("d").alias("w")).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%U")), d
    assert got[dt.date(2024, 1, 6)] == 0 and got[dt.date(2024, 1, 7)] == 1


def test_greatest_strict_and_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 0.0)], "a double, b double")
    rows = df.select(C.greatest_strict("a", "b").alias("g"), C.safe_divide("a", "b").alias("q")).collect()
    assert [r.g for r in rows] == [2.0, None, 3.0]
    assert [r.q for r in rows] == [0.5, None, None]


def test_truncate_upper_and_like_modes(spark):
    df = spark.createDataFrame([("  abc def  " + "x" * 60, "B_")], "t string, k string")
    r = df.select(C.truncate_upper("t", 10).alias("u"),
                  C.contains_text(F.lit("AB1"), F.col("k")).alias("lit"),
                  C.contains_text(F.lit("AB1"), F.col("k"), mode="like", ignore_case=True).alias("like")).first()
    assert r.u == "ABC DEF  X"
    assert r.lit is False and r.like is True


def test_feature_bands(spark):
    rows = [(5, 0.5, "2 years"), (6, 1.0, "1 month"), (11, 6.9, "3 weeks"), (12, 7.0, None),
            (15, 30.4, "4 days"), (16, 30.5, "x"), (19, None, "years"), (20, 0.2, "2 years")]
    df = spark.createDataFrame(rows, "h int, d double, age string")
    out = df.select(FE.time_of_day("h").alias("t"), FE.stay_band("d").alias("s"),
                    FE.duration_days("age").alias("days")).collect()
    assert [r.t for r in out] == ["night", "morning", "morning", "afternoon", "afternoon", "evening",
                                  "evening", "night"]
    assert [r.s for r in out][:6] == ["less than a day", "for a day or week", "for a day or week",
                                      "more than a week", "more than a week", "more than a week"]
    assert [r.days for r in out][:4] == [730.0, 30.5, 21.0, None]
    ages = spark.createDataFrame([(1.5,), (1.6,), (7.0,), (7.1,), (None,)], "a double")
    assert [r.s for r in ages.select(FE.life_stage("a").alias("s")).collect()] == \
        ["baby", "adult", "adult", "senior", None]
