import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from adlake.streaming.spend_stream import hourly_spend, run_hourly_spend
from tests.conftest import SMOKE


def test_hourly_spend_stream_matches_batch_for_closed_windows(spark):
    base = tempfile.mkdtemp(prefix="adlake-stream-")
    src, sink, ck = (os.path.join(base, x) for x in ("src", "sink", "ck"))
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").select(
        F.col("user_id").alias("campaign_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("cost"))
    ev.write.parquet(src)
    q = run_hourly_spend(spark, src, ev.schema, sink, ck)
    q.awaitTermination(300)
    got = {(r.campaign_id, r.hour_start): (r.cost, r.n) for r in spark.read.parquet(sink).collect()}
    batch = hourly_spend(ev).collect()
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = {(r.campaign_id, r.hour_start): (r.cost, r.n) for r in batch
              if r.hour_end <= max_ts - dt.timedelta(minutes=20)}
    assert closed and all(got.get(k) == v for k, v in closed.items())
    assert set(got) <= {(r.campaign_id, r.hour_start) for r in batch}


def _cost_rows():
    asof = dt.datetime(2024, 1, 29, 13, 5)
    rows = [("acc", c, f"c{c}", "ENABLED", asof - dt.timedelta(days=7 * k), 10.0, 3.0) for c in (1, 2) for k in range(1, 5)]
    rows += [("acc", 1, "c1", "ENABLED", asof, 20.0, 3.0), ("acc", 1, "c1", "ENABLED", asof + dt.timedelta(minutes=9), 5.0, 4.0),
             ("acc", 2, "c2", "ENABLED", asof, 12.0, 3.0), ("acc", 2, "c2", "PAUSED", asof, 90.0, 3.0),
             ("acc", 3, "c3", "ENABLED", asof - dt.timedelta(days=1), 1.0, 3.0), ("acc", 3, "c3", "ENABLED", asof, 9.0, 3.0)]
    return rows, "account string, campaign_id long, name string, status string, ts timestamp, cost double, amount double"


def test_streamed_alerts_equal_the_batch_job(spark, tmp_path):
    from adlake.plans.operations import AlertParams, spend_alert
    from adlake.streaming.spend_stream import hourly_history, run_spend_alerts
    rows, schema = _cost_rows()
    cost = spark.createDataFrame(rows, schema)
    config = spark.createDataFrame([("acc", "50", "5", "who", 1)], "account string, pct string, abs string, contact string, pos int")
    today = cost.where("ts >= '2024-01-29'")
    late = spark.createDataFrame([("acc", 9, "c9", "ENABLED", dt.datetime(2024, 1, 29, 18, 0), 0.0, 0.0)], schema)  # closes the windows before
    today.unionByName(late).coalesce(1).write.parquet(str(tmp_path / "in"))
    p = AlertParams("2024-01-29", 13)
    history = hourly_history(cost.where("ts < '2024-01-29'"))
    run_spend_alerts(spark, str(tmp_path / "in"), cost.schema, history, config, p, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    cols = ["account", "contact", "campaign_id", "name", "hour", "today", "budget", "average", "difference", "pct_change", "pct"]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*cols).collect()))
    want = sorted(map(tuple, spend_alert(cost, config, p).select(*cols).collect()))
    assert got == want and [r[2] for r in got] == [1, 3]


def test_streamed_upsert_equals_the_batch_result(spark, tmp_path):
    from adlake.sources.sinks import replace_from
    from adlake.streaming.upsert import run_upsert_by_date
    day = lambda n: dt.date(2024, 1, n)
    batches = [[(day(i), "a", 1) for i in range(1, 6)] + [(day(2), "b", 1)], [(day(3), "a", 2), (day(4), "a", 2)], [(day(2), "b", 3)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "d date, region string, v int")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        replace_from(df, str(tmp_path / "want"), "d", scope=["region"])
    query = run_upsert_by_date(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "got"), "d", str(tmp_path / "ck"), scope=["region"])
    query.awaitTermination()
    held = lambda name: sorted((r.region, r.d, r.v) for r in spark.read.parquet(str(tmp_path / name)).collect())
    assert held("got") == held("want") == [("a", day(1), 1), ("a", day(2), 1), ("a", day(3), 2), ("a", day(4), 2), ("b", day(2), 3)]


def _land(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def test_state_forgets_after_four_weeks_and_drops_late_rows(spark, tmp_path):
    """Brute force over landings: rows newer than the watermark count, an hour
    is compared with the same hour of the four weeks before."""
    import random
    from adlake.plans.operations import AlertParams
    from adlake.streaming.spend_state import run_state_alerts
    rnd = random.Random(4)
    first = dt.datetime(2024, 1, 1)
    schema = "account string, campaign_id long, name string, status string, ts timestamp, cost double, amount double"
    batches, mark = [], None
    kept, most = [], None
    for week in range(7):
        rows = []
        for _ in range(120):
            late = rnd.random() < 0.1
            hour = rnd.choice([5, 6, 23])
            ts = first + dt.timedelta(days=7 * (week - (2 if late else 0)) + rnd.choice([0, 0, 3]), hours=hour, minutes=rnd.randint(0, 59))
            rows.append(("acc", rnd.choice([1, 2]), "c", rnd.choice(["ENABLED"] * 5 + ["PAUSED"]), ts, float(rnd.randint(0, 900)) / 100, 1.5))
        batches.append(rows)
        on = [r for r in rows if r[3] == "ENABLED"]
        kept += [r for r in on if mark is None or r[4] > mark]
        most = max([r[4] for r in on] + ([most] if most else []))
        mark = most - dt.timedelta(minutes=20)
    _land(spark, tmp_path / "in", batches, schema)
    config = spark.createDataFrame([("acc", "20", "0.5", "who", 1)], "account string, pct string, abs string, contact string, pos int")
    run_state_alerts(spark, str(tmp_path / "in"), spark.createDataFrame(batches[0], schema).schema, config, AlertParams("", 0), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    hours = {}
    for r in kept:
        key = (r[1], r[4].replace(minute=0))
        hours[key] = hours.get(key, 0) + round(r[5] * 100)
    want = []
    for (c, h), cents in hours.items():
        average = sum(hours.get((c, h - dt.timedelta(days=7 * k)), 0) for k in range(1, 5)) / 400
        difference = cents / 100 - average
        if h + dt.timedelta(hours=1) <= mark and difference >= 0.5 and (average == 0 or difference / average * 100 > 20):
            want.append((c, h, cents / 100, round(average, 6)))
    got = [(r.campaign_id, r.hour_start, r.today, round(r.average, 6)) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(want) and len(got) > 10


def test_state_is_bounded(spark):
    import pandas as pd
    from adlake.streaming.spend_state import HOUR_MS, _campaign_hours

    class State:
        held, hasTimedOut, mark, timeout = None, False, 0, None
        exists = property(lambda self: self.held is not None)
        get = property(lambda self: self.held)

        def getCurrentWatermarkMs(self):
            return self.mark

        def update(self, value):
            self.held = value

        def remove(self):
            self.held = None

        def setTimeoutTimestamp(self, ms):
            assert ms > self.mark
            self.timeout = ms

    state, advance, sizes, out = State(), _campaign_hours(28), [], []
    for hour in range(3000):
        state.mark = max(0, hour * HOUR_MS - 1_200_000)
        rows = pd.DataFrame({"ms": [hour * HOUR_MS + 5], "cents": [hour], "budget": [1], "name": ["n"]})
        out += [r for f in advance(("a", 1), iter([rows]), state) for r in f.itertuples()]
        sizes.append(len(state.held[1]))
    assert max(sizes) <= 28 * 24 + 3 and [r.hour_ms // HOUR_MS for r in out] == list(range(2998))
    assert out[700].history == sum(700 - 168 * k for k in range(1, 5)) and out[500].history == sum(500 - 168 * k for k in (1, 2))
    state.hasTimedOut, state.mark = True, 3000 * HOUR_MS
    assert [r.hour_ms // HOUR_MS for f in advance(("a", 1), iter([]), state) for r in f.itertuples()] == [2998, 2999]
    state.mark = state.timeout + 1
    assert list(advance(("a", 1), iter([]), state)) == [] and state.held is None


def test_versioned_upsert_adds_early_rows_once(spark, tmp_path):
    from adlake.sources.versioned import VersionedTable
    from adlake.streaming.upsert import run_versioned_upsert
    day = lambda n: dt.date(2024, 1, n)
    _land(spark, tmp_path / "in", [[(day(i), 1) for i in range(1, 6)], [(day(3), 2)], [(None, 3), (day(2), 3)]], "d date, v int")
    run = lambda ck: run_versioned_upsert(spark, str(tmp_path / "in"), spark.createDataFrame([], "d date, v int").schema, str(tmp_path / "t"), "d", str(tmp_path / ck)).awaitTermination()
    run("ck")
    held = lambda: sorted(((r.d and r.d.day, r.v) for r in VersionedTable(spark, str(tmp_path / "t")).read().collect()), key=str)
    want = [(1, 1), (2, 3), (None, 3)]
    assert held() == sorted(want, key=str)
    run("another-checkpoint")  # the same batches again
    assert held() == sorted(want, key=str)
