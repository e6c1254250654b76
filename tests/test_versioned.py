import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from adlake.sources import versioned
from adlake.sources.versioned import VersionedTable


def day(n):
    return dt.date(2024, 1, n)


def days(spark, start, n, v):
    return spark.createDataFrame([(day(start) + dt.timedelta(days=i), v) for i in range(n)], "d date, v int")


def held(df):
    return sorted(((r.d and r.d.day, r.v) for r in df.collect()), key=lambda x: (x[0] or 0, x[1]))


def test_replace_from_and_again(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.replace_from(days(spark, 1, 10, 1), "d")
    batch = days(spark, 5, 2, 2)
    for _ in range(2):  # a run repeated gives the same table
        assert t.replace_from(batch, "d") == {(): day(5)}
        assert held(t.read()) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2)]
    assert t.replace_from(batch.limit(0), "d") is None and t.versions() == [1, 2, 3]
    assert held(t.read(1)) == [(i, 1) for i in range(1, 11)]


def test_null_and_early_rows_stay(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace_from(spark.createDataFrame([(None, 0), (day(1), 1), (day(2), 1), (day(9), 1)], "d date, v int"), "d")
    t.replace_from(spark.createDataFrame([(day(1), 7), (day(5), 7), (None, 7)], "d date, v int"), "d", start=day(4))
    assert held(t.read()) == [(None, 0), (None, 7), (1, 1), (1, 7), (2, 1), (5, 7)]


@pytest.mark.parametrize("kind,names", [("string", ["a/b=c", "x y%", None]), ("int", [1, 20, None])])
def test_scopes_have_their_own_starts(spark, tmp_path, kind, names):
    t = VersionedTable(spark, str(tmp_path / "t"))
    make = lambda r: spark.createDataFrame(r, f"region {kind}, d date, v int")
    t.replace_from(make([(n, day(i), 1) for n in names for i in (1, 5, 9)]), "d", scope=["region"])
    t.replace_from(make([(names[0], day(6), 2), (None, day(9), 2)]), "d", start={names[0]: day(4), None: day(9)}, scope=["region"])
    got = sorted(((r.region, r.d.day, r.v) for r in t.read().collect()), key=str)
    assert got == sorted([(names[0], 1, 1), (names[0], 6, 2), *[(names[1], i, 1) for i in (1, 5, 9)], (None, 1, 1), (None, 5, 1), (None, 9, 2)], key=str)


def test_readers_see_old_or_new(spark, tmp_path):
    """While writes run and fail, every read is a whole version."""
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.overwrite(days(spark, 1, 20, 0), ["d"])
    opened = t.read()  # keeps its version
    whole, seen, stop = {tuple((i, 0) for i in range(1, 21))}, [], threading.Event()
    whole |= {tuple((i, k if i >= 3 else 0) for i in range(1, 21)) for k in (1, 2, 3)}

    def look():
        while not stop.is_set():
            seen.append(tuple(held(VersionedTable(spark, t.path).read())))

    reader = threading.Thread(target=look)
    reader.start()
    try:
        for k in (1, 2, 3):
            broken = days(spark, 3, 18, 9).withColumn("v", F.when(F.dayofmonth("d") == 17, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int"))
            with pytest.raises(Exception, match="broken"):
                t.replace_from(broken, "d")
            t.replace_from(days(spark, 3, 18, k), "d")
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= whole
    assert held(opened) == [(i, 0) for i in range(1, 21)] and len(t.versions()) == 4


def test_failure_between_segment_and_version(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.rotate(days(spark, 1, 2, 1))
    t.rotate(days(spark, 1, 2, 2))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", fail)
        for write in (lambda: t.rotate(days(spark, 1, 2, 3)), lambda: t.replace_from(days(spark, 1, 2, 3), "d"), lambda: t.overwrite(days(spark, 1, 2, 3))):
            with pytest.raises(RuntimeError, match="lost"):
                write()
    assert held(t.read()) == [(1, 2), (2, 2)] and held(t.previous()) == [(1, 1), (2, 1)]
    assert t.vacuum() == 3 and held(t.read()) == [(1, 2), (2, 2)] and held(t.previous()) == [(1, 1), (2, 1)]


def test_rotate_keeps_two_generations(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for k in range(1, 5):
        t.rotate(days(spark, k, 1, k))
        assert held(t.read()) == [(k, k)]
        assert (t.previous() is None) if k == 1 else held(t.previous()) == [(k - 1, k - 1)]
    assert t.vacuum(keep=1) == 2 and held(t.read()) == [(4, 4)] and held(t.previous()) == [(3, 3)]


def test_one_of_two_writers_fails(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.overwrite(days(spark, 1, 1, 1))
    before, manifest = t.manifest()
    VersionedTable(spark, t.path).append(days(spark, 2, 1, 2))
    with pytest.raises(FileExistsError):
        t.commit(before, manifest)
    assert held(t.read()) == [(1, 1), (2, 2)]


def test_compaction_and_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_SEGMENTS", 3)
    t = VersionedTable(spark, str(tmp_path / "t"))
    for k in range(1, 9):
        assert t.replace_from(days(spark, k, 2, k), "d", batch=("stream", k)) is not None
        assert len(t.manifest()[1]["segments"]) <= 3
        assert t.replace_from(days(spark, k, 2, 99), "d", batch=("stream", k)) is None  # is in the table
    assert held(t.read()) == [*[(k, k) for k in range(1, 9)], (9, 8)]


def test_replaced_rows_are_skipped_by_the_scan(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace_from(days(spark, 1, 20, 1), "d")
    t.replace_from(days(spark, 10, 3, 2), "d")
    plan = t.read().where(F.col("d") >= day(5))._jdf.queryExecution().executedPlan().toString()
    assert "Or(LessThan(d,2024-01-10),IsNull(d))" in plan or "LessThan(d,2024-01-10)" in plan, plan
