import random

from pyspark.sql import functions as F

from adlake.operators import relational as R
from adlake.operators.allocation import even_allocation
from adlake.operators.reshape import chunk_groups, global_rank, positions
from adlake.operators import textjoin
from adlake.operators.textjoin import contains_join, contains_matches


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contains_join_equals_nested_loop(spark):
    rnd = random.Random(7)
    alpha = "ab_%"
    texts = [(i, "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    texts.append((999, None))
    keys = sorted({"".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 3))) for _ in range(12)})
    left = spark.createDataFrame(texts, "id int, t string")
    right = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [(r.id, r.k) for r in contains_join(left, "t", right, "k").collect()]
    want = []
    for i, t in texts:
        ms = [k for k in keys if t is not None and k in t]
        want += [(i, k) for k in ms] or [(i, None)]
    assert sorted(got, key=lambda x: (x[0], x[1] or "")) == sorted(want, key=lambda x: (x[0], x[1] or ""))
    plan = _plan(contains_join(left, "t", right, "k"))
    assert not any(node in plan for node in ("NestedLoop", "Cartesian", "Python", "Arrow", "Window"))


def test_pick_per_key_is_aggregate_and_total_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, None, "q"), (2, 1, "r")],
                               "k int, ts int, v string")
    out = {r.k: (r.ts, r.v) for r in R.latest_per_key(df, ["k"], "ts", ["v"]).collect()}
    assert out == {1: (5, "b"), 2: (1, "r")}
    first = {r.k: (r.ts, r.v) for r in R.first_by_priority(df, ["k"], ["ts"], ["v"]).collect()}
    assert first == {1: (3, "z"), 2: (None, "q")}
    assert "Window" not in _plan(R.latest_per_key(df, ["k"], "ts", ["v"]))


def test_even_allocation_sums_back(spark):
    rows = spark.createDataFrame([(d, i) for d in ("x", "y", "z") for i in range({"x": 3, "y": 1, "z": 4}[d])] + [(None, 1), (None, 2)],
                                 "d string, i int")
    meas = spark.createDataFrame([("x", 9.0), ("y", 5.0), ("q", 1.0)], "d string, m double")
    out = even_allocation(rows, meas, ["d"], {"m": "a"})
    tot = {r.d: r.s for r in out.groupBy("d").agg(F.sum("a").alias("s")).collect()}
    assert tot["x"] == 9.0 and tot["y"] == 5.0 and tot["z"] is None and tot[None] is None and out.count() == 10


def test_positions_exact_across_buckets(spark):
    df = spark.createDataFrame([(g, k) for g in ("a", "b") for k in range(0, 50, 3)], "g string, k long")
    out = positions(df, ["g"], "k", bucket_width=8).collect()
    for g in ("a", "b"):
        ks = sorted(r.k for r in out if r.g == g)
        assert [r.pos for r in sorted((r for r in out if r.g == g), key=lambda r: r.k)] == list(range(len(ks)))


def test_positions_and_chunks_keep_null_groups_and_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), (None, 70000), (None, 2), (None, None)], "g string, k long")
    got = sorted(((r.g, r.k, r.pos) for r in positions(df, ["g"], "k").collect()), key=str)
    assert got == sorted([("a", None, 0), ("a", 3, 1), (None, None, 0), (None, 2, 1), (None, 70000, 2)], key=str)
    assert chunk_groups(df, ["g"], "k", 2).count() == 5


def test_global_rank_has_no_window_over_all_rows(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "é", "a", None, "c", "z")], "v string")
    ranked = global_rank(df, "v")
    assert [r.v for r in sorted(ranked.collect(), key=lambda r: r["rank"])] == ["a", "b", "c", "z", "é", None]


def test_contains_join_of_long_texts(spark):
    rnd = random.Random(5)
    texts = [(i, "".join(rnd.choice("aBcé ") for _ in range(rnd.choice([0, 5, 1023, 1024, 1025, 4000])))) for i in range(25)]
    keys = sorted({"".join(rnd.choice("aBcé ") for _ in range(rnd.randint(1, 7))) for _ in range(40)} | {texts[0][1][1020:1030], "", "x" * 1500})
    left, right = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    for fold in (False, True):
        low = (lambda s: s.lower()) if fold else (lambda s: s)
        got = {(r.id, r.k) for r in contains_matches(left, ["id"], "t", right, "k", ignore_case=fold).collect()}
        want = {(i, low(k)) for i, t in texts for k in keys if low(k) in low(t)}
        assert got == want


def test_contains_join_keeps_rows_and_columns(spark):
    rows = [(1, "red shoe", "a", 1), (1, "red shoe", "a", 1), (2, None, "b", 2), (3, "", "c", 3), (4, "blue", "d", 4)] + [(5, "the same text", "e", 5)] * 50
    left = spark.createDataFrame(rows, "keys int, t string, found string, row int")
    right = spark.createDataFrame([("shoe",), ("shoe",), ("same text",), ("red shoes",), (None,)], "gram string")
    got = contains_join(left, "t", right, "gram")
    assert got.columns == ["keys", "t", "found", "row", "gram"]
    hits = {1: "shoe", 5: "same text"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(*r, hits.get(r[0])) for r in rows], key=str)
    assert contains_join(left, "t", right.limit(0), "gram").where("gram is null").count() == len(rows)
    assert contains_join(left.limit(0), "t", right, "gram").count() == 0
    assert {r.gram for r in contains_matches(left, ["keys"], "t", spark.createDataFrame([("",)], "gram string"), "gram").collect()} == {""}


def test_contains_join_across_pieces_and_by_the_rarest_gram(spark):
    size = textjoin.PIECE
    text = "".join(chr(97 + i * i % 23 + i % 3) for i in range(3 * size)) + "é" * 9
    keys = [text[k + 5 * n : k + 6 * n] for n in (1, 3, 4, 5, 40, 47, 48, 49, 50, 51, 52, 53, 99, 100, 101, 130) for k in (0, 9, 700)]
    keys += [text[:60], text[-60:], text[:100] + "!", "!" + text[-70:]]
    keys += [text[size - 5 : size + 5], text[2 * size - 1 : 2 * size + 40], text[size - 700 : size + 700], "aéé", "éa", "zzzzzz"]
    left = spark.createDataFrame([(1, text), (2, text[:size]), (3, "common common rare!")], "id int, t string")
    right = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {tuple(r) for r in contains_matches(left, ["id"], "t", right, "k").collect()}
    assert got == {(i, k) for i, t in ((1, text), (2, text[:size]), (3, "common common rare!")) for k in keys if k in t}
    texts = left.select(F.xxhash64("t").alias("t"), F.lit(0).alias("u"), F.col("t").alias("text"))
    index = textjoin.gram_index(texts, spark.createDataFrame([("common rare",), ("commonest",)], "key string"))
    assert [r.key for r in index.collect()] == ["common rare"]  # "mone" is in no text


def test_nth_rows_to_columns(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, "c"), (1, 4, "d"), (2, 1, "x")],
                               "k int, o int, v string")
    out = {r.k: (r.slot1, r.slot2, r.slot3) for r in R.nth_rows_to_columns(df, ["k"], ["o"], "v").collect()}
    assert out == {1: ("a", "b", "c"), 2: ("x", None, None)}


def test_contains_join_of_crowded_keys(spark):
    """Numbered ids of several sizes share few grams: looked up whole, and each
    found wherever it is, inside other ids, at the end and beside longer keys."""
    from adlake.operators import textjoin
    ids = [f"P{i}" for i in range(1, 6000)] + ["P1234567", "item-P77", "P12", "+P4", "a key longer than sixteen bytes P55"]
    texts = ["cmp P12+P5999+P1234567", "P5", "xP4321", "item-P777 P98", "P", "", None, "a key longer than sixteen bytes P55", "P0123"]
    left = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    keys = spark.createDataFrame([(k,) for k in ids], "key string")
    index = textjoin.gram_index(left.select(F.xxhash64("text").alias("t"), F.lit(0).cast("long").alias("u"), "text").where("text is not null"), keys.where("length(key) >= 4"))
    assert index.groupBy("gram").count().agg(F.max("count")).first()[0] > 2
    want = {(i, k) for i, t in enumerate(texts) if t is not None for k in ids if k in t}
    for crowd in (textjoin.CROWD, 2):
        kept, textjoin.CROWD = textjoin.CROWD, crowd
        try:
            got = [(r.id, r.key) for r in textjoin.contains_matches(left, ["id"], "text", keys, "key").collect()]
        finally:
            textjoin.CROWD = kept
        assert set(got) == want and len(got) == len(want)


def test_the_hash_of_up_to_three_bytes_is_no_others(spark):
    codes = spark.range(256 + (1 << 16) + (1 << 24)).select(
        F.when(F.col("id") < 256, F.lpad(F.hex("id"), 2, "0")).when(F.col("id") < 256 + (1 << 16), F.lpad(F.hex(F.col("id") - 256), 4, "0"))
        .otherwise(F.lpad(F.hex(F.col("id") - 256 - (1 << 16)), 6, "0")).alias("code"))
    n, distinct = codes.select(F.unhex("code").alias("b")).agg(F.count("*"), F.count_distinct(F.xxhash64("b"))).first()
    assert n == distinct == 256 + (1 << 16) + (1 << 24)


def test_contains_join_keeps_a_text_once_for_64_keys_before_it_is_shuffled(spark):
    """Hits are numbers that are merged where they are found: one row for 64 keys
    of a text and no text of a key, however often the keys occur."""
    keys = spark.createDataFrame([(f"w{i}x",) for i in range(100, 164)] + [(f"{i}",) for i in range(10, 60)], "key string")
    texts = [(i, " ".join(f"w{100 + (i + k) % 64}x" for k in range(200))) for i in range(6)]
    left = spark.createDataFrame(texts, "id int, text string")
    numbered = keys.coalesce(1).withColumn("id", F.monotonically_increasing_id()).select(
        "key", F.shiftright("id", 6).alias("slot"), F.expr("shiftleft(1L, cast(id & 63 AS int))").alias("bit"))
    rows = left.select(F.xxhash64("text").alias("t"), F.lit(0).cast("long").alias("u"), "text")
    (hits,) = textjoin._by_rarest_gram(rows, textjoin.materialise(numbered.where("length(key) > 3"), "numbered"))
    assert {k for _, k in hits.dtypes} == {"bigint", "boolean"}
    bits = hits.groupBy("t", "u", "sure", "slot").agg(F.bit_or("bit").alias("bits"))
    assert [r.n for r in bits.select(F.bit_count("bits").alias("n")).collect()] == [64] * 6
    want = {(i, r.key) for i, t in texts for r in keys.collect() if r.key in t}
    for few, room in ((textjoin.FEW, textjoin.ROOM), (0, 0)):
        kept, (textjoin.FEW, textjoin.ROOM) = (textjoin.FEW, textjoin.ROOM), (few, room)
        try:
            got = [(r.id, r.key) for r in contains_matches(left, ["id"], "text", keys, "key").collect()]
        finally:
            textjoin.FEW, textjoin.ROOM = kept
        assert set(got) == want and len(got) == len(want)


def test_contains_join_of_many_short_keys_by_blocks(spark):
    """Each block finds its keys, whatever their sizes, in equal, odd and empty texts."""
    ids = [f"P{i}" for i in range(0, 3000, 2)] + ["é7", "P", "+P4", "sixteen bytes 12", "a key longer than sixteen bytes P55"]
    texts = ["cmp P12+P5999+P12", "P", "xP432é7", "P777 P98 sixteen bytes 12", "", None, "a key longer than sixteen bytes P55", "P0123"] + ["cmp P12+P2998"] * 300
    left = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    keys = spark.createDataFrame([(k,) for k in ids + ids[:9] + [None]], "key string")
    want = sorted((i, k) for i, t in enumerate(texts) if t is not None for k in ids if k in t)
    kept, (textjoin.FEW, textjoin.BLOCK) = (textjoin.FEW, textjoin.BLOCK), (100, 700)
    try:
        assert sorted((r.id, r.key) for r in contains_matches(left, ["id"], "text", keys, "key").collect()) == want
        outer = sorted((r.id, r.text or "", r.key or "") for r in contains_join(left.unionAll(left), "text", keys, "key").collect())
    finally:
        textjoin.FEW, textjoin.BLOCK = kept
    assert outer == sorted(2 * ([(i, texts[i], k) for i, k in want] + [(i, t or "", "") for i, t in enumerate(texts) if not t]))


def test_contains_join_of_many_keys_leaves_no_places_on_the_disks(spark):
    """The places of the texts aren't shuffled, and what was goes at once."""
    import time
    texts = [(i, "+".join(f"P{(i * 37 + k * 101) % 20000}" for k in range(12))) for i in range(4000)]
    left = spark.createDataFrame(texts, "id int, text string")
    keys = spark.range(20000).select(F.concat(F.lit("P"), "id").alias("key"))
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disks.getAllFiles()
        return {files.apply(i).getPath(): files.apply(i).length() for i in range(files.size())}

    kept, textjoin.FEW = textjoin.FEW, 1000
    try:
        before = shuffled()
        rows = contains_join(left, "text", keys, "key")
    finally:
        textjoin.FEW = kept
    for _ in range(50):
        left_over = sum(n for f, n in shuffled().items() if f not in before and "shuffle_" in f)
        if left_over < 100_000:
            break
        time.sleep(0.2)
    assert left_over < 100_000 < sum(len(t) for _, t in texts)
    assert rows.where("id = 5").count() == len({k for k in (f"P{i}" for i in range(20000)) if k in texts[5][1]})
