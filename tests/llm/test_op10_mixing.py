import random
import re

from adlake.llm import op10_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: op10_mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rest / total > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * rest / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


def documents(spark, seed=3, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choice(["a"] * 30 + ["b", "é", "z", "😀", "", None] * 2 + ["c"])
        text = rnd.choice([None, "", " \t\n"]) if rnd.random() < 0.05 else " ".join("w" * rnd.randint(1, 4) for _ in range(rnd.randint(1, 60)))
        rows.append((i if rnd.random() < 0.98 else None, text, source, 7, "clash"))
    rows += rows[:5]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target string")


def test_targets_and_taken(spark):
    rows, docs = documents(spark)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    sized = op10_mixing.sized_rows(docs)
    got = {r.source: r for r in op10_mixing.source_targets(sized).collect()}
    assert {s: got[s].source_size for s in sizes} == sizes
    assert all(abs(got[s].target - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)

    plan = op10_mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    by_rank, most = {}, {}
    for r in plan:
        assert 0 <= r.taken <= 3 * r["size"]
        by_rank.setdefault(r["rank"], [0, r.target])[0] += r.taken
        most[r["rank"]] = max(most.get(r["rank"], 0), r["size"])
    assert all(abs(taken - target) <= 2 * most[rank] for rank, (taken, target) in by_rank.items())
    assert sum(r.taken for r in plan) <= sum(sizes.values())
    again = op10_mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))


def test_buckets_agree_with_one_running_sum(spark):
    rows, docs = documents(spark, 9, 150)
    sized = op10_mixing.sized_rows(docs).dropDuplicates()
    targets = op10_mixing.source_targets(sized)
    got = op10_mixing.queued(sized, targets, rows_per_bucket=7).collect()
    for rank in {r["rank"] for r in got}:
        own = sorted((r.upto, r["size"]) for r in got if r["rank"] == rank)
        assert own[-1][0] == sum(size for _, size in own)
        nonzero = [x for x in own if x[1]]
        assert all(b[0] - b[1] == a[0] for a, b in zip(nonzero, nonzero[1:]))


def test_mix_is_sorted_and_follows_the_plan(spark):
    rows, docs = documents(spark, 5, 120)
    plan = {(r.doc_id, r.place): r.rounds for r in op10_mixing.mix_plan(docs.dropDuplicates(["doc_id", "text"])).collect()}
    mix = op10_mixing.mixed(docs.dropDuplicates(["doc_id", "text"])).collect()
    assert len(mix) == sum(plan.values())
    assert [r.mix_finish for r in mix] == sorted(r.mix_finish for r in mix)


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert op10_mixing.mix_plan(spark.createDataFrame([], schema)).count() == 0
    got = op10_mixing.mix_plan(spark.createDataFrame([(1, None, None), (2, " ", "a")], schema)).collect()
    assert [(r["size"], r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2
