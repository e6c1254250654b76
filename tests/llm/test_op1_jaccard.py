import random

import numpy as np
import pytest

from adlake.llm import op1_jaccard as op1
from adlake.llm.components import connected

from .texts import AWKWARD, WORD, lower, random_texts


def shingles(text, k=5):
    found = WORD.findall(lower(text))
    return {tuple(found[i : i + k]) for i in range(len(found) - k + 1)} if len(found) >= k else ({tuple(found)} if found else set())


def _find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute(rows, percent=75):
    sets = [shingles(t) for _, t, *_ in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[_find(parent, i)] = _find(parent, j)
                links[i], links[j] = links[i] + 1, links[j] + 1
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = _find(parent, i)
            least[root] = min(r[0], least.get(root, r[0]))
    return sorted(((r[0], len(sets[i]), least.get(_find(parent, i)), links[i]) for i, r in enumerate(rows)), key=str)


def corpus(seed, n=60, families=6):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    text = lambda k: [rnd.choice(pool) for _ in range(k)]
    passage = text(25)
    out = [" ".join(text(rnd.randint(1, 60))) for _ in range(n)]
    for _ in range(families):
        base = text(rnd.choice([6, 12, 40, 120]))
        for _ in range(rnd.randint(2, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 18))):
                copy[rnd.randrange(len(copy))] = rnd.choice(pool)
            copy = copy[: len(copy) - rnd.randint(0, 3)] + rnd.choice([[], [], passage[: rnd.randint(0, 25)]])
            out.append(rnd.choice([" ", "\n"]).join(copy).upper() if rnd.random() < 0.2 else " ".join(copy))
    out += [" ".join(passage)] * 3 + out[:4] + AWKWARD + random_texts(seed, 20, vocabulary=5, longest=30)
    rnd.shuffle(out)
    rows = [(i * 7 % len(out) if rnd.random() < 0.97 else None, t, "clash", 5) for i, t in enumerate(out)]
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, cid string, n long")


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert len({w[2] for w in want}) < len(want) - 15
    assert sorted(map(tuple, op1.report(frame(spark, rows).repartition(3)).collect()), key=str) == want


def test_small_blocks_buckets_and_leaves(spark, monkeypatch):
    for name, value in (("BUCKET_SHINGLES", 50), ("BLOCK_SHINGLES", 200), ("LEAF_SETS", 3), ("LEAF_SHINGLES", 400)):
        monkeypatch.setattr(op1, name, value)
    rows = corpus(3, n=30, families=5)
    assert sorted(map(tuple, op1.report(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_messages_follow_the_shingles_not_the_buckets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64)) for _ in range(40)]
    heads = [(i, True, i, i, len(s), np.void(bytes(16)), 0) for i, s in enumerate(sets)]
    send = op1._send(1 << 24, 5).__closure__
    block_messages = next(c.cell_contents for c in send if callable(c.cell_contents))
    batch = block_messages(7, heads, sets)
    assert 1900 < batch.num_rows <= 2001
    order, at = op1._cut(np.concatenate(sets), 1 << 24)
    assert sorted(x for p, q in at.values() for x in range(p, q)) == list(range(len(order)))


def test_many_partitions_in_one_task(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = corpus(5, n=40, families=8)
        assert sorted(map(tuple, op1.report(frame(spark, rows).repartition(6)).collect()), key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_of_each(spark):
    rows = corpus(4, n=20, families=4)
    docs = frame(spark, rows)
    kept = op1.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    groups = {}
    for r, (_, n, c, _) in zip(sorted(rows, key=lambda r: str((r[0], len(shingles(r[1]))))), brute(rows)):
        groups.setdefault(("alone", id(r)) if n == 0 else c, []).append(r)
    bare = [r for r in rows if not shingles(r[1])]
    assert sum(not shingles(r.text) for r in kept) == len(bare)
    full = [r for r in kept if shingles(r.text)]
    assert len(full) == len({c for i, n, c, _ in brute(rows) if n})
    assert op1.one_of_each(docs.limit(0)).count() == 0 and op1.report(docs.limit(0)).count() == 0


def test_trees_lose_no_link():
    rng = np.random.default_rng(2)
    for trial in range(30):
        sets = []
        for _ in range(rng.integers(1, 6)):
            base = rng.integers(0, 2**63, rng.integers(1, 80), dtype=np.uint64)
            for _ in range(rng.integers(1, 12)):
                keep = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 1.0])]
                sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, 4), dtype=np.uint64), base[:1]])))
        cut = int(rng.integers(0, len(sets) + 1))
        for left, right in ((sets, None), (sets[:cut], sets[cut:])):
            want = [(i, j) for i in range(len(sets)) for j in range(i) if op1.linked(sets[i], sets[j], 75) and (right is None or j < cut <= i)]
            same = lambda pairs: {x: _find(p, x) for p in [join(pairs)] for x in range(len(sets))}

            def join(pairs):
                p = list(range(len(sets)))
                for i, j in pairs:
                    a, b = _find(p, i), _find(p, j)
                    p[max(a, b)] = min(a, b)
                return p
            every = {tuple(sorted(p)) for p in op1.cell_join(left, right).tolist()}
            assert every == {tuple(sorted(p)) for p in want}
            got = op1.cell_links(left, right)
            assert all(op1.linked(sets[i], sets[j], 75) for i, j in got)
            assert same(got) == same(want)


def test_trees_prune():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(300)]
    tree = op1.SignatureTree(sets, 2048)
    assert len(op1.tree_pairs(tree, tree, 75)) == 0


def test_connected(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(200, x) for x in range(201, 240)]
    parent = list(range(300))
    for a, b in edges:
        a, b = _find(parent, a), _find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: _find(parent, x) for a, b in edges if a != b for x in (a, b)} | {x: _find(parent, x) for a, b in edges for x in (a, b) if _find(parent, x) != x}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0
