import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import op3_suffixes as op3

from .texts import AWKWARD


def brute(rows, match):
    bodies = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(b[i : i + match] for b in bodies for i in range(len(b) - match + 1))
    out = []
    for (doc_id, *_), b in zip(rows, bodies):
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if count[b[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, match, n=40):
    rnd = random.Random(seed)
    noise = lambda k: "".join(rnd.choice("abcdeé 😀\n") for _ in range(k))
    passages = [noise(rnd.choice([match // 2, match - 8, match, match + 1, match + 17, 3 * match])) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = [rnd.choice([lambda: noise(rnd.randint(0, match)), lambda: rnd.choice(passages), lambda: rnd.choice(passages)[rnd.randint(0, 20):]])() for _ in range(rnd.randint(1, 5))]
        out.append("".join(parts))
    base = noise(4 * match)
    for _ in range(6):  # near copies
        copy = list(base)
        for _ in range(3):
            copy[rnd.randrange(len(copy))] = "X"
        out.append("".join(copy))
    out += ["ab" * match, "a" * (2 * match), "abc" * match + noise(5), *out[:3], *AWKWARD]
    return [(i if rnd.random() < 0.97 else None, t, "clash", 3) for i, t in enumerate(out)] + [(0, out[0], "clash", 3)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, at long")


@pytest.mark.parametrize("seed,match,window,batches", [(1, 60, 30, 4), (2, 60, 20, 1), (3, 40, 17, 5), (4, 400, 256, 4)])
def test_agrees_with_brute_force(spark, seed, match, window, batches):
    rows = corpus(seed, match)
    want = brute(rows, match)
    assert sum(w[2] > 0 for w in want) > 10 and sum(w[2] == 0 for w in want) > 10
    assert sorted(map(tuple, op3.report(frame(spark, rows).repartition(3), match, window, batches).collect()), key=str) == want


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(op3, "PIECE", 512)
    rows = corpus(5, 60, n=25)
    rows.append((900, rows[0][1] + rows[1][1] * 3 + rows[2][1], "clash", 3))
    assert sorted(map(tuple, op3.report(frame(spark, rows), 60, 30).collect()), key=str) == brute(rows, 60)
    assert op3.report(frame(spark, rows).limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    index, shared, seen = op3.Levels(), [], Counter()
    for b in range(11):
        seeds = [random.Random(b).randrange(60) for _ in range(12)]
        seen.update(seeds)
        for df in index.add(spark.createDataFrame([(s, 1) for s in seeds], "seed long, n int")):
            shared += [r.seed for r in df.collect()]
        ranks = [rank for rank, _ in index.levels]
        assert ranks == sorted(ranks, reverse=True) and len(ranks) <= 5
    assert set(shared) == {s for s, n in seen.items() if n > 1}


def test_index_takes_new_tables(spark, tmp_path):
    """Batches one after the other, by index objects of their own, and one that
    fails: each batch loses what it shares with itself and all before."""
    rows, folder = corpus(6, 60, n=36), str(tmp_path / "index")
    parts = [rows[i::5] for i in range(5)]
    seen = []
    for no, part in enumerate(parts):
        docs = frame(spark, part).repartition(2)
        if no == 2:
            broken = docs.withColumn("text", F.when(F.col("doc_id") >= 0, F.raise_error(F.lit("broken"))).otherwise(F.col("text")).cast("string"))
            with pytest.raises(Exception, match="broken"):
                op3.SuffixIndex(spark, folder, 60, 30).add(broken)
        got = {(r.k1, r.k2): (r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in op3.SuffixIndex(spark, folder, 60, 30).add(docs).collect()}
        seen += part
        own = {}
        counts = Counter(b[i : i + 60] for b in ((t or "").encode() for _, t, *_ in seen) for i in range(len(b) - 59))
        for _, text, *_ in part:
            body = (text or "").encode()
            gone = bytearray(len(body))
            for i in range(len(body) - 59):
                if counts[body[i : i + 60]] > 1:
                    gone[i : i + 60] = b"\1" * 60
            if any(gone):
                runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
                own[text] = (sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(body, gone) if not g)).hexdigest())
        assert sorted(got.values()) == sorted(own.values())
    ranks = [rank for rank, _ in op3.SuffixIndex(spark, folder).table.manifest()[1]["levels"]]
    assert ranks == sorted(ranks, reverse=True) and len(ranks) <= 3


def test_anchors_follow_the_content():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 300, dtype=np.uint8)
    chosen = []
    for lead in (0, 5, 77):
        data = np.concatenate([rng.integers(97, 123, lead, dtype=np.uint8), body, rng.integers(97, 123, 40, dtype=np.uint8)])
        valid = np.zeros(len(data), bool)
        valid[lead : lead + 200] = True
        at, lo, hi = op3.anchors(data, valid, 100, 30)
        chosen.append({int(p) - lead: int(a) - lead for a, x, y in zip(at, lo, hi) for p in range(x, y + 1)})
    assert chosen[0] == chosen[1] == chosen[2] and set(chosen[0]) == set(range(200))
