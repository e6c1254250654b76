import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from adlake.llm import op12_periods

from .texts import AWKWARD, WORD


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(w):
    """All (start, length, period) with length >= max(6, 4 * period), by trying
    every period at every place."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out[i, q] = (i, length, q)
            i = j
    return sorted(out.values(), key=lambda r: (r[0], r[2]))


def tail(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, plant=True):
    w = WORD.findall(text or "")
    w = tail(doc_id, w) if plant else w
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)), len(w))


def periodic(rnd, letters, n):
    """Words with runs of many periods, some inside the periods of others."""
    w = []
    while len(w) < n:
        kind = rnd.random()
        if kind < 0.3:
            w += [rnd.choice(letters) for _ in range(rnd.randint(1, 6))]
        else:
            part = w[-rnd.randint(1, 30):] if kind < 0.5 and w else [rnd.choice(letters) for _ in range(rnd.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 23]))]
            w += part * rnd.randint(2, 6) + part[: rnd.randint(0, len(part))]
    return w[:n]


@pytest.mark.parametrize("seed", range(60))
def test_all_runs_agree_with_brute_force(seed):
    rnd = random.Random(seed)
    texts = [periodic(rnd, "ab" if seed % 3 else "abcdefgh", rnd.choice([0, 1, 3, 4, 5, 20, 90, 250])) for _ in range(5)]
    texts.append(["a"] * rnd.randint(0, 200))
    flat = np.array([ord(x) * 7919 for t in texts for x in t], np.uint64)
    of = np.append(0, np.cumsum([len(t) for t in texts]))
    got = op12_periods.all_runs(flat, of)
    want = [(s + o, s + o + n, q) for t, o in zip(texts, of.tolist()) for s, n, q in brute_runs(t) ]
    got = [r for r in map(tuple, got.tolist()) if r[1] - r[0] >= 6]
    assert got == sorted(want)


def test_report_agrees_with_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(periodic(rnd, ["a", "b", "é", "Ab"], rnd.randint(0, 120)))) for i in range(80)]
    rows += [(200 + i, t) for i, t in enumerate(AWKWARD) if t is None or len(t) < 5000]
    rows += [(None, "x " * 50), (None, None), *rows[:3], (-10, "a b " * 9)]
    docs = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], "doc_id long, text string, _periods string, w int")
    got = op12_periods.report(op12_periods.with_repeated_tails(docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(i, t) for i, t in rows), key=str)
    assert sum(r.n_runs > 0 for r in got) > 40


def test_long_text_is_read_whole(spark):
    w = [str(i) for i in range(60_000)] + ["p", "q", "r", "s", "t"] * 9 + [str(i) for i in range(40_000)] * 5
    docs = spark.createDataFrame([(1, " ".join(w)), (2, "z " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in op12_periods.collapsed(docs).select("doc_id", "_periods.*").collect()}
    assert [tuple(r) for r in got[1].runs] == [(60_000, 45, 5), (60_045, 200_000, 40_000)]
    assert got[1].kept == " ".join(w[:60_005] + w[60_045:100_045])
    assert [tuple(r) for r in got[2].runs] == [(0, 300_000, 1)] and got[2].kept == "z"


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a a a a a a", "mine", "t")], "doc_id long, text string, _periods string, kept string")
    out = op12_periods.collapsed(docs)
    assert out.columns == ["doc_id", "text", "kept", "_periods"]
    assert out.select("text", "kept", "_periods.kept").collect()[0] == ("a a a a a a", "t", "a")
    assert op12_periods.report(op12_periods.with_repeated_tails(docs.limit(0))).count() == 0
