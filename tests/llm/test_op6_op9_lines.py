import hashlib
import random
import re
from collections import Counter

import pytest

from adlake.llm import op6_lines, op9_units

from .texts import AWKWARD

SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(seed, n=40):
    rnd = random.Random(seed)
    pool = [f"line {i} " + "x" * rnd.choice([0, 5, 300]) for i in range(12)] + ["", "  ", "\t"]
    rows = []
    for i in range(n):
        text = "\n".join(rnd.choice(["", " "]) + rnd.choice(pool).replace("line", rnd.choice(["line", "LINE"])) + rnd.choice(["", " ", "\r"])
                         for _ in range(rnd.randint(1, 12)))
        rows.append((rnd.choice([i, i, i, None]), text, "c", "d"))
    rows += [(100 + i, t, "c", "d") for i, t in enumerate(AWKWARD)] + rows[:4] + [(500, rows[0][1], "c", "d"), (501, "a\nb\n" * 40, "c", "d")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, unit string")


def order_key(row):
    return (row[0] is not None, row[0] or 0)


def brute_lines(rows, min_lines, long_line, key):
    """Distinct (doc_id, text) rows in rank order -> deleted line numbers."""
    docs = sorted({r[:2] for r in rows if r[1] is not None}, key=key)
    seqs = {d: [(i, x.strip(SPACE)) for i, x in enumerate(d[1].split("\n")) if x.strip(SPACE)] for d in docs}
    out = {}
    for d, seq in seqs.items():
        gone = set()
        for n in {min_lines, 1}:
            for p in range(len(seq) - n + 1):
                run = [b for _, b in seq[p : p + n]]
                if n < min_lines and len(run[0]) < long_line:
                    continue
                earlier = any([b for _, b in s[q : q + n]] == run and (key(e), q) < (key(d), p)
                              for e, s in seqs.items() for q in range(len(s) - n + 1))
                if earlier:
                    gone |= {i for i, _ in seq[p : p + n]}
        places = [p for p, (i, _) in enumerate(seq) if i in gone]
        runs = sum(p - 1 not in places for p in places)
        out[d] = (len(seq), len(gone), runs, sha("\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone)))
    return out


def brute_copies(rows, min_lines, key):
    """(doc_id, text) -> number and greatest length of maximal later copies."""
    docs = sorted({r[:2] for r in rows if r[1] is not None}, key=key)
    seqs = [[x.strip(SPACE) for x in d[1].split("\n") if x.strip(SPACE)] for d in docs]
    first, out = {}, {}
    for i, s in enumerate(seqs):
        for p in range(len(s) - min_lines + 1):
            first.setdefault(tuple(s[p : p + min_lines]), (i, p))
    for i, s in enumerate(seqs):
        lengths, before = [], None
        for p in range(len(s) - min_lines + 1):
            j, q = first[tuple(s[p : p + min_lines])]
            if (j, q) == (i, p):
                before = None
                continue
            if before != (j, q - 1):
                n = 0
                while p + n < len(s) and q + n < len(seqs[j]) and s[p + n] == seqs[j][q + n]:
                    n += 1
                lengths.append(n)
            before = (j, q)
        out[docs[i]] = (len(lengths), max(lengths, default=0))
    return out


@pytest.mark.parametrize("seed,min_lines", [(1, 2), (2, 3), (3, 1), (4, 4)])
def test_op6_agrees_with_brute_force(spark, seed, min_lines):
    rows = documents(seed)
    docs = frame(spark, rows)
    keys = {(r.doc_id, r.text): (r.doc_id is not None, r.doc_id or 0, r.k1, r.k2)
            for r in docs.withColumn("d", op6_lines.document_key()).select("doc_id", "text", "d.k1", "d.k2").collect()}
    want = brute_lines(rows, min_lines, 200, lambda d: keys[d[:2]])
    copies = brute_copies(rows, min_lines, lambda d: keys[d[:2]])
    got = op6_lines.report(docs, min_lines=min_lines).collect()
    expected = [(r[0], *want.get(r[:2], (0, 0, 0, sha(""))), *copies.get(r[:2], (0, 0))) for r in rows]
    assert max(r.longest_run for r in got) > min_lines
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def brute_units(rows, separator, min_chars, key):
    seen, out = set(), {}
    for d in sorted({r[:2] for r in rows if r[1] is not None}, key=key):
        kept, spans, at, parts = [], [], 0, re.split(f"({separator})", d[1])
        for i in range(0, len(parts), 2):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", parts[i]).lower().strip(" ")
            if len(norm) >= min_chars and norm in seen:
                spans.append((at, at + len(parts[i])))
            else:
                kept += [parts[i], parts[i + 1] if i + 1 < len(parts) else ""]
            if len(norm) >= min_chars:
                seen.add(norm)
            at += sum(map(len, parts[i : i + 2]))
        out[d] = ((len(parts) + 1) // 2, len(spans), sum(e - s for s, e in spans), ",".join(f"{s}:{e}" for s, e in spans), sha("".join(kept[:-1])))
    return out


def brute_passages(rows, least):
    """(doc_id, text) -> runs of sentences that all occur twice or more."""
    docs = {r[:2] for r in rows if r[1] is not None}
    split = {d: [u for u in (re.sub(r"[\x20\x09-\x0D]+", " ", x).lower().strip(" ") for x in re.split(op9_units.SENTENCE, d[1])) if u] for d in docs}
    seen = Counter(u for units in split.values() for u in units)
    out = {}
    for d, units in split.items():
        runs, run = [], 0
        for u in [*units, None]:
            if u is not None and seen[u] > 1:
                run += len(u)
            else:
                runs, run = runs + [run], 0
        out[d] = (sum(n >= least for n in runs), sum(n for n in runs if n >= least))
    return out


@pytest.mark.parametrize("seed,unit,min_chars", [(1, "line", 6), (2, "line", 60), (3, "paragraph", 6), (4, "line", 1)])
def test_op9_agrees_with_brute_force(spark, seed, unit, min_chars):
    rows = documents(seed)
    rnd = random.Random(seed)
    rows += [(700 + i, "".join(rnd.choice([f"only {i} {j}. ", "a sentence that is here twice? ", "short! ", "line 3 \n", "é.x. "]) for j in range(25)), "c", "d") for i in range(12)]
    docs = frame(spark, rows)
    keys = {(r.doc_id, r.text): (r.doc_id is not None, r.doc_id or 0, r.k1, r.k2)
            for r in docs.withColumn("d", op9_units.document_key()).select("doc_id", "text", "d.k1", "d.k2").collect()}
    want = brute_units(rows, op9_units.SEPARATORS[unit], min_chars, lambda d: keys[d[:2]])
    held = brute_passages(rows, 30)
    got = op9_units.report(docs, unit, min_chars, 30).collect()
    expected = [(r[0], *want.get(r[:2], (0, 0, 0, "", sha(""))), *held.get(r[:2], (0, 0))) for r in rows]
    assert len({r.n_passages for r in got}) > 2
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_passages_inside_lines_are_found(spark):
    """Passages of 51 words and more, in the middle of other lines, are held by
    every document they were put into, and other documents hold none."""
    rnd = random.Random(12)
    pool = ["".join(rnd.choice("etaoinshrdlucm") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    sentence = lambda: " ".join(rnd.choice(pool) for _ in range(rnd.choice([1, 2, 5, 9, 14]))).capitalize() + "."
    prose = lambda words: " ".join(sentence() for _ in range(words // 6))

    def passage():
        out = []
        while len(" ".join(out).split()) <= 50:
            out.append(sentence())
        return rnd.choice([" ", "\n"]).join(out)

    planted = [passage() for _ in range(20)]
    rows, holds = [], set()
    for i in range(400):
        words = prose(150).split(" ")
        if i < 80:
            words.insert(rnd.randint(0, len(words)), planted[i % 20])
            holds.add(i)
        rows.append((i, " ".join(words)))
    got = {r.doc_id for r in op9_units.report(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_passages}
    assert len(got & holds) >= 76 and len(got - holds) <= 4


def test_empty_tables_and_columns(spark):
    empty = frame(spark, [])
    assert op6_lines.report(empty).count() == 0 and op9_units.report(empty).count() == 0
    docs = frame(spark, [(1, "a", "mine", "own")])
    assert op6_lines.deduplicated(docs).columns == [*docs.columns, "_lines"]
    assert op9_units.deduplicated(docs).select("kept", "unit").collect()[0] == ("mine", "own")
