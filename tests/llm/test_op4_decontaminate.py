import gc
import hashlib
import random
import re

from adlake.llm import op4_decontaminate as op4

from .texts import AWKWARD, lower, random_texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, bench, window=10):
    out = []
    windows = {}
    for item, text in bench:
        found = WORD.findall(lower(text))
        for i in range(max(1, len(found) - window + 1) if found else 0):
            windows.setdefault(tuple(found[i : i + window]), set()).add(item)
    for doc_id, text, *_ in docs:
        found = WORD.findall(lower(text))
        hit, items = set(), set()
        for w, ids in windows.items():
            for p in range(len(found) - len(w) + 1):
                if tuple(found[p : p + len(w)]) == w:
                    hit.update(range(p, p + len(w)))
                    items |= {str(x) for x in ids if x is not None}
        out.append((doc_id, len(found), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, bench, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, items string, n_words string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    return sorted((tuple(r)[:6] for r in op4.report(d, b, **kw).collect()), key=str)


def planted(seed):
    rnd = random.Random(seed)
    bench = list(enumerate(random_texts(seed, 25, vocabulary=12, longest=25))) + [(7, "One two"), (8, "one"), (9, None), (10, "..."), (None, "a b c d e f g h i j k")]
    bench += bench[:3]
    docs = []
    for i, t in enumerate(random_texts(seed + 1, 40, vocabulary=12, longest=60)):
        if rnd.random() < 0.5:
            t += rnd.choice(["", "x ", "X! "]) + (rnd.choice(bench)[1] or "").upper() + rnd.choice([" ", "-end"]) + t[:30]
        docs.append((i, t, "x", "y"))
    docs += [(100 + i, t, None, None) for i, t in enumerate(AWKWARD)] + [(None, "a-B c_d e`f g{h i\x7fj k", None, None)]
    return docs + docs[:2], bench


def test_agrees_with_brute_force(spark):
    for seed in (1, 2):
        docs, bench = planted(seed)
        want = brute(docs, bench)
        assert any(r[5] for r in want) and not all(r[5] for r in want)
        assert run(spark, docs, bench) == want


def test_blocks_and_empty_tables(spark):
    docs, bench = planted(3)
    assert run(spark, docs, bench, block_windows=40) == brute(docs, bench)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], bench) == []
    d = spark.createDataFrame(docs, "doc_id long, text string, items string, n_words string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    for size in (40, 100_000):
        clean = op4.clean_documents(d, b, block_windows=size)
        assert clean.columns == d.columns and clean.count() == sum(not r[5] for r in brute(docs, bench))


def test_only_one_block_is_held(spark, monkeypatch):
    """Twenty blocks: when a block is read, the index before is gone."""
    docs, bench = planted(4)
    alive, read = [], op4.read_block

    def watched(*args):
        gc.collect()
        alive.append(sum(isinstance(x, op4.Index) for x in gc.get_objects()))
        return read(*args)

    monkeypatch.setattr(op4, "read_block", watched)
    n = op4.benchmark_windows(spark.createDataFrame(bench, "item_id long, text string"))[0].count()
    assert run(spark, docs, bench, block_windows=-(-n // 20)) == brute(docs, bench)
    assert len(alive) >= 15 and max(alive) <= 1, alive


def test_a_window_that_many_items_share(spark):
    phrase = "the same ten words stand in every one of these items"
    bench = [(i, phrase + f" and {i}") for i in range(700)]
    docs = [(i, f"x {phrase} y{i}", None, None) for i in range(60)]
    got = run(spark, docs, bench)
    assert got == brute(docs, bench) and got[0][3] == 700
