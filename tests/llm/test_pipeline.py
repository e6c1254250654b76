import random
import re
from collections import Counter

import pyarrow as pa

import corpus_pipeline
from adlake.llm import op8_quality

from .texts import WORD, lower

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    found = WORD.findall(lower(text))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def make(tmp_path, spark):
    rnd = random.Random(6)
    pool = ["".join(rnd.choice("etaoinshrdlucm") for _ in range(rnd.randint(2, 8))) for _ in range(900)]
    line = lambda k: " ".join(rnd.choice(pool) for _ in range(k))
    doc = lambda: "\n".join(line(rnd.randint(8, 30)) for _ in range(rnd.randint(5, 12)))
    bench = [line(18) for _ in range(5)]
    texts = [doc() for _ in range(40)]
    clean = len(texts)
    texts += [texts[0], texts[1]]  # exact copies
    words = texts[2].split(" ")
    for _ in range(3):  # near copies without equal lines
        texts.append(" ".join(w + "x" if i % 41 == 7 else w for i, w in enumerate(words)).replace("\n", " "))
    texts += [doc() + "\n" + bench[1].upper() + "\n" + doc(), doc() + "\n" + texts[3].split("\n")[0] + "\n" + texts[3].split("\n")[1] + "\n" + doc()]
    texts += ["spam " * 200, None, "", "too short", "a b\n" * 100]
    rows = [(i, t, "en", rnd.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, bench, clean


def test_stages_against_brute_force(spark, tmp_path):
    rows, bench, clean = make(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] for r in rows}

    def step(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, str(tmp_path))
        assert k == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out{k}")
        return spark.read.parquet(f"{tmp_path}/out{k}")

    def held(df):
        return {r.doc_id: r.text for r in df.collect()}

    docs = step(0, docs)
    verdict = [m["kept"] for m in op8_quality.measure(pa.array(list(texts.values()), pa.string())).to_pylist()]
    want = {i: t for (i, t), keep in zip(texts.items(), verdict) if keep}
    assert held(docs) == want and set(range(clean)) <= set(want) and not set(range(len(texts) - 5, len(texts))) & set(want)

    docs = step(1, docs)
    seen, left = set(), {}
    for i in sorted(want):
        lines = want[i].split("\n")
        pairs = list(zip(lines, lines[1:]))
        gone = {j for j, x in enumerate(lines) if len(x) >= 200 and x in seen} | {j + d for j, p in enumerate(pairs) if p in seen for d in (0, 1)}
        seen |= set(pairs) | set(lines)
        kept = [x for j, x in enumerate(lines) if j not in gone]
        if kept:
            left[i] = "\n".join(kept)
    assert held(docs) == left and len(left) < len(want) and set(range(clean)) <= set(left)
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs = step(2, docs)
    ids, parent = sorted(left), {i: i for i in left}
    sets = {i: shingles(left[i]) for i in ids}
    for i in ids:
        for j in ids:
            if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = {k: low if v == high else v for k, v in parent.items()}
    alone = {i: left[i] for i in ids if parent[i] == i}
    assert held(docs) == alone and len(alone) < len(left) and set(range(clean)) <= set(alone)

    docs = step(3, docs)
    windows = {tuple(w[i : i + 10]) for w in (ITEM.findall(lower(b)) for b in bench) for i in range(len(w) - 9)}
    pure = {}
    for i, t in alone.items():
        w = ITEM.findall(lower(t))
        if not any(tuple(w[p : p + 10]) in windows for p in range(len(w) - 9)):
            pure[i] = t
    assert held(docs) == pure and len(pure) < len(alone) and set(range(clean)) <= set(pure)

    mix = step(4, docs).collect()
    size = {i: len(WORD.findall(t)) for i, t in pure.items()}
    times = Counter(r.doc_id for r in mix)
    assert max(times.values()) <= 3 and all(r.text == pure[r.doc_id] for r in mix)
    assert 0.8 * sum(size.values()) < sum(size[r.doc_id] for r in mix) <= sum(size.values())

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.mix_round, r.text) for r in whole) == sorted((r.doc_id, r.mix_round, r.text) for r in mix)


def test_odd_columns_and_rows(spark, tmp_path):
    long = " ".join(f"word{i * 7 % 997}" for i in range(40_000))  # repeats itself: the rules reject it
    odd = {"__doc": "d", "_lines": "l", "__mix": "m", "__own": 4, "__place": 5, "row": "r", "doc": "o", "gone": 6, "of": 7, "_doc": "a", "kept": 1, "size": None, "k1": 2.5, "cid": "b", "place": "p", "a.b": 3, "mix_finish": "old", "n_words": True}
    texts = [long, None, "", " \n", "x" * 100_000, long, " ".join(f"{i}é" for i in range(80)), " ".join(f"{i}é" for i in range(80))]
    rows = [(None if i == 6 else i % 6, t, None, None if i % 2 else "s", None, *odd.values()) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, __doc string, _lines string, __mix string, __own int, __place int, row string, doc string, gone int, of int, _doc string, kept int, size string, k1 double, cid string, place string, `a.b` int, mix_finish string, n_words boolean"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(None, None), (1, ""), (2, "no such words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType, name
        n = out.count()
        kept = [c for c in odd if c not in ("mix_finish", "a.b")]
        assert {tuple(r) for r in out.select(*kept).collect()} <= {tuple(odd[c] for c in kept)}, name
        assert n == {0: 0, 1: n, 2: 6, 3: 8}.get(k, n), (name, n)
    assert set(docs.columns) <= set(out.columns) and dict(out.dtypes)["mix_finish"] == "double"


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    odd = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long, __doc string, _lines string, __mix string, __own int, __place int")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd, str(tmp_path))
        assert out.count() == 0 and out.columns[: len(odd.columns)] == odd.columns, name
