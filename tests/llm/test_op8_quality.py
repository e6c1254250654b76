import random
import re
from collections import Counter
from pydoc_data import topics

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adlake.llm import op8_quality

from .texts import AWKWARD, WORD, random_texts


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(found) < 50 or 100 * len(hit) > 50 * len(found))


def measured(texts):
    return [tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            for r in op8_quality.measure(pa.array(texts, pa.string())).to_pylist()]


def test_base_measures():
    texts = AWKWARD + random_texts(1, 60) + [t.replace("a", "#|") for t in random_texts(2, 20, vocabulary=6)]
    assert measured(texts) == [brute(t) for t in texts]
    assert measured(texts[3:9]) == [brute(t) for t in texts[3:9]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t#\x0b"), max_size=6))
def test_base_measures_of_any_text(texts):
    assert measured(texts) == [brute(t) for t in texts]


def test_bands(spark):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(rnd.choice(vocabulary) for _ in range(900))
    noise = " ".join("".join(rnd.choice([chr(c) for c in range(33, 0x250) if c not in range(0x7F, 0xA1)]) for _ in range(6)) for _ in range(900))
    varied = "\n".join(f"entry {i} of the list is the same as the one before" for i in range(300))
    half = prose + "\n" + noise * 2
    rows = [(1, prose, "x"), (2, noise, "x"), (3, varied, "x"), (4, None, "x"), (5, half, "x"), (1, prose, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in op8_quality.quality(docs).collect()}
    assert got[1].kept and not got[1].base_failed
    assert not got[2].kept and not got[2].base_failed and got[2].ratio < 1.6
    assert not got[3].kept and got[3].ratio > 3
    assert not got[4].kept and got[4].base_failed and got[4].ratio is None
    assert not got[5].kept and got[5].n_bad_chunks > 1
    kept = op8_quality.kept_documents(docs).collect()
    assert [(r.doc_id, r.kept) for r in kept] == [(1, "x"), (1, "x")]
    empty = docs.limit(0)
    assert op8_quality.quality(empty).count() == 0 and op8_quality.kept_documents(empty).columns == docs.columns


def test_long_texts_are_streamed():
    text = b"0123456789 abcdefghij " * 500_000
    packer = op8_quality.zstandard.ZstdCompressor(level=3)
    assert op8_quality.compressed_bytes(packer, memoryview(text)) < len(text) / 100


HINDI = (
    "गाँव के किनारे एक पुराना बरगद का पेड़ था जिसकी छाया में दोपहर को किसान आराम करते थे। "
    "सुबह होते ही औरतें कुएँ से पानी भरने निकल जातीं और बच्चे अपने बस्ते उठाकर पाठशाला की ओर दौड़ते। "
    "इस साल बारिश देर से आई, इसलिए लोगों ने मिलकर तालाब की मिट्टी निकाली और नई नहर खोदी। "
    "जब पहली बूँदें गिरीं तो सबके चेहरे खिल उठे, क्योंकि धान की फसल अब बच सकती थी। "
    "शाम को चौपाल पर बूढ़े दादा ने बताया कि उनके बचपन में नदी कितनी चौड़ी हुआ करती थी।")


def test_clean_long_and_non_latin_texts_are_kept():
    manual = [t for t in topics.topics.values() if len(t) > 10_000]
    got = op8_quality.measure(pa.array([HINDI, *manual], pa.string())).to_pylist()
    assert len(manual) > 5 and all(m["kept"] for m in got)
    assert got[0]["ratio"] > 2.25 and max(m["ratio"] for m in got) > 2.8


def test_repetitive_texts_go_in_any_script():
    rows = [" ".join(f"{w}{i}" for i in range(300) for w in ws) for ws in (("line",), ("पंक्ति",), ("строка", "та"))]
    got = op8_quality.measure(pa.array(rows, pa.string())).to_pylist()
    assert not any(m["kept"] or m["base_failed"] for m in got)
