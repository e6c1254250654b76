import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from adlake.llm import op5_secrets as op5

from .texts import AWKWARD

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    more = []
    for m in re.finditer(op5.CANDIDATE, text):
        body = m[0]
        if any(re.search(p, body) for p in op5.ALLOWED):
            continue
        bits = next(b for _, p, b in op5.CLASSES if re.search(p, body))
        best = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(body[i : i + 20]).values()) for i in range(len(body) - 19))
        if best >= bits - 1e-6:
            more.append((m.start(), 3, m.end()))
    show = lambda found: ",".join(f"{op5.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    kinds = Counter(k for _, k, _ in base)
    return kinds[0], kinds[1], kinds[2], hashlib.sha256(show(base).encode()).hexdigest(), show(base + more), len(more)


def texts(seed):
    rnd = random.Random(seed)
    draw = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    hexa, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = [
        lambda: f"{rnd.choice(['PassWord', 'token', 'API_key', 'apikey', 'secret', 'passwd'])}{rnd.choice(['', chr(34)])}{rnd.choice([' ', '', '  '])}{rnd.choice(':==')}"
                f"{rnd.choice(['', ' '])}{rnd.choice(['', chr(39)])}{draw(b64, rnd.choice([3, 7, 8, 30]))}{rnd.choice(['', '==', '.x'])}",
        lambda: "AKIA" + draw("ABCXYZ019", rnd.choice([0, 3, 11, 12, 16])), lambda: draw(hexa, rnd.choice([5, 31, 32, 40, 64])),
        lambda: draw(b64, rnd.choice([19, 20, 40, 90])), lambda: draw(hexa.upper(), 40), lambda: draw("ab1", 40), lambda: "the quick é😀 ß",
        lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "some/long/path/of/words2/x", lambda: "EXAMPLE" + draw(b64, 30), lambda: "\n",
        lambda: "password: token:abcdefghijk", lambda: "token=secret=abcdefghij", lambda: "AKIAAKIA" * 3,
    ]
    return ["".join(rnd.choice(parts)() + rnd.choice([" ", "", ",", "é"]) for _ in range(rnd.randint(0, 14))) for _ in range(120)]


def test_agrees_with_brute_force(spark):
    rows = list(enumerate(AWKWARD + texts(1))) + [(None, "token=abcdefgh1"), (3, "x"), (3, "x"), (4, "key " + "q7" * 3000 + " token=" + "a9" * 40)]
    docs = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id long, text string, spans string, base long")
    got = sorted((tuple(r) for r in op5.report(docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sum(r[6] for r in got) > 20 and sum(r[1] for r in got) > 20
    assert op5.report(docs.limit(0)).count() == 0


def test_harmless_parts_do_not_hide_a_secret(spark):
    key = "Zk3vQ9xT7bL2mN8pR4sW6yD1fG5hJ0cA"
    secret = [f"https://hooks.corp.io/api/v/prod/deploy/hook/{key}", f"name_of_the_key_{key}", f"AAAAAAAAAAAAAAAA{key}AAAAAAAAAAAAAAAA==",
              f"12345678{key}", f"{key}/dummy/{key}", f"/docs/example/of/use/{key}", key]
    harmless = ["https://corp.io/api/of/the/house/version2/page/2021/03", "/usr/share/python3/dist/packages/some/module2", "dummy_placeholder_12345678",
                "AAAAAAAAAAAAAAAAAAAAAAAAAAAA1AAAAAAAAAAA", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "a/users/of/the/site/123e4567-e89b-12d3-a456-426614174000"]
    docs = spark.createDataFrame(list(enumerate(secret + harmless)), "doc_id long, text string")
    got = {r.doc_id: r.n_entropy for r in op5.report(docs).collect()}
    assert [got[i] for i in range(len(got))] == [1] * len(secret) + [0] * len(harmless)


def test_long_candidates_are_judged(spark):
    rows = ["ab/" * 100_000 + "x1", "A" * 300_000 + "1", "a1" * 4000]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert [r.n_entropy for r in op5.report(docs).orderBy("doc_id").collect()] == [0, 0, 0]


def test_time_follows_the_length_of_a_run(spark):
    rnd = random.Random(2)
    draw = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    small = "abcdefghijklmnopqrstuvwxyz"

    def seconds(n):
        rows = [draw(small, n) + "1", draw(small + "0123456789", n), draw(small, n // 2) + "/" + draw(small, n // 2) + "/x1", "1" + (draw(small, n // 100) + "_") * 100]
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4).cache()
        docs.count()
        begun = time.time()
        assert {r.doc_id for r in op5.report(docs).collect() if r.n_entropy} >= {0, 1, 2}
        return time.time() - begun

    seconds(1000)  # compiled by now
    short, long = seconds(100_000), seconds(1_000_000)
    assert long < 25 * max(short, 1.0), (short, long)


def test_many_matches_keep_their_places(spark):
    text = "é " + "token=abcdefgh12 😀 " * 3000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = op5.report(docs).collect()[0]
    assert row.n_assign == 3000 and row.spans.split(",")[-1] == "assign:{}:{}".format(*[m.span() for m in ASSIGN.finditer(text)][-1])


def test_running_sums(spark):
    for n in (1, 1023, 1024, 1025, 5000):
        values = [random.Random(n).randint(0, 9) for _ in range(n)]
        got = spark.createDataFrame([(values,)], "v array<bigint>").select(op5.running_sums(F.col("v"))).collect()[0][0]
        assert got == [sum(values[: i + 1]) for i in range(n)] if n < 1100 else got[-1] == sum(values) and len(got) == n
