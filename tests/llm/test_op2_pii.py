import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from adlake.llm import op2_pii as op2

from .texts import AWKWARD

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, body):
    d = re.sub("[^0-9]", "", body)
    return (True, all(int(x) <= 255 for x in body.split(".")) if kind == 1 else True, 16 <= len(d) <= 19 and luhn(d), 8 <= len(d) <= 15)[kind]


def brute(text):
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good(k, m[0])]


def texts(seed, n=300):
    rnd = random.Random(seed)
    num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def card():
        d = num(15)
        return next(d + c for c in "0123456789" if luhn(d + c))

    parts = [lambda: f"{num(2)}.a@m{num(1)}.example.com", lambda: "a@b", lambda: "x@@y.z.", lambda: "é@a.b", lambda: "a.b@c-d.e.f@g.h",
             lambda: ".".join(str(rnd.randint(0, 300)) for _ in range(rnd.randint(3, 6))), lambda: card(), lambda: " ".join(re.findall("....", card())),
             lambda: num(16), lambda: num(40), lambda: f"+1 ({num(3)}) 555-{num(4)}", lambda: f"+{num(9)}", lambda: "+1 () ", lambda: "😀 word", lambda: "-", lambda: "\n",
             lambda: num(1), lambda: "1.2.3.4.5.6.7.8", lambda: "0" * 30 + ".1.2.003"]
    return ["".join(rnd.choice(parts)() + rnd.choice(["", " ", ",", "é"]) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_base_spans_agree_with_the_plain_patterns():
    for t in [x or "" for x in AWKWARD] + texts(1):
        assert op2.base_spans(t) == brute(t), t


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1+@. -()é2", max_size=60))
def test_base_spans_of_any_text(t):
    assert op2.base_spans(t) == brute(t)


SPELT = re.compile(op2._SPELT + op2._DOMAIN_PART, re.I | re.A)


def test_spelt_out_addresses_agree_with_the_plain_pattern():
    rnd = random.Random(11)
    parts = ["a", "b.c", "x" * 70, "@", "[at]", "(AT)", " at ", " ", "at", " at at ", ".", "[dot]", " dot ", "(dot)", "é", "-", "ſ", "dot", "\n"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert list(op2.spelt_out(t)) == [m.span() for m in SPELT.finditer(t)], t


def test_every_sign_alone_gives_a_candidate():
    for at in ("@", "[at]", "(at)", " at ", " [at] ", " (at) ", " @ ", " At "):
        for dot in (".", "[dot]", "(dot)", " dot ", " . "):
            t = f"please write to jane.miller{at}example{dot}com today"
            kinds = [c[:3] for c in op2.scan(t)[1]]
            assert kinds == [(0, 16, t.index("com") + 3)], t
            alone = f"to jane{at}example"
            assert op2._SIGN_BYTES.search(alone.encode()) and [c[:3] for c in op2.scan(alone)[1]] == [(0, 3, len(alone))]


def test_scan_is_linear_and_keeps_base():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "+1 " * 100_000, "a@" * 150_000, "(1) " * 70_000, "a dot " * 50_000, "a at " * 60_000, "x" * 300_000 + " at ", " at " * 70_000, "a[at]" * 60_000):
        base, found = op2.scan(t)
        assert [x[:3] for x in found if x[4]] == base


def test_report(spark):
    rows = list(enumerate([*AWKWARD, *texts(2, 200)])) + [(None, "mail me: a.b@c.example.com"), (5, "x"), (5, "x")]
    docs = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id long, text string, spans string, base long")
    got = op2.report(docs).collect()
    want = []
    for i, t in rows:
        base = brute(t or "")
        text = ",".join(f"{op2.KINDS[k]}:{a}:{b}" for k, a, b in base)
        want.append((i, *[sum(k == j for k, *_ in base) for j in range(4)], hashlib.sha256(text.encode()).hexdigest()))
        own = [r for r in got if r.doc_id == i]
        assert all(set(text.split(",")) - {""} <= set(r.spans.split(",")) for r in own if r.base_sha256 == want[-1][-1])
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert op2.report(docs.limit(0)).count() == 0


def test_spelt_out_addresses_without_digits_are_reported(spark):
    texts = [f"please write to jane.miller {at} example.com {end}" for at in ("[at]", "(at)", "[AT]", "at") for end in ("today", "on day 7") for _ in range(20)]
    got = op2.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts) and all(r.spans == "email:16:{}".format(texts[r.doc_id].index(".com") + 4) and r.n_added == 1 for r in got)


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.3
    rates = [(0.9, 0.05), (0.8, 0.1), (0.7, 0.2), (0.95, 0.3)]
    cast = np.stack([np.where(rng.random(len(truth)) < np.where(truth, p, q), 1, -1) for p, q in rates], axis=1)
    cast[rng.random(cast.shape) < 0.2] = 0
    patterns, n = np.unique(cast, axis=0, return_counts=True)
    prior, reliability, post = op2.expectation_maximisation(patterns, n.astype(float))
    assert abs(prior - 0.3) < 0.03
    for j, (p, q) in enumerate(rates):
        assert abs(reliability[j, 1, 2] - 0.8 * p) < 0.04 and abs(reliability[j, 0, 2] - 0.8 * q) < 0.04
    index = {tuple(p): c for p, c in zip(patterns, post)}
    assert np.mean([(index[tuple(c)] > 0.5) == t for c, t in zip(cast, truth)]) > 0.9


def test_held_out_accuracy_of_added_spans():
    rnd = random.Random(8)
    num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def sample(real):
        if real:
            return rnd.choice(["call ", "tel ", "phone: "]) + f"({num(3)}) {num(3)}-{num(4)}" if rnd.random() < 0.5 else f"phone {num(3)} {num(3)} {num(4)}"
        return rnd.choice([f"date {rnd.randint(1950, 2030)}-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}", f"order {num(8)}", f"invoice no {num(7)}"])

    made = [(r, "words " + sample(r)) for r in (rnd.random() < 0.5 for _ in range(2000))]
    counts = {}
    for _, t in made[:1000]:
        for c in op2.scan(t)[1]:
            counts[c[3]] = counts.get(c[3], 0) + 1
    accepted = set(op2.fit(counts).accepted())
    right = [any(c[3] in accepted for c in op2.scan(t)[1]) == real for real, t in made[1000:]]
    assert sum(right) / len(right) > 0.9
    assert op2.fit({}).accepted() == []
