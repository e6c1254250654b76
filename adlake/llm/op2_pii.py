"""Personal data by weak supervision.

A scan of each text finds the base spans (fixed patterns) and looser candidate
spans.  Labelers vote on every candidate: pattern, checksum, gazetteer and
context rules, each for, against or abstaining.  Candidates are counted by kind,
votes and shape over the whole corpus - a table whose size is bounded by the
number of vote patterns, whatever the input - and from these counts
expectation-maximisation estimates each labeler's reliability without labels.
Its posteriors train a logistic span classifier on votes and shapes, which
decides on the candidates.  Base spans always stay.

All scanners are linear in the text: pieces are anchored at `@`, `+` or a digit
run and never tried again from inside.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tables import written
from adlake.llm.tokens import column_bytes

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
CONTEXT = 48  # code points before a candidate that context labelers read

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Candidates beyond the base patterns.
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().\-/]{0,2}[0-9])++(?![0-9A-Za-z])")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:[\x20]?(?:\.|\[\.\]|\(dot\))[\x20]?[0-9]{1,4}){3}(?![0-9.])")
_AT, _DOT = r"@|\[at\]|\(at\)|[\x20]at[\x20]", r"\.|\[dot\]|\(dot\)|[\x20]dot[\x20]"
_LOCAL_MOST = 64
_SPELT = rf"[A-Za-z0-9._%+-]{{1,{_LOCAL_MOST}}}[\x20]?"  # before the sign; what follows is _DOMAIN_PART
_DOMAIN_PART = rf"(?:{_AT})[\x20]?[A-Za-z0-9-]{{1,63}}(?:[\x20]?(?:{_DOT})[\x20]?[A-Za-z0-9-]{{1,63}}){{0,6}}"
_SIGN, _SIGN_BYTES = re.compile(f"(?i:{_AT})", re.A), re.compile(f"(?i:{_AT})".encode())
_BEHIND = re.compile(_DOMAIN_PART, re.I | re.A)

# Gazetteers.
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52",
            "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "358",
            "380", "420", "852", "886", "971", "972")
_TLD = frozenset("com org net edu gov info biz io co dev app uk de fr es it nl eu us ca au ch at be se no dk fi pl pt br mx ar jp cn in ru example".split())
_ISSUER = ("34", "37", "35", "36", "38", "4", "51", "52", "53", "54", "55", "60", "62", "65", "67")
_PRIVATE = ("10.", "127.", "192.168.", "172.16.", "169.254.", "0.")

# Context words, by kind.
_NEAR = {
    "email": r"e-?mails?|mail|contact|write|reach|correo|courriel|kontakt|schreib\w*",
    "ip": r"ip|ipv4|host|server|address|login|from|adresse|servidor|serveur",
    "card": r"card|visa|mastercard|credit|debit|payment|tarjeta|carte|karte|kreditkarte",
    "phone": r"tel|phone|telephone|call|mobile|cell|fax|whatsapp|sms|t[eé]l[eé]fono|t[eé]l[eé]phone|telefon|anruf\w*|llam\w*|appel\w*"}
_NEAR = {k: re.compile(rf"(?<!\w)(?:{v})(?!\w)", re.I) for k, v in _NEAR.items()}
_OTHER = re.compile(r"(?<!\w)(?:version|ver|release|section|chapter|page|isbn|issn|order|invoice|id|no|sku|date|year|fig|table|total|price|usd|eur)(?!\w)|[$€£#]\s*$", re.I)
_DATE = re.compile(r"^(?:(?:19|20)[0-9]{2}[./ -][01]?[0-9][./ -][0-3]?[0-9]|[0-3]?[0-9][./ -][0-3]?[0-9][./ -](?:19|20)[0-9]{2}|(?:(?:19|20)[0-9]{2}[ /-]*){2,})$")

LABELERS = ("strict", "checksum", "separators", "gazetteer", "near", "other", "shape")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def spelt_out(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of _SPELT and _DOMAIN_PART, looked for
    from each sign for "at" outwards."""
    done, sign = 0, _SIGN.search(text)
    while sign:
        at = sign.start()
        end = at - 1 if at > done and text[at - 1] == " " else at
        start = end
        while start > max(done, end - _LOCAL_MOST) and text[start - 1] in _LOCAL:
            start -= 1
        behind = _BEHIND.match(text, at) if start < end else None
        if behind:
            yield start, behind.end()
            done = behind.end()
        sign = _SIGN.search(text, done if behind else at + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def votes(kind: str, text: str, start: int, end: int, strict: bool) -> str:
    """A character a labeler: + for, - against, 0 abstains."""
    body, before = text[start:end], text[max(0, start - CONTEXT) : start]
    digits = _digits(body)
    v = {name: "0" for name in LABELERS}
    v["strict"] = "+" if strict else "0"
    if kind == "email":
        name = re.split(r"(?i)@|\[at\]|\(at\)|\sat\s", body, maxsplit=1)
        tail = re.split(r"(?i)\.|\[dot\]|\(dot\)|\sdot\s", name[-1])
        plain = not any(c in body for c in "@[(")  # " at ", as in any sentence
        broken = len(tail) < 2 or re.search(r"\s\.|\.\s", body[len(name[0]) :])  # no dot, or one between sentences
        v["separators"] = "+" if not plain else "-" if broken else "+" if re.search(r"(?i)\sdot\s", body) else "0"
        last = tail[-1].strip().lower()
        listed = last in _TLD  # the list isn't all there is
        v["gazetteer"] = "-" if len(tail) < 2 or not last.isalpha() or len(last) < 2 else "+" if listed else "-" if plain else "0"
        v["shape"] = "-" if len(tail) < 2 else "+" if re.search(r"[0-9._+-]", name[0]) else "0"
    elif kind == "ip":
        parts = [int(x) for x in re.findall("[0-9]+", body)]
        v["checksum"] = "+" if len(parts) == 4 and max(parts) <= 255 else "-"
        v["separators"] = "+" if "[" in body or "(" in body else "0"
        v["gazetteer"] = "+" if body.startswith(_PRIVATE) else "0"
        v["shape"] = "-" if len(parts) == 4 and max(parts) < 20 else "+" if len(digits) >= 8 else "0"
    elif kind == "card":
        v["checksum"] = "+" if luhn(digits) else "-"
        v["separators"] = "+" if re.fullmatch(r"[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}", body) else "0"
        v["gazetteer"] = "+" if digits.startswith(_ISSUER) else "-"
        v["shape"] = "-" if len(set(digits)) < 4 else "0"
    else:
        plain = digits.lstrip("0")
        v["checksum"] = "+" if 9 <= len(digits) <= 13 else "-" if len(digits) < 8 else "0"
        v["separators"] = "+" if re.search(r"[0-9)][ .-][0-9]{3,4}$|\(", body) else "-" if body.isdigit() else "0"
        v["gazetteer"] = "+" if (body.startswith("+") or text[max(0, start - 1) : start] == "+" or digits.startswith("00")) and plain.startswith(_CALLING) else "0"
        v["shape"] = "-" if _DATE.match(body) or len(set(digits)) < 3 else "0"
    v["near"] = "+" if _NEAR[kind].search(before) else "0"
    v["other"] = "-" if _OTHER.search(before[-16:]) else "0"
    return "".join(v[name] for name in LABELERS)


def shape(body: str) -> str:
    """A few buckets of length and make-up."""
    n = len(_digits(body))
    return f"{min(n // 4, 5)}{'s' if ' ' in body else '-'}{'a' if any(c.isalpha() for c in body) else '-'}"


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str, bool]]]:
    """Base spans; candidates (kind, start, end, pattern, is base)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    begins = [a for a, _ in taken]
    ends = sorted(b for _, b in taken)

    def free(a: int, b: int) -> bool:  # touches no base span
        return bisect_left(begins, b) - bisect_right(ends, a) <= 0

    found = [(k, a, b, True) for k, a, b in base]
    found += [(0, a, b, False) for a, b in spelt_out(text) if free(a, b)]
    if _DIGIT.search(text):
        found += [(1, *m.span(), False) for m in _DOTTED.finditer(text) if free(*m.span())]
        dotted = {m.span() for m in _DOTTED.finditer(text)}
        for m in _NUMBER.finditer(text):
            n = len(_digits(m[0]))
            if 7 <= n <= 19 and m.span() not in dotted and free(*m.span()):
                found.append((3 if n <= 12 else 2, *m.span(), False))
    return base, [(k, a, b, f"{KINDS[k]}|{votes(KINDS[k], text, a, b, own)}|{shape(text[a:b])}", own) for k, a, b, own in found]


SCAN = "base array<struct<kind:int,start:int,end:int>>, candidates array<struct<kind:int,start:int,end:int,pattern:string,own:boolean>>"
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct([*_SPAN, ("pattern", pa.string()), ("own", pa.bool_())])


def scanned(text: Column) -> Column:
    """SCAN of a text column.  Rows without a digit or a sign for "at", of which
    every candidate has one, are told apart by their bytes and not decoded."""

    @arrow_udf(SCAN)
    def run(col: pa.Array) -> pa.Array:
        raw, offsets = column_bytes(col)
        base, candidates = [], []
        for a, b in zip(offsets, offsets[1:]):
            body = raw[a:b]
            some = False
            for p in range(0, len(body), 1 << 20):
                part = body[p : p + (1 << 20)]
                some = some or bool((part - np.uint8(48) < 10).any())
            data = body.tobytes()
            if some or _SIGN_BYTES.search(data):
                own, more = scan(data.decode("utf-8", "replace"))
            else:
                own, more = [], []
            base.append([dict(zip(("kind", "start", "end"), x)) for x in own])
            candidates.append([dict(zip(("kind", "start", "end", "pattern", "own"), x)) for x in more])
        return pa.StructArray.from_arrays([pa.array(base, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_CANDIDATE))], names=["base", "candidates"])

    return run(text)


@dataclass
class Model:
    """By kind: prior, labeler reliabilities P(vote | real or not) and the
    classifier's probability of every pattern seen."""

    prior: dict[str, float]
    reliability: dict[str, np.ndarray]  # labeler x (not, real) x (-, 0, +)
    chance: dict[str, float]

    def accepted(self, threshold: float = THRESHOLD) -> list[str]:
        return sorted(p for p, c in self.chance.items() if c >= threshold)


def expectation_maximisation(cast: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Votes (patterns x labelers, -1 0 1) and counts -> prior, reliabilities
    and each pattern's posterior.  Labelers vote independently given the truth;
    weak counts say that they are better than chance."""
    onehot = np.stack([cast == v for v in (-1, 0, 1)], axis=2).astype(float)
    lean = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]])
    post = 1 / (1 + np.exp(-cast.sum(axis=1)))
    prior, reliability = 0.5, np.full((cast.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([n * (1 - post), n * post])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        reliability = np.einsum("yp,pjv->jyv", weight, onehot) + lean
        reliability /= reliability.sum(axis=2, keepdims=True)
        like = np.einsum("pjv,jyv->py", onehot, np.log(reliability)) + np.log([1 - prior, prior])
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -500, 500)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return float(prior), reliability, post


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft labels y with counts n."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(counts: dict[str, int]) -> Model:
    """Pattern counts of a corpus -> model.  An empty corpus accepts nothing."""
    model = Model({}, {}, {})
    for kind in KINDS:
        own = sorted(p for p in counts if p.startswith(f"{kind}|"))
        if not own:
            continue
        cast = np.array([["-0+".index(c) - 1 for c in p.split("|")[1]] for p in own])
        n = np.array([counts[p] for p in own], float)
        model.prior[kind], model.reliability[kind], post = expectation_maximisation(cast, n)
        buckets = sorted({c for p in own for c in enumerate(p.split("|")[2])})
        x = np.column_stack([np.ones(len(own)), cast > 0, cast < 0, *[[p.split("|")[2][i] == c for p in own] for i, c in buckets]]).astype(float)
        w = logistic(x, post, n)
        model.chance |= dict(zip(own, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))
    return model


def pattern_counts(rows: DataFrame) -> dict[str, int]:
    """Counts over all candidates.  At most 4 kinds x 3^7 votes x 24 shapes."""
    found = rows.select(F.explode("s.candidates.pattern").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
    return {r.pattern: r.n for r in found.collect()}


def _joined(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, Model]:
    """(doc_id, base, spans) of every row of `docs`, arrays of (kind, start,
    end) in code points by kind and start; and the model.

    Null and empty texts have no spans; repeated rows count and get equal
    results; other columns are not read."""
    rows = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), scanned(F.col("text").cast("string")).alias("s")), "pii-scan")
    model = fit(pattern_counts(rows))
    accepted = F.array(*[F.lit(p) for p in model.accepted(threshold)]).cast("array<string>")
    added = F.filter("s.candidates", lambda c: ~c["own"] & F.array_contains(accepted, c["pattern"]))
    added = F.transform(added, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return rows.select("doc_id", F.array_sort("s.base").alias("base"), F.array_sort(F.concat("s.base", added)).alias("spans")), model


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Null and empty texts have no spans; repeated rows get equal results; spans
    are ordered by kind, then start, and added ones touch no base span; long
    texts are scanned whole; other columns are not read; an empty table gives
    no rows."""
    rows, _ = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))
