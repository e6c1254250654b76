"""Secret scan: fixed patterns, and sliding-window entropy of candidate strings.

A candidate is a long run of key characters.  The Shannon entropy of each
window of `WINDOW` characters is kept up to date by counts: when the window
moves, only the counts of the character that leaves and of the one that comes
change the sum of n*log2(n) (held as integers, so there is no drift).  The
candidate is reported if its best window reaches the limit of its character
class and no allow-list pattern suppresses it.  These patterns judge the whole
candidate: one harmless part doesn't excuse what stands beside it.

DataFrame functions only; every row is scanned where it is read.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # of a longer run of these characters, the whole
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
MIN_VALUE = 8  # a shorter assigned value drops the match, and the scan goes on behind it

WINDOW = 20
#: (class, pattern of the whole candidate, least bits a character in the best window)
CLASSES = (("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), ("one case", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.6), ("any", r"^", 3.8))
_UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
#: Marks of made-up values, and a character eight times over.
_MADE_UP = r"(?i:example|placeholder|changeme|dummy|abcdefgh|12345678|87654321)|(.)\1{7}"
#: A harmless part between separators: a word with a short number, a number, or too short for a key.
_WORDLIKE = r"(?:[A-Za-z]*[0-9]{0,4}|[0-9]*|[A-Za-z0-9]{1,8})(?![A-Za-z0-9])"
ALLOWED = (
    r"^[^0-9]*$", r"^[^A-Za-z]*$",  # words, paths and numbers
    f"^{_UUID}$",
    rf"^(?!.*?(?:(?!{_MADE_UP}).){{{WINDOW}}})",  # no WINDOW characters in a row at which no such mark starts
    r"^wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY$",  # the key of the AWS manual
    # Paths and identifiers of three words and more, without a part that isn't harmless.
    # Words are tried from their first letter only, and whole: a long one costs its length once.
    rf"^(?=.*?(?<![A-Za-z])[A-Za-z]{{2,}}+[/_-](?:[A-Za-z]{{2,}}+[/_-]){{2}})(?!.*?(?<![A-Za-z0-9])(?!{_WORDLIKE}|{_UUID}|(?<=[0-9a-fA-F]{{4}}-)[0-9a-fA-F]{{12}}(?![A-Za-z0-9]))[A-Za-z0-9])",
)
_SCALE = 1 << 20
_SUM_CHUNK = 1024


def running_sums(values: Column) -> Column:
    """Inclusive running sums of a bigint array.  Chunks are summed by
    themselves and shifted, as appending to one long array is quadratic."""
    def sums(x: Column, start: Column) -> Column:
        whole = F.aggregate(x, F.array(start), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return F.slice(whole, F.lit(2), F.size(x))

    zero = F.lit(0).cast("bigint")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / _SUM_CHUNK).cast("int") - 1, F.lit(0)))
    chunks = F.transform(starts, lambda c: F.slice(values, c * _SUM_CHUNK + 1, F.lit(_SUM_CHUNK)))
    totals = F.transform(chunks, lambda x: F.aggregate(x, zero, lambda a, v: a + v))
    shifts = F.aggregate(totals, F.array(zero), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    return F.flatten(F.zip_with(chunks, F.slice(shifts, F.lit(1), F.size(chunks)), sums))


def matched(rows: DataFrame, name: str, pattern: str, can: Column) -> DataFrame:
    """Adds the array column `name` of (start, end, body) of every match of
    `pattern` in `_text`, leftmost and not overlapping, in code points.  `can`
    is a cheap necessary condition.  What lies between the matches gives their
    places: split and extract walk the text in the same steps."""
    found = F.when(can, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("_found", found)
    between = F.when(F.size("_found") > 0, F.split("_text", pattern, -1)).otherwise(F.array(F.lit("")))
    rows = rows.withColumn("_between", between)
    sizes = F.transform("_found", lambda x: F.length(x).cast("bigint"))
    ahead = F.concat(F.array(F.lit(0).cast("bigint")), sizes)
    steps = F.zip_with(F.transform("_between", lambda x: F.length(x).cast("bigint")), ahead, lambda a, b: a + b)
    rows = rows.withColumn("_steps", steps)  # a column: lambdas below would compute it anew each time
    rows = rows.withColumn("_starts", F.when(F.size("_found") > 0, running_sums(F.col("_steps"))).otherwise(F.array().cast("array<bigint>")))
    spans = F.zip_with("_found", F.slice("_starts", F.lit(1), F.size("_found")),
                       lambda body, start: F.struct(start.alias("start"), (start + F.length(body)).alias("end"), body.alias("body")))
    return rows.withColumn(name, spans).drop("_found", "_between", "_steps", "_starts")


def least_weight(chars: Column, window: int = WINDOW) -> Column:
    """The least sum of n*log2(n) over the characters of any window, scaled.
    One step a character: the one that leaves, then the one that comes."""
    weight = F.array(*[F.lit(round(n * math.log2(n) * _SCALE) if n else 0).cast("bigint") for n in range(window + 1)])
    start = F.struct(F.lit(0).cast("bigint").alias("now"), F.lit(1 << 60).cast("bigint").alias("least"))

    def step(state: Column, i: Column) -> Column:
        stay = F.slice(chars, F.greatest(i - (window - 1), F.lit(1)), F.least(i - 1, F.lit(window - 1)))
        count = lambda at: F.size(F.filter(stay, lambda x: x == F.get(chars, at)))
        came, left = count(i - 1), count(i - 1 - window)
        now = state["now"] + F.get(weight, came + 1) - F.get(weight, came) + F.when(
            i > window, F.get(weight, left) - F.get(weight, left + 1)).otherwise(0)
        return F.struct(now.alias("now"), F.when(i >= window, F.least(state["least"], now)).otherwise(state["least"]).alias("least"))

    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step)["least"]


def _random_enough(span: Column) -> Column:
    """Of a span with its `body` and `chars`, the array of its characters."""
    body, limit = span["body"], F.lit(None).cast("bigint")
    for _, pattern, bits in reversed(CLASSES):
        limit = F.when(body.rlike(pattern), int((math.log2(WINDOW) - bits) * WINDOW * _SCALE)).otherwise(limit)
    return least_weight(span["chars"]) <= limit


def _allowed(body: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | body.rlike(pattern)
    return out


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and all: arrays of (start, kind, end), kinds numbered as in
    KINDS, sorted.  Base matches that are too short are dropped; entropy spans
    are added and may lie on base spans."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    text = F.col("_text")
    rows = matched(rows, "_assign", ASSIGN, text.contains("=") | text.contains(":"))
    rows = matched(rows, "_access", ACCESS, text.contains("AKIA"))
    rows = matched(rows, "_hex", HEX, text.rlike(r"[0-9a-f]{32}"))
    rows = matched(rows, "_candidate", CANDIDATE, text.rlike(r"[A-Za-z0-9+/_-]{20}"))

    def placed(found: Column, kind: int) -> Column:
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    assigned = F.filter("_assign", lambda s: F.length(F.regexp_extract(s["body"], f"^{ASSIGN}$", 2)) >= MIN_VALUE)
    candidates = F.transform(F.filter("_candidate", lambda s: ~_allowed(s["body"])), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["body"].alias("body"), F.split(s["body"], "").alias("chars")))
    rows = rows.select(
        "doc_id", F.array_sort(F.concat(placed(assigned, 0), placed(F.col("_access"), 1), placed(F.col("_hex"), 2))).alias("base"),
        placed(F.filter(candidates, _random_enough), 3).alias("more"))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("all"))


def _joined(found: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_entropy of
    every row of `docs`.

    Null and empty texts have no spans; repeated rows get equal results; spans
    that start together are ordered by kind; long texts are scanned whole; other
    columns are not read; an empty table gives no rows."""
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("bigint")
    return spans(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                              F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("all").alias("spans"), count(3).alias("n_entropy"))
