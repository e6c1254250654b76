"""Periodic runs of words by string synchronising sets.

A run is a longest stretch of words that repeats with smallest period q; those
of at least EXPONENT * q words are found, all of them, whatever their period.

At each dyadic scale t = 4, 8, 16, ... the synchronising set of a text holds
the positions whose t-word hash, or that of the position t further on, is the
least among positions i..i+t.  Positions inside highly periodic regions (t
words with a period of at most t/4) are left out of the choice.  The choice
depends on the 2t words at i alone, so a run of period t <= q < 2t chooses the
same positions in each of its periods: a position and the next one with the
same 2t words lie exactly q apart.  Such pairs propose a period, which the
words then confirm and extend.  What a scale leaves out has a period of at
most t/4 and is known from smaller scales; periods 1 to 3 are found first, by
comparing words that distance apart.

Why none is missed: a run of smallest period q >= t and 4q words isn't highly
periodic throughout, so one of its first q positions is chosen, and with it the
one q later, whose 2t < 2q words still lie in the run.  2t > q words hold a
whole period, so no nearer position of the run starts with them.

Words are compared by 64-bit hashes.  All texts of a batch are worked on at
once in numpy; a scale only sees the texts of at least 4t words.  Rows stay in
their tasks: no shuffle, and memory follows the batch or one longer text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tables import own_columns
from adlake.llm.tokens import column_bytes, mix, pieces, word_hashes, words

EXPONENT = 4  # periods in a run, at least
MIN_LENGTH = 6  # words in a run, at least
SMALL_PERIODS = 3  # found without synchronising sets
WORD = r"[^\x20\x09-\x0D]+"

_MOST = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
PERIODS = "n_words long, runs array<struct<start:long,length:long,period:long>>, kept string"
_TYPES = [("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("kept", pa.string())]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours: prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    blocks = np.full((-(-len(x) // width), width), _MOST)
    blocks.ravel()[: len(x)] = x
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:n], upto[width - 1 : width - 1 + n])


def _equal_until(w: np.ndarray, at: int, period: int, end: int) -> int:
    """The first x >= `at` with w[x] != w[x + period], or end - period."""
    step = 64
    while at < end - period:
        to = min(at + step, end - period)
        other = np.flatnonzero(w[at:to] != w[at + period : to + period])
        if len(other):
            return at + int(other[0])
        at, step = to, 2 * step
    return at


def _equal_since(w: np.ndarray, at: int, period: int, begin: int) -> int:
    """The least x <= `at` from which on w[x] == w[x + period] up to `at`."""
    step = 64
    while at > begin:
        to = max(at - step, begin)
        other = np.flatnonzero(w[to:at] != w[to + period : at + period])
        if len(other):
            return to + int(other[-1]) + 1
        at, step = to, 2 * step
    return at


def _small(w: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, period) of the runs with periods up to SMALL_PERIODS."""
    out = []
    for q in range(1, SMALL_PERIODS + 1):
        if len(w) < EXPONENT * q:
            break
        same = np.zeros(len(w) - q + 2, bool)
        same[1:-1] = (w[q:] == w[:-q]) & (text[q:] == text[:-q])
        edges = np.flatnonzero(same[1:] != same[:-1])
        begin, end = edges[::2], edges[1::2] + q
        long = end - begin >= EXPONENT * q
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            if q == 1 or (w[a + 1 : a + q] != w[a]).any():  # else its smallest period is 1
                out.append((a, b, q))
    return out


def _at_scale(w: np.ndarray, ids: np.ndarray, twice: np.ndarray, ends: np.ndarray, begins: np.ndarray,
              t: int, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs with periods t..2t-1.  `ids` and `twice` are hashes of the t and 2t
    words at a position; `known` are the runs with smaller periods."""
    n = len(w)
    if n < 2 * t + 1:
        return []
    place = np.arange(n)
    usable = place + t <= ends
    for a, b, q in known:
        if 4 * q <= t <= b - a:
            usable[a : b - t + 1] = False
    masked = np.where(usable[: len(ids)], ids, _MOST)
    least = _least(masked, t + 1)
    m = min(len(least), len(twice))
    chosen = (place[:m] + 2 * t <= ends[:m]) & (least[:m] != _MOST) & ((masked[:m] == least[:m]) | (masked[t : t + m] == least[:m]))
    at = np.flatnonzero(chosen)
    keys = twice[at]
    order = np.argsort(keys, kind="stable")
    one, next_one = at[order[:-1]], at[order[1:]]
    gap = next_one - one
    pair = (keys[order[:-1]] == keys[order[1:]]) & (gap >= t) & (gap < 2 * t) & (ends[one] == ends[next_one])
    one, gap = one[pair], gap[pair]
    if not len(one):
        return []
    order = np.lexsort((one, gap))
    one, gap = one[order], gap[order]
    head = np.append(True, (gap[1:] != gap[:-1]) | (one[1:] - one[:-1] > gap[1:]))  # else in the same run
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(one)) - 1
    out = set()
    for a, b, q in zip(one[first].tolist(), one[last].tolist(), gap[first].tolist()):
        begin = _equal_since(w, a, q, int(begins[a]))
        end = _equal_until(w, b, q, int(ends[b])) + q
        if end - begin >= EXPONENT * q:
            out.add((begin, end, q))
    return list(out)


def all_runs(w: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period), ordered, of all runs of at least EXPONENT
    periods in the word hashes `w` of several texts; of[i] is the first word of
    text i, with one more entry than texts."""
    sizes = np.diff(of)
    text = np.repeat(np.arange(len(sizes)), sizes)
    live = _small(w, text)
    found = list(live)
    begins, ends = of[:-1][text], of[1:][text]
    origin = np.arange(len(w))  # places in the given `w` of the words still looked at
    ids, t = w, 1
    while True:
        twice = mix(ids[: max(0, len(ids) - t)] * _ODD + ids[t:]) if len(ids) > t else ids[:0]
        if t > SMALL_PERIODS:
            new = _at_scale(w, ids, twice, ends, begins, t, live)
            live = [r for r in live if r[1] - r[0] >= t] + new
            found += [(int(origin[a]), int(origin[a]) + b - a, q) for a, b, q in new]
        t, ids = 2 * t, twice
        stay = ends - begins >= EXPONENT * t
        if not stay.any():
            break
        if not stay.all():  # texts too short for this scale go
            shift = np.append(0, np.cumsum(stay))
            live = [(int(shift[a]), int(shift[a]) + b - a, q) for a, b, q in live if stay[a]]
            ids = np.append(ids, np.zeros(len(w) - len(ids), np.uint64))[stay]
            w, origin, begins, ends = w[stay], origin[stay], shift[begins[stay]], shift[ends[stay]]
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def periods(col: pa.Array, min_length: int = MIN_LENGTH) -> pa.Array:
    """PERIODS of each text of a column as a struct array."""
    raw, offsets = column_bytes(col)
    sizes, counts, flat, kept = [], [], [], []
    for first, last in pieces(offsets):
        data = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        starts, ends, of = words(data, own, "space")
        runs = all_runs(word_hashes(data, starts, ends, lower=False), of)
        runs = runs[runs[:, 1] - runs[:, 0] >= min_length]
        row = np.searchsorted(of, runs[:, 0], side="right") - 1
        at = np.searchsorted(row, np.arange(last - first + 1))
        flat += [(a - f, b - a, q) for (a, b, q), f in zip(runs.tolist(), of[row].tolist())]
        counts += np.diff(at).tolist()
        sizes += np.diff(of).tolist()
        for i in range(last - first):
            tokens = data[own[i] : own[i + 1]].tobytes().split()  # splits at the bytes that separate words
            if at[i + 1] > at[i]:
                gone = np.zeros(len(tokens) + 1, np.int64)
                inside = runs[at[i] : at[i + 1]] - [of[i], of[i], 0]
                np.add.at(gone, inside[:, 0] + inside[:, 2], 1)
                np.add.at(gone, inside[:, 1], -1)
                tokens = [tokens[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            kept.append(b" ".join(tokens))
    flat_runs = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), flat_runs)
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), lists, pa.array(kept, pa.binary()).cast(pa.string())],
                                      fields=[pa.field(*f) for f in _TYPES])


def word_periods(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """Struct of PERIODS of a text column."""

    @arrow_udf(PERIODS)
    def run(col: pa.Array) -> pa.Array:
        return periods(col, min_length)

    return run(text)


def collapsed(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """All rows and columns of `docs` and `_periods` (in place of a column of
    that name): n_words, runs (start, length and period in words, by start,
    then period) and kept, the text with the first period of each run alone.

    A word goes if any run holds it after that run's first period; the others
    are joined by one space.  Null and empty texts have no words, no runs and
    an empty text.  Rows are judged one by one, so repeated rows are judged
    alike; a text is read whole, whatever its length; an empty table gives an
    empty one."""
    return docs.select(*own_columns(docs, "_periods"), word_periods(F.col("text").cast("string"), min_length).alias("_periods"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, chosen by a checksum of
    the id, repeat a part of their words up to the end: with h the unsigned
    CRC-32 of the decimal id and g = h / 10, those with h % 10 = 0 have as word
    i >= a the word a + (i - a) % p, a = g % n, p = 1 + (n - a) / (3 + g % 8).
    Documents without id or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    split = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.floor(h / 10).alias("g"), split.alias("w"))
    n = F.size("w").cast("bigint")
    a = F.col("g") % n
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, 1 + F.floor((n - a) / (3 + F.col("g") % 8))))
    word = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """A row for every row of `docs`: doc_id, n_runs, the longest run (ties:
    first start, then least period; null without runs), and digests of all runs
    and of the text that is kept."""
    rows = collapsed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    best = F.array_max(F.transform("_periods.runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("_periods.runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = rows.select("doc_id", "_periods", best.alias("best"), F.array_join(lines, "").alias("lines"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("_periods.runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("_periods.kept", 256).alias("collapsed_sha256"),
        F.col("_periods.n_words").alias("n_words"))
