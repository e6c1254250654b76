"""Suffix-array dedup with a logarithmic family of levels.

Removes every byte covered by a string of `match` bytes that also starts
anywhere else.

Sparse suffixes.  Of each `WINDOW` neighbouring 8-byte grams the one of least
hash is an anchor, the leftmost of equals.  A match of `match` bytes has its
first anchor at the same place in both copies, and at least match - WINDOW + 1
bytes from the anchor on are equal.  So only suffixes that start at anchors are
indexed, by a key that orders them by their first bytes and then by a digest of
those match - WINDOW + 1 bytes (the seed).  An anchor owns the strings that
choose it: those that start in [lo, hi].

Levels.  Documents come in batches.  A batch's suffixes become a sorted run,
which is merge-joined with every level of the index for long matches and then
becomes a level itself; two levels of equal size merge into one of twice the
size, so that n batches leave at most log2(n) + 1 levels.

Exact lengths.  Suffixes with matching seeds are told apart by what all the
strings they own cover: equal there, all those strings are repeated.  Where
seeds are equal and this is not, the owned strings are taken in ranges of
`STEP`, and where that leaves doubt, one by one.  At each level one
representative of equal content is enough, and every grouping is a partial
aggregate: a passage that a third of all documents share is no single group.

Texts are known by 128 bits of their content.  Hashes of 64 bits stand for the
compared strings, with the seed key beside them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tables import document_key, maybe_in, written
from adlake.llm.tokens import byte_values, column_bytes, mix, pieces, powers
from adlake.sources.versioned import VersionedTable

MATCH = 400
WINDOW = 256
STEP = 16
BATCHES = 4
PIECE = 1 << 18  # bytes hashed at once; longer texts are taken in overlapping segments
_U = np.uint64
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


class Hasher:
    """64-bit hashes of byte ranges of one piece, by prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(2 * PIECE)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values(False)[data] * up[: len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64) * _A)


def anchors(data: np.ndarray, valid: np.ndarray, match: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, lo, hi) of every anchor that a string starting at a `valid` place
    chooses."""
    places = np.flatnonzero(valid)
    if not len(places):
        return places, places, places
    grams = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * _A
    grams ^= grams >> _U(32)
    grams *= _B
    low = _U((1 << 20) - 1)
    grams = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    n = -(-len(grams) // window) * window
    blocks = np.full(n + window, ~_U(0))
    blocks[: len(grams)] = grams
    blocks = blocks.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(behind[places], ahead[places + window - 1]) & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (places[1:] != places[:-1] + 1)]))
    last = np.append(new[1:], len(places)) - 1
    return chosen[new], places[new], places[last]


def text_pieces(col: pa.Array, match: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, rows, where each row begins in data, first place in the row's
    text) of pieces; only places below the next row's end less match start."""
    raw, offsets = column_bytes(col)
    for first, last in pieces(offsets, PIECE):
        data = raw[offsets[first] : offsets[last]]
        if len(data) <= PIECE:
            yield data, np.arange(first, last), offsets[first:last] - offsets[first], np.zeros(last - first, np.int64)
            continue
        for at in range(0, len(data) - match + 1, PIECE):
            yield data[at : at + PIECE + match - 1], np.array([first]), np.zeros(1, np.int64), np.array([at])


def _local(row: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of one text with equal seed and span are repeats of each other:
    (which to index, how many each stands for, the spans [first, last] of
    suffixes that such repeats own).  A text that repeats itself every few
    bytes has an anchor every few bytes; this leaves one of each kind."""
    key = mix(seed * _A + span * _B + row.astype(np.uint64) * _C)
    _, index, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    repeated = n[inverse] > 1
    order = np.sort(index)
    ends = np.flatnonzero(repeated)
    if len(ends):
        joined = (np.diff(ends) == 1) & (row[ends[1:]] == row[ends[:-1]]) & (lo[ends[1:]] == hi[ends[:-1]] + 1)
        first = ends[np.concatenate([[True], ~joined])]
        last = ends[np.concatenate([~joined, [True]])]
    else:
        first = last = ends
    return order, np.minimum(n[inverse[order]], 2), np.stack([first, last], axis=1)


def _suffixes(match: int, window: int):
    names = ["k1", "k2", "at", "lo", "hi", "seed", "span", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for data, rows, begins, shift in text_pieces(batch.column(2), match, window):
                ends = np.append(begins[1:], len(data))
                valid = np.zeros(len(data) + 1, np.int8)
                some = ends - begins >= match
                valid[begins[some]] += 1
                valid[ends[some] - match + 1] -= 1
                at, lo, hi = anchors(data, np.cumsum(valid[:-1]).astype(bool), match, window)
                if not len(at):
                    continue
                hashed = Hasher(data)
                digest = hashed.of(at, at + (match - window + 1))
                head = (data[at].astype(np.uint64) << _U(16)) | (data[at + 1].astype(np.uint64) << _U(8)) | data[at + 2]
                seed = (head << _U(40)) | (digest >> _U(24))
                span = mix(hashed.of(lo, hi + match) + (at - lo).astype(np.uint64) * _B + (hi - lo).astype(np.uint64) * _C)
                own = np.searchsorted(begins, lo, side="right") - 1
                move = shift[own] - begins[own]
                index, n, runs = _local(own, lo, hi, seed, span)
                columns = [k1[rows[own]], k2[rows[own]], *[(x + move).astype(np.int32) for x in (at, lo, hi)], seed.view(np.int64), span.view(np.int64)]
                begin, end = runs.T
                whole = [c[begin] for c in columns]  # repeats inside the text: n is 0
                whole[4] = columns[4][end]
                arrays = [np.concatenate([c[index], w]) for c, w in zip(columns, whole)]
                arrays.append(np.concatenate([n, np.zeros(len(begin), n.dtype)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=names)

    return run


_SUFFIX_SQL = "k1 long, k2 long, at int, lo int, hi int, seed long, span long, n int"


def suffixes(docs: DataFrame, match: int = MATCH, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """The anchored suffixes of every row of `docs`, with a batch number and
    how many equal ones of that text a row stands for (2: two or more).  Rows
    with n = 0 are no suffixes but places where strings repeated inside the
    text start."""
    rows = docs.select(document_key().alias("d"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select("d.k1", "d.k2", "text").mapInArrow(_suffixes(match, window), _SUFFIX_SQL)
    return found.withColumn("batch", F.pmod(F.xxhash64("k1", "k2"), F.lit(batches)).cast("int"))


# The level family.


@dataclass
class Levels:
    """Sorted runs of (seed, n), seeds being distinct in a run; a level's rank
    is the logarithm of the batches in it."""

    levels: list[tuple[int, DataFrame]] = field(default_factory=list)
    rows: int | None = None  # bound of a run's rows, if known
    folder: str | None = None  # where runs are kept, if not in the shared folder
    paths: dict[int, str] = field(default_factory=dict)  # of kept runs, by the frame's identity

    def add(self, suffixes: DataFrame) -> list[DataFrame]:
        """Index a batch; the seeds that it has twice or shares with a level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, self._run(a.unionByName(b).groupBy("seed").agg(F.sum("n").alias("n")))))
        run = self._run(suffixes.groupBy("seed").agg(F.sum("n").alias("n")))
        shared = [run.where("n > 1").select("seed")]
        shared += [run.hint("merge").join(level, "seed").select("seed") for _, level in self.levels]
        self.levels.append((0, run))
        return shared

    def _run(self, seeds: DataFrame) -> DataFrame:
        seeds = seeds.sortWithinPartitions("seed")
        if self.folder is None:
            return written(seeds, "suffix-run", self.rows)
        path = f"{self.folder}/run-{uuid.uuid4().hex}"
        seeds.write.parquet(path)
        run = seeds.sparkSession.read.schema(seeds.schema).parquet(path)
        self.paths[id(run)] = path
        return run


def shared_seeds(found: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(seed) that two suffixes or more have."""
    rows = found.count()
    index, shared = Levels(rows=rows), []
    for batch in range(batches):
        shared += index.add(found.where(F.col("batch") == batch))
    return written(reduce(DataFrame.unionByName, shared).distinct(), "suffix-seeds", rows)


# Exact lengths.


def _repeated(rows: DataFrame, need: str, whole: str, ref: list[str], name: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose `whole` occurs twice, by their `n`, representatives in doubt).

    A representative stands for each (need, whole); it is in doubt where
    another `whole` has the same `need`."""
    classes = written(rows.groupBy(need, whole).agg(F.min(F.struct(*ref)).alias("ref"), F.sum("n").alias("n")), f"{name}-classes", n)
    twice = written(classes.where("n > 1").select(need, whole), f"{name}-twice", n)
    several = written(classes.groupBy(need).agg(F.count("*").alias("kinds")).where("kinds > 1").select(need), f"{name}-several", n)
    return rows.join(twice, [need, whole]), classes.join(several, need).select(need, "ref.*")


def _near(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Hashes of ranges of one text, all inside [starts, ends) spans that are
    sorted by start, taken by pieces."""
    out = np.empty(len(first), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        stop = at + int(np.searchsorted(np.maximum.accumulate(ends[at:]), begin + 2 * PIECE, side="right"))
        stop = max(stop, at + 1)
        piece = Hasher(data[begin : ends[at:stop].max()])
        out[at:stop] = piece.of(first[at:stop] - begin, to[at:stop] - begin)
        at = stop
    return out


def _ranges(match: int):
    """Texts with anchors -> a row for each range of STEP owned strings: `need`
    is what all of the range have in common, `whole` all that they cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column(2))
            for row in range(batch.num_rows):
                data = raw[offsets[row] : offsets[row + 1]]
                marks = batch.column(3)[row].values
                at, lo, hi, seed = (marks.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "lo", "hi", "seed"))
                first, last = (at - hi) // STEP, (at - lo) // STEP
                n = last - first + 1
                own = np.repeat(np.arange(len(at)), n)
                j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[own]
                near, far = np.maximum(STEP * j, (at - hi)[own]), np.minimum(STEP * j + STEP - 1, (at - lo)[own])
                a, s = at[own], seed.view(np.uint64)[own]
                order = np.argsort(a - far, kind="stable")
                a, j, s, near, far = a[order], j[order], s[order], near[order], far[order]
                starts, ends = a - far, a - near + match
                need = _near(data, starts, ends, a - STEP * j, a - STEP * j + match - STEP + 1)
                whole = _near(data, starts, ends, starts, ends)
                need = mix(need + s * _B + j.astype(np.uint64) * _C)
                whole = mix(whole + s * _B + near.astype(np.uint64) * _C + far.astype(np.uint64) * _A)
                key = [pa.array(np.full(len(a), batch.column(i)[row].as_py()), pa.int64()) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [*key, *[pa.array(x.astype(np.int32)) for x in (a, near, far)], pa.array(s.view(np.int64)), pa.array(need.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["k1", "k2", "at", "near", "far", "seed", "need", "whole"])

    return run


def _strings(match: int):
    """Texts with ranges in doubt -> a row for each owned string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column(2))
            for row in range(batch.num_rows):
                data = raw[offsets[row] : offsets[row + 1]]
                marks = batch.column(3)[row].values
                at, near, far, seed = (marks.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "near", "far", "seed"))
                n = far - near + 1
                own = np.repeat(np.arange(len(at)), n)
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[own]
                start = at[own] - off
                order = np.argsort(start, kind="stable")
                start, off, s = start[order], off[order], seed.view(np.uint64)[own][order]
                whole = _near(data, start, start + match, start, start + match)
                whole = mix(whole + s * _B + off.astype(np.uint64) * _C)
                key = [pa.array(np.full(len(start), batch.column(i)[row].as_py()), pa.int64()) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*key, pa.array(start.astype(np.int32)), pa.array(whole.view(np.int64))], names=["k1", "k2", "start", "whole"])

    return run


def _with_texts(texts: DataFrame, marks: DataFrame, fields: list[str]) -> DataFrame:
    """(k1, k2, text, marks): a text's marks, which its length bounds."""
    listed = marks.groupBy("k1", "k2").agg(F.collect_list(F.struct(*fields)).alias("marks"))
    return texts.join(listed, ["k1", "k2"]).select("k1", "k2", "text", "marks")


def documents_with(texts: DataFrame, some: DataFrame, n: int) -> DataFrame:
    """(k1, k2, text) of the texts (k1, k2, text) among `some` (k1, k2), once
    each.  Copies are dropped inside the tasks that read them, before they
    could meet in one."""
    return written(maybe_in(texts, "k1", some).dropDuplicates(["k1", "k2"]).join(some, ["k1", "k2"]), "suffix-texts", n)


def resolved_spans(hits: DataFrame, inside: DataFrame, texts: DataFrame, n: int, match: int) -> DataFrame:
    """(k1, k2, lo, hi): the places where repeated strings start, from the
    suffixes that share a seed, those repeated inside a text and the texts of
    both.  `n` bounds the suffixes; ranges and strings in doubt are of the same
    order."""
    whole, doubt = _repeated(hits, "seed", "span", ["k1", "k2", "at", "lo", "hi"], "suffix", n)
    spans = [inside.select("k1", "k2", "lo", "hi"), whole.select("k1", "k2", "lo", "hi")]
    ranges = _with_texts(texts, doubt, ["at", "lo", "hi", "seed"]).mapInArrow(
        _ranges(match), "k1 long, k2 long, at int, near int, far int, seed long, need long, whole long")
    ranges = written(ranges.withColumn("n", F.lit(1)), "suffix-ranges", n)
    whole, doubt = _repeated(ranges, "need", "whole", ["k1", "k2", "at", "near", "far", "seed"], "range", n)
    spans.append(whole.select("k1", "k2", (F.col("at") - F.col("far")).alias("lo"), (F.col("at") - F.col("near")).alias("hi")))
    strings = _with_texts(texts, doubt, ["at", "near", "far", "seed"]).mapInArrow(_strings(match), "k1 long, k2 long, start int, whole long")
    strings = written(strings, "suffix-strings", n)
    twice = written(strings.groupBy("whole").agg(F.count("*").alias("n")).where("n > 1").select("whole"), "string-twice", n)
    spans.append(strings.join(twice, "whole").select("k1", "k2", F.col("start").alias("lo"), F.col("start").alias("hi")))
    return written(reduce(DataFrame.unionByName, spans).distinct(), "suffix-spans", n)


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(document_key().alias("d"), "text").select("d.k1", "d.k2", F.col("text").cast("string").alias("text"))


def repeated_spans(docs: DataFrame, match: int = MATCH, window: int = WINDOW, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the texts with matching seeds (k1, k2, text), once each,
    and the places (k1, k2, lo, hi), hi included, where repeated strings start."""
    found = written(suffixes(docs, match, window, batches), "suffixes")
    n = found.count()
    suffix, inside = found.where("n > 0"), found.where("n = 0")
    shared = shared_seeds(suffix, batches)
    hits = written(maybe_in(suffix.drop("batch"), "seed", shared).join(shared, "seed"), "suffix-hits", n)
    some = written(hits.select("k1", "k2").unionByName(inside.select("k1", "k2")).distinct(), "suffix-documents", n)
    texts = documents_with(keyed_texts(docs), some, n)
    return texts, resolved_spans(hits, inside, texts, n, match)


class SuffixIndex:
    """The level family in a folder: `add` takes a new table at any time,
    finds what it shares with all tables before, and indexes it.

    The folder holds the sorted runs of the levels, and each batch's suffixes
    and texts; a manifest that changes by one rename names them, so an `add`
    that fails leaves the index as it was.  A batch costs its own suffixes, the
    merge-joins with log2(n) + 1 levels, and what shares a seed with it."""

    def __init__(self, spark: SparkSession, folder: str, match: int = MATCH, window: int = WINDOW) -> None:
        self.spark, self.match, self.window = spark, match, window
        self.table = VersionedTable(spark, folder)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.table.path}/{path}")

    def add(self, docs: DataFrame) -> DataFrame:
        """(k1, k2, n_removed, n_spans, kept) of each text of `docs` that loses
        bytes: those covered by a string that also starts elsewhere in `docs`
        or in a table added before (whose own results don't change)."""
        before, manifest = self.table.manifest()
        name, old = uuid.uuid4().hex, manifest.get("suffix_batches", [])
        folder = f"{self.table.path}/batch-{name}"
        suffixes(docs, self.match, self.window, 1).drop("batch").write.parquet(f"{folder}/suffixes")
        keyed_texts(docs).dropDuplicates(["k1", "k2"]).write.parquet(f"{folder}/texts")
        found = self._read(f"batch-{name}/suffixes")
        suffix, inside = found.where("n > 0"), found.where("n = 0")
        levels = Levels(folder=self.table.path)
        for rank, run in manifest.get("levels", []):
            level = self._read(run)
            levels.levels.append((rank, level))
            levels.paths[id(level)] = f"{self.table.path}/{run}"
        shared = written(reduce(DataFrame.unionByName, levels.add(suffix)).distinct(), "suffix-seeds")
        batches = [*old, name]
        every = reduce(DataFrame.unionByName, [self._read(f"batch-{b}/suffixes").where("n > 0") for b in batches])
        hits = written(maybe_in(every, "seed", shared).join(shared, "seed"), "suffix-hits")
        some = written(hits.select("k1", "k2").unionByName(inside.select("k1", "k2")).distinct(), "suffix-documents")
        texts = documents_with(reduce(DataFrame.unionByName, [self._read(f"batch-{b}/texts") for b in batches]), some, some.count())
        spans = resolved_spans(hits, inside, texts, hits.count() + inside.count(), self.match)
        own = self._read(f"batch-{name}/texts").select("k1", "k2")
        runs = [(rank, levels.paths[id(level)].removeprefix(f"{self.table.path}/")) for rank, level in levels.levels]
        self.table.commit(before, manifest | {"levels": runs, "suffix_batches": batches})
        return cut_spans(texts, spans.join(own, ["k1", "k2"], "left_semi"), self.match)


def cut(text: Column, marks: Column, match: int) -> Column:
    """Struct (n_removed, n_spans, kept) of texts and their (lo, hi) marks."""

    @arrow_udf("n_removed long, n_spans long, kept binary")
    def run(texts: pa.Array, marks: pa.Array) -> pa.Array:
        raw, offsets = column_bytes(texts)
        removed, n_spans, kept = [], [], []
        for row in range(len(texts)):
            data = raw[offsets[row] : offsets[row + 1]]
            own = marks[row].values
            lo, hi = (own.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi"))
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, lo, 1)
            np.add.at(depth, hi + match, -1)
            gone = np.cumsum(depth[:-1]) > 0
            removed.append(int(gone.sum()))
            n_spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(data[~gone].tobytes())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], names=["n_removed", "n_spans", "kept"])

    return run(text, marks)


def cut_spans(texts: DataFrame, spans: DataFrame, match: int) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept) of each text with spans; `kept` is
    binary, as a cut may fall inside a code point."""
    return _with_texts(texts, spans, ["lo", "hi"]).select("k1", "k2", cut(F.col("text"), F.col("marks"), match).alias("c")).select("k1", "k2", "c.*")


def cut_texts(docs: DataFrame, match: int = MATCH, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """`cut_spans` of each text that loses bytes."""
    return cut_spans(*repeated_spans(docs, match, window, batches), match)


def report(docs: DataFrame, match: int = MATCH, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Null texts are empty; texts shorter than `match` lose nothing; repeated
    rows are copies of each other, as any rows of equal text are.  Other columns
    are not read; an empty table gives no rows."""
    gone = cut_texts(docs, match, window, batches)
    gone = written(gone.select("k1", "k2", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")), "suffix-cut")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(document_key().alias("d"), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("full_sha256"))
    rows = rows.select("d.*", "n_bytes", "full_sha256").join(gone, ["k1", "k2"], "left")
    return rows.select("doc_id", "n_bytes", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_removed", "n_spans")],
                       F.coalesce("cut_sha256", "full_sha256").alias("kept_sha256"))
