"""Benchmark decontamination as a prefix-filtered set join.

Benchmark texts are cut into windows of ten words (a shorter item is one
window).  A window is a set of shingles, three words each; they are ordered by
rarity in the corpus.  A document window contains a benchmark window only if it
has all of its shingles, so the necessary prefix is the rarest one: documents
are joined on that shingle alone.  Its place in the window fixes the alignment
(positional bound), the window must fit in the document (length bound), and the
words of every aligned window are then compared one by one.

The benchmark is taken in blocks of about `BLOCK_WINDOWS` windows; only a
block, whose size that bounds, is sent to the driver and to all tasks, and with
more than one block its hits are written and its index let go before the next
is read.  The join runs where documents are read; texts never move, but to
leave out the documents that hold windows of a benchmark of several blocks.
Tasks know windows by number; items come in by joins on the few distinct sets
of windows that documents hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tables import document_key, own_columns, written
from adlake.llm.tokens import column_bytes, pieces, window_hashes, word_hashes, words

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 100_000
_TABLE_BITS = 20


def hashed_words(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, word hashes, first word of each row) by pieces."""
    raw, offsets = column_bytes(col)
    for first, last in pieces(offsets):
        data = raw[offsets[first] : offsets[last]]
        starts, ends, of = words(data, offsets[first : last + 1] - offsets[first], "alnum")
        yield first, last, word_hashes(data, starts, ends, lower=True), of


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, words array<long>): every distinct window, numbered; (wid, item):
    the items that have it.  Null item ids are windows without an item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, last, hashed, of in hashed_words(batch.column(1)):
                signed = hashed.view(np.int64)
                items, found = [], []
                for row in range(first, last):
                    a, b = of[row - first], of[row - first + 1]
                    for p in range(a, max(b - window, a) + 1 if b > a else a):
                        items.append(ids[row])
                        found.append(signed[p : min(p + window, b)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["item", "words"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    cuts = written(rows.mapInArrow(cut, "item string, words array<long>").distinct(), "bench-cuts")
    windows = written(cuts.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "bench-windows")
    items = cuts.where("item is not null").join(windows, "words").select("wid", "item")
    return windows, written(items, "bench-items")


@dataclass
class Block:
    """Windows of a block.  `flat` has the words of all windows, window i, whose
    number is wids[i], from starts[i]; shingles of size min(SHINGLE, window
    length)."""

    flat: np.ndarray
    starts: np.ndarray
    wids: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Size, hash, window and offset of every shingle."""
        size, value, owner, offset = [], [], [], []
        for i, (a, b) in enumerate(zip(self.starts, self.starts[1:])):
            k = min(SHINGLE, b - a)
            found = window_hashes(self.flat[a:b], int(k))
            value.append(found)
            size.append(np.full(len(found), k))
            owner.append(np.full(len(found), i))
            offset.append(np.arange(len(found)))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        return join(size, np.int64), join(value, np.uint64), join(owner, np.int64), join(offset, np.int64)


def n_blocks(windows: DataFrame, block_windows: int = BLOCK_WINDOWS) -> int:
    return max(1, -(-windows.count() // block_windows))


def read_block(windows: DataFrame, blocks: int, no: int) -> Block:
    """The windows of block `no`, cut by hash."""
    rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == no).orderBy("words").toArrow()
    lists = rows.column("words").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return Block(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), starts, rows.column("wid").to_numpy())


class _Lookup:
    """Finds which of many hashes are in a small sorted set: a bit table first,
    binary search for what it lets through."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, index into keys) of the hashes that are keys."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        index = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[index] == hashes[at]
        return at[same], index[same]


def corpus_counts(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often each of the block's shingles, sorted by hash, occurs in all of
    `docs`, by shingle size."""
    spark = docs.sparkSession
    size, value, _, _ = block.shingles()
    keys = {int(k): np.unique(value[size == k]) for k in np.unique(size)}
    sent = spark.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {k: _Lookup(v) for k, v in sent.value.items()}
        totals = {k: np.zeros(len(v), np.int64) for k, v in sent.value.items()}
        for batch in batches:
            for _, _, hashed, of in hashed_words(batch.column(0)):
                for k, lookup in lookups.items():
                    at, index = lookup.find(window_hashes(hashed, k))
                    ends = of[np.searchsorted(of, at, side="right")]
                    np.add.at(totals[k], index[at + k <= ends], 1)
        for k, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k)), pa.array(at), pa.array(total[at])], names=["size", "shingle", "n"])

    counted = (docs.select(F.col("text").cast("string")).mapInArrow(count, "size long, shingle long, n long")
               .groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect())  # at most the block's shingles
    out = {k: np.zeros(len(v), np.int64) for k, v in keys.items()}
    for r in counted:
        out[r["size"]][r.shingle] = r.n
    return out


@dataclass
class Index:
    """Prefix shingle -> windows that have it as their rarest, by size."""

    block: Block
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # keys, first entry, windows, offsets


def prefix_index(block: Block, counts: dict[int, np.ndarray]) -> Index:
    size, value, owner, offset = block.shingles()
    rarity = np.zeros(len(value), np.int64)
    for k, n in counts.items():
        own = size == k
        rarity[own] = n[np.searchsorted(np.unique(value[own]), value[own])]
    order = np.lexsort((offset, value, rarity, owner))  # rarest first; ties by hash, then place
    first = order[np.unique(owner[order], return_index=True)[1]] if len(order) else order
    by_size = {}
    for k in counts:
        own = first[size[first] == k]
        own = own[np.argsort(value[own], kind="stable")]
        keys, at = np.unique(value[own], return_index=True)
        by_size[k] = (keys, np.append(at, len(own)), owner[own], offset[own])
    return Index(block, by_size)


def matches(index: Index, lookups: dict[int, _Lookup], hashed: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start word, window) of every occurrence of a window."""
    block, lengths = index.block, index.block.lengths()
    starts_out, windows_out = [], []
    for k, (_, first, windows, offsets) in index.by_size.items():
        at, key = lookups[k].find(window_hashes(hashed, k))
        if not len(at):
            continue
        n = first[key + 1] - first[key]
        entry = np.repeat(first[key] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        at = np.repeat(at, n)
        window, start = windows[entry], at - offsets[entry]
        row = np.searchsorted(of, at, side="right") - 1
        fits = (start >= of[row]) & (start + lengths[window] <= of[row + 1])  # positional and length bounds
        start, window = start[fits], window[fits]
        for length in np.unique(lengths[window]):
            own = lengths[window] == length
            s, w = start[own], window[own]
            same = np.ones(len(s), dtype=bool)
            for j in range(length):
                same[same] = hashed[s[same] + j] == block.flat[block.starts[w[same]] + j]
            starts_out.append(s[same])
            windows_out.append(w[same])
    if not starts_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts_out), np.concatenate(windows_out)


FOUND = "n_words long, n_hit long, hits array<long>, windows array<long>"


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching [start, end) rows as few sorted ones."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], np.append(reach[np.flatnonzero(new)[1:] - 1], reach[-1])], axis=1)


def found_in(sent: Broadcast):
    """Column function: text -> FOUND, `hits` being merged word spans (flat
    start, end word numbers) and `windows` the numbers of the windows, of the
    index that was sent."""

    @arrow_udf(FOUND)
    def find(text: pa.Array) -> pa.Array:
        index = sent.value
        lookups = {k: _Lookup(v[0]) for k, v in index.by_size.items()}
        lengths, wids = index.block.lengths(), index.block.wids
        counts, covered, hits, held = [], [], [], []
        for first, last, hashed, of in hashed_words(text):
            start, window = matches(index, lookups, hashed, of)
            row = np.searchsorted(of, start, side="right") - 1
            order = np.argsort(row, kind="stable")
            start, window = start[order], window[order]
            cut = np.searchsorted(row[order], np.arange(last - first + 1))
            for i in range(last - first):
                spans = np.zeros((0, 2), np.int64)
                a, b = cut[i], cut[i + 1]
                if b > a:
                    begin = start[a:b] - of[i]
                    spans = _merged(np.stack([begin, begin + lengths[window[a:b]]], axis=1))
                counts.append(int(of[i + 1] - of[i]))
                covered.append(int((spans[:, 1] - spans[:, 0]).sum()))
                hits.append(spans.ravel())
                held.append(np.sort(wids[np.unique(window[a:b])]))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(covered, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(held, pa.list_(pa.int64()))],
            names=["n_words", "n_hit", "hits", "windows"])

    return find


def _index(docs: DataFrame, windows: DataFrame, blocks: int, no: int) -> Index:
    block = read_block(windows, blocks, no)
    return prefix_index(block, corpus_counts(docs, block))


def block_hits(docs: DataFrame, windows: DataFrame, blocks: int) -> DataFrame:
    """(doc, hits, windows) of the documents that hold windows, a row for each
    block that they hold windows of.  A block's rows are written, and its
    broadcast given up, before the next block is read."""
    spark, parts = docs.sparkSession, []
    for no in range(blocks):
        sent = spark.sparkContext.broadcast(_index(docs, windows, blocks, no))
        rows = docs.select(document_key().alias("doc"), found_in(sent)(F.col("text").cast("string")).alias("f"))
        parts.append(written(rows.where("f.n_hit > 0").select("doc", "f.hits", "f.windows").dropDuplicates(["doc"]), f"bench-hits-{no}"))
        sent.destroy()
    return reduce(DataFrame.unionByName, parts)


def _word_counts(text: Column) -> Column:
    @arrow_udf("long")
    def count(col: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.diff(of) for _, _, _, of in hashed_words(col)] or [np.zeros(0, np.int64)]), pa.int64())

    return count(text)


def _covered(hits: Column) -> Column:
    """Words in the union of several lists of spans."""
    @arrow_udf("long")
    def count(col: pa.Array) -> pa.Array:
        spans = (_merged(np.concatenate([np.array(x, np.int64) for x in lists]).reshape(-1, 2)) for lists in col.to_pylist())
        return pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64())

    return count(hits)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, n_hit, windows) of every row of `docs`, and (wid, item).

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; repeated items and rows count as they stand."""
    windows, items = benchmark_windows(benchmark, window)
    blocks = n_blocks(windows, block_windows)
    doc_id, text = F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")
    if blocks == 1:
        sent = docs.sparkSession.sparkContext.broadcast(_index(docs, windows, 1, 0))
        found = docs.select(doc_id, found_in(sent)(text).alias("f")).select("doc_id", "f.n_words", "f.n_hit", "f.windows")
    else:
        hits = block_hits(docs, windows, blocks)
        hits = hits.groupBy("doc").agg(F.collect_list("hits").alias("hits"), F.array_sort(F.flatten(F.collect_list("windows"))).alias("windows"))
        hits = written(hits.select("doc", "windows", _covered(F.col("hits")).alias("n_hit")), "bench-hits")
        rows = docs.select(doc_id, document_key().alias("doc"), _word_counts(text).alias("n_words")).join(hits, "doc", "left")
        found = rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("windows", F.array().cast("array<bigint>")).alias("windows"))
    return written(found, "bench-found"), items


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the
    item list of every row of `docs`.  Ties and repeated rows get equal results."""
    found, items = contamination(docs, benchmark, window, block_windows)
    found = found.withColumn("held", F.when(F.size("windows") > 0, F.struct(F.xxhash64("windows").alias("h1"), F.xxhash64(F.lit("2"), "windows").alias("h2"))))
    sets = found.where("held is not null").dropDuplicates(["held"]).select("held", F.explode("windows").alias("wid"))
    lists = sets.join(items, "wid").groupBy("held").agg(F.array_sort(F.collect_set("item")).alias("items"))  # what a document has
    rows = found.join(written(lists, "bench-sets"), "held", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of `docs` without any benchmark window, all columns as they are."""
    windows, _ = benchmark_windows(benchmark, window)
    blocks = n_blocks(windows, block_windows)
    if blocks == 1:
        sent = docs.sparkSession.sparkContext.broadcast(_index(docs, windows, 1, 0))
        return docs.where(found_in(sent)(F.col("text").cast("string"))["n_hit"] == 0)
    hit = written(block_hits(docs, windows, blocks).select("doc").distinct(), "bench-hit")
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), document_key().alias("doc")).join(hit, "doc", "left_anti")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
