"""N-gram Jaccard join with signature trees.

Two documents link when their sets of 5-word shingles have a Jaccard similarity
of at least `PERCENT` percent.  The join is exact:

1. `document_sets` tells for every document how many of its shingles occur in
   any other document.  A linked document shares at least `PERCENT` percent of
   its set, so most documents end here.  Equal sets are one class from now on.
2. Shingles of the classes left are counted, ordered by rarity, and cut to the
   necessary prefix: linked classes share a shingle of their prefixes.  Classes
   connected by prefix shingles are a family; links never leave a family.
3. A family is the root of a signature tree: below it are nodes of one size
   band and at most `LEAF_SETS` sets, and below these the nodes that a cell
   builds.  Nodes hold the OR of their sets' shingle bitmaps and their range of
   sizes.  Node pairs are traversed from the root; a pair is pruned when its
   sizes are too far apart, or when its greatest possible overlap (common bits
   and the bits lost to collisions) is too small.  Pairs of sets that remain are
   intersected exactly.
4. A cell gives every set the number of its links there and the few links that
   connect its sets, never all pairs; these become components, and link counts.

Shingles travel in blocks: a task sends one array of 4-byte shingles to each
bucket of the hash space, each shingle once a block, so a shingle that a third
of all documents have costs a bucket one entry a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.components import connected
from adlake.llm.tables import document_key, maybe_in, own_columns, written
from adlake.llm.tokens import shingle_sets

SHINGLE = 5
PERCENT = 75
BUCKET_SHINGLES = 1 << 20  # shingles a bucket gets, about
BLOCK_SHINGLES = 1 << 20  # shingles in a block
LEAF_SETS = 256
LEAF_SHINGLES = 1 << 20
BAND = 1.4  # above 100 / PERCENT, so that links are between neighbouring bands
FAN_OUT = 8
COLUMNS = 4096

_HEAD = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("k1", "<i8"), ("k2", "<i8"), ("n", "<i8"), ("cid", "V16"), ("local", "<i8")])
_MESSAGE = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("once", pa.binary()), ("who", pa.binary()), ("more", pa.binary()), ("head", pa.binary())])
_MESSAGE_SQL = "bucket int, block long, once binary, who binary, more binary, head binary"


def least_overlap(n: int | np.ndarray, percent: int = PERCENT):
    """Shingles that a set of n must share with a linked one."""
    return -(-n * percent // 100)


def _buckets(shingles: int) -> int:
    return max(1, -(-shingles // BUCKET_SHINGLES))


def _cut(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """Order by bucket (stable), and the places of each bucket that is there:
    the work follows the shingles, however many buckets there are."""
    bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    present, first = np.unique(bucket[order], return_index=True)
    return order, dict(zip(present.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(tokens)])))


def _low(tokens: np.ndarray) -> np.ndarray:
    return tokens.astype(np.uint32)


# 1. Shingles that occur in other documents.


def _send(buckets: int, shingle: int):
    def block_messages(block: int, heads: list[tuple], sets: list[np.ndarray]) -> pa.RecordBatch:
        head = np.zeros(len(heads), _HEAD)
        for i, h in enumerate(heads):
            head[i] = h
        sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        runs = np.diff(np.append(np.flatnonzero(new), len(ranked)))
        alone = np.repeat(runs == 1, runs)
        head["local"] = np.bincount(owner[order[~alone]], minlength=len(sets))
        once, more = np.sort(order[alone]), ranked[new][runs > 1]
        order1, at1 = _cut(tokens[once], buckets)
        order2, at2 = _cut(more, buckets)
        once, who, more = _low(tokens[once[order1]]), owner[once[order1]].astype(np.uint16), _low(more[order2])
        rows = {name: [] for name in _MESSAGE.names}
        home = block % buckets
        for b in sorted(at1.keys() | at2.keys() | {home}):
            (p, q), (r, t) = at1.get(b, (0, 0)), at2.get(b, (0, 0))
            step = np.diff(who[p:q], prepend=np.uint16(0))  # ascending: small steps pack well
            for name, value in zip(_MESSAGE.names, (b, block, once[p:q].tobytes(), step.tobytes(), more[r:t].tobytes(), head.tobytes() if b == home else None)):
                rows[name].append(value)
        return pa.RecordBatch.from_pydict(rows, schema=_MESSAGE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        heads, sets, held = [], [], 0
        for batch in batches:
            ids, k1, k2 = (batch.column(i).to_pylist() for i in range(3))
            for row, tokens in shingle_sets(batch.column(3), shingle):
                cid = xxhash.xxh3_128_digest(tokens.tobytes())
                heads.append((ids[row] or 0, ids[row] is not None, k1[row], k2[row], len(tokens), np.void(cid), 0))
                sets.append(tokens)
                held += len(tokens)
                if held >= BLOCK_SHINGLES or len(sets) >= 60_000:
                    yield block_messages(block, heads, sets)
                    block, heads, sets, held = block + 1, [], [], 0
        if sets:
            yield block_messages(block, heads, sets)

    return send


def _in_other_blocks(table: pa.Table) -> pa.Table:
    """A bucket's messages -> (block, who, n, head): how many of each document's
    shingles other blocks have, too."""
    once = [np.frombuffer(x.as_py(), np.uint32) for x in table["once"]]
    more = [np.frombuffer(x.as_py(), np.uint32) for x in table["more"]]
    ranked = np.sort(np.concatenate([*once, *more]))
    shared = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    out = {"block": [], "who": [], "n": [], "head": []}
    for block, tokens, steps, head in zip(table["block"].to_pylist(), once, table["who"], table["head"].to_pylist()):
        who = np.cumsum(np.frombuffer(steps.as_py(), np.uint16), dtype=np.uint16)
        at = np.minimum(np.searchsorted(shared, tokens), max(len(shared) - 1, 0))
        hit = shared[at] == tokens if len(shared) else np.zeros(len(tokens), bool)
        docs, n = np.unique(who[hit], return_counts=True)
        if len(docs) or head is not None:
            for name, value in (("block", block), ("who", docs.tobytes()), ("n", n.astype(np.uint32).tobytes()), ("head", head)):
                out[name].append(value)
    return pa.table(out, schema=pa.schema([("block", pa.int64()), ("who", pa.binary()), ("n", pa.binary()), ("head", pa.binary())]))


def _block_documents(table: pa.Table) -> pa.Table:
    head = np.frombuffer(next(x for x in table["head"].to_pylist() if x is not None), _HEAD)
    shared = head["local"].astype(np.int64)
    for who, n in zip(table["who"], table["n"]):
        shared[np.frombuffer(who.as_py(), np.uint16)] += np.frombuffer(n.as_py(), np.uint32)
    ids = pa.array(np.ascontiguousarray(head["doc_id"]), pa.int64(), mask=head["has_id"] == 0)
    columns = [ids, *[pa.array(np.ascontiguousarray(head[c])) for c in ("k1", "k2", "n")], pa.array([x.tobytes() for x in head["cid"]], pa.binary()), pa.array(shared)]
    return pa.table(columns, names=["doc_id", "k1", "k2", "n", "cid", "shared"])


def document_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, k1, k2, n, cid, shared) of every row of `docs`: set size, the
    set's 128-bit digest, and how many of its shingles other rows have (now and
    then a few more, where 4-byte shingles of a bucket meet)."""
    rows = docs.select(document_key().alias("d"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = _buckets(size // 6)
    sent = rows.select("d.doc_id", "d.k1", "d.k2", "text").mapInArrow(_send(buckets, shingle), _MESSAGE_SQL)
    back = sent.groupBy("bucket").applyInArrow(_in_other_blocks, "block long, who binary, n binary, head binary")
    return back.groupBy("block").applyInArrow(_block_documents, "doc_id long, k1 long, k2 long, n long, cid binary, shared long")


# 2. Rarity, prefixes and families.

_BLOCK_SQL = "block long, cids binary, sizes binary, tokens binary"


def _as_blocks(shingle: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, sets, held = [], [], 0

        def done() -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets], np.int64)
            block = xxhash.xxh64_intdigest(b"".join(cids)) >> 1  # a class is in one block only
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([b"".join(cids)], pa.binary()), pa.array([sizes.tobytes()], pa.binary()), pa.array([np.concatenate(sets).tobytes()], pa.binary())],
                names=["block", "cids", "sizes", "tokens"])

        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, tokens in shingle_sets(batch.column(1), shingle):
                cids.append(own[row])
                sets.append(tokens)
                held += len(tokens)
                if held >= BLOCK_SHINGLES // 2:
                    yield done()
                    cids, sets, held = [], [], 0
        if sets:
            yield done()

    return blocks


def _unique_by_bucket(tokens: np.ndarray, buckets: int):
    """Distinct shingles in bucket order, their counts, places of buckets."""
    distinct, n = np.unique(tokens, return_counts=True)
    order, at = _cut(distinct, buckets)
    return distinct[order], n[order], at


def _count_out(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens in zip(batch.column(0).to_pylist(), batch.column(1)):
                distinct, n, at = _unique_by_bucket(np.frombuffer(tokens.as_buffer(), np.uint64), buckets)
                low, n = _low(distinct), n.astype(np.uint32)
                cut = [(b, p, q) for b, (p, q) in at.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, *_ in cut], pa.int32()), pa.array([block] * len(cut), pa.int64()),
                     pa.array([low[p:q].tobytes() for _, p, q in cut], pa.binary()), pa.array([n[p:q].tobytes() for _, p, q in cut], pa.binary())],
                    names=["bucket", "block", "tokens", "n"])

    return send


def _count_back(table: pa.Table) -> pa.Table:
    tokens = [np.frombuffer(x.as_py(), np.uint32) for x in table["tokens"]]
    n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["n"]]).astype(np.int64)
    _, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(inverse, weights=n).astype(np.uint32)[inverse]
    ends = np.cumsum([len(x) for x in tokens])
    return pa.table({"bucket": table["bucket"], "block": table["block"], "n": pa.array([x.tobytes() for x in np.split(total, ends[:-1])], pa.binary())})


def _prefixes(buckets: int, percent: int):
    """Sets of a block that share enough shingles, with their prefix: of the
    rarest n - least_overlap + 1 shingles those that others have."""
    def prefixes(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        out = {"cid": [], "n": [], "prefix": [], "tokens": []}
        back = {b: np.frombuffer(x, np.uint32) for b, x in zip(counts["bucket"].to_pylist(), counts["n"].to_pylist())}
        for cids, sizes, tokens in zip(*(blocks[c].to_pylist() for c in ("cids", "sizes", "tokens"))):
            sizes, tokens = np.frombuffer(sizes, np.int64), np.frombuffer(tokens, np.uint64)
            distinct, _, at = _unique_by_bucket(tokens, buckets)
            n = np.zeros(len(distinct), np.int64)
            for b, x in back.items():
                n[slice(*at[b])] = x
            order = np.argsort(distinct)
            count = n[order][np.searchsorted(distinct[order], tokens)]
            ends = np.cumsum(sizes)
            for i, (a, b) in enumerate(zip(ends - sizes, ends)):
                shared = count[a:b] > 1
                size, common = b - a, int(shared.sum())
                if common < least_overlap(size, percent):
                    continue
                room = size - least_overlap(size, percent) + 1 - (size - common)
                rarest = np.lexsort((tokens[a:b], count[a:b]))[size - common :][:room]
                for name, value in (("cid", cids[16 * i : 16 * i + 16]), ("n", int(size)), ("prefix", tokens[a:b][rarest].view(np.int64)), ("tokens", tokens[a:b].tobytes())):
                    out[name].append(value)
        return pa.table([pa.array(out["cid"], pa.binary()), pa.array(out["n"], pa.int64()), pa.array(out["prefix"], pa.list_(pa.int64())), pa.array(out["tokens"], pa.binary())],
                        names=["cid", "n", "prefix", "tokens"])

    return prefixes


def candidate_sets(docs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(cid, n, prefix, tokens) of the classes that share enough shingles."""
    rows = 10 * sets.count()  # sets are longer than rows of other tables
    some = sets.where(F.col("shared") * 100 >= F.col("n") * percent).where("n > 0")
    classes = written(some.groupBy("cid", "n").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("d")), "jaccard-classes", rows)
    keyed = docs.select(document_key().alias("d"), "text").withColumn("k1", F.col("d.k1"))
    texts = maybe_in(keyed, "k1", classes.select("d.k1")).join(classes, "d").dropDuplicates(["cid"])
    blocks = written(texts.select("cid", F.col("text").cast("string")).mapInArrow(_as_blocks(shingle), _BLOCK_SQL), "jaccard-sets", rows)
    buckets = _buckets(classes.agg(F.sum("n")).first()[0] or 0)
    counts = (blocks.select("block", "tokens").mapInArrow(_count_out(buckets), "bucket int, block long, tokens binary, n binary")
              .groupBy("bucket").applyInArrow(_count_back, "bucket int, block long, n binary"))
    found = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        _prefixes(buckets, percent), "cid binary, n long, prefix array<long>, tokens binary")
    return written(found, "jaccard-candidates", rows)


def families(candidates: DataFrame) -> DataFrame:
    """(node, root): classes connected by prefix shingles."""
    rows = candidates.agg(F.sum(F.size("prefix"))).first()[0] or 0
    entries = candidates.select("cid", F.explode("prefix").alias("token"))
    first = written(entries.groupBy("token").agg(F.min("cid").alias("v"), F.max("cid").alias("last")).where("v <> last").drop("last"), "jaccard-tokens", rows)
    edges = entries.join(first, "token").where("cid <> v").select(F.col("cid").alias("u"), "v").distinct()
    return connected(edges, "jaccard-families", rows)


# 3. Signature trees.


class SignatureTree:
    """Sets sorted by size and first shingle in nodes of FAN_OUT.  Level 0 has
    the sets, each level above the OR of its children's bitmaps, their least
    and greatest size and the most bits any set below lost to collisions."""

    def __init__(self, sets: list[np.ndarray], bits: int) -> None:
        self.order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0]))
        words = np.zeros((len(sets), bits // 64), np.uint64)
        for row, i in enumerate(self.order):
            place = sets[i] & np.uint64(bits - 1)
            np.bitwise_or.at(words[row], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        size = np.array([len(sets[i]) for i in self.order], np.int64)
        lost = size - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.levels = [(words, size, size, lost)]
        while len(self.levels[-1][0]) > 1:
            words, low, high, lost = self.levels[-1]
            at = np.arange(0, len(words), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(words, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(lost, at)))


def _children(pairs: np.ndarray, na: int, nb: int, same: bool) -> np.ndarray:
    step = np.arange(FAN_OUT)
    a = (pairs[:, 0, None, None] * FAN_OUT + step[None, :, None]) + np.zeros((1, 1, FAN_OUT), np.int64)
    b = (pairs[:, 1, None, None] * FAN_OUT + step[None, None, :]) + np.zeros((1, FAN_OUT, 1), np.int64)
    out = np.stack([a.ravel(), b.ravel()], axis=1)
    out = out[(out[:, 0] < na) & (out[:, 1] < nb)]
    return out[out[:, 0] <= out[:, 1]] if same else out


def tree_pairs(left: SignatureTree, right: SignatureTree, percent: int) -> np.ndarray:
    """Pairs of leaves (places in the trees' orders) that no bound excludes.
    left and right have as many levels (the lower one is its own root above)."""
    same = left is right
    top = max(len(left.levels), len(right.levels)) - 1
    pairs = np.zeros((1, 2), np.int64)
    for level in range(top, -1, -1):
        a = left.levels[min(level, len(left.levels) - 1)]
        b = right.levels[min(level, len(right.levels) - 1)]
        if level < top:
            pairs = _children(pairs, len(a[0]), len(b[0]), same)
        if same and level == 0:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        keep = []
        for at in range(0, len(pairs), 4096):
            i, j = pairs[at : at + 4096].T
            near = (a[2][i] * 100 >= b[1][j] * percent) & (b[2][j] * 100 >= a[1][i] * percent)
            i, j = i[near], j[near]
            common = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64)
            most = np.minimum(common + np.minimum(a[3][i], b[3][j]), np.minimum(a[2][i], b[2][j]))
            # |A and B| * (100 + percent) >= percent * (|A| + |B|)
            keep.append(np.stack([i, j], axis=1)[most * (100 + percent) >= percent * (a[1][i] + b[1][j])])
        pairs = np.concatenate(keep) if keep else pairs[:0]
    return pairs


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def links_among(pairs: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the pairs of `sets` link.  Few pairs are intersected one by one;
    of many, the common shingles are counted for all at once, as products of
    0/1 matrices over some COLUMNS shingles at a time."""
    if len(pairs) <= 4 * len(sets):
        return np.array([linked(sets[i], sets[j], percent) for i, j in pairs.tolist()], bool)
    size = np.array([len(x) for x in sets], np.int64)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, again = np.repeat(np.arange(len(sets)), size), times > 1
    place = np.cumsum(again) - 1
    use = again[column]
    owner, column = owner[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)))
    for first in range(0, int(again.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        part = np.zeros((len(sets), COLUMNS))
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    both = common[pairs[:, 0], pairs[:, 1]].astype(np.int64)
    return 100 * both >= percent * (size[pairs[:, 0]] + size[pairs[:, 1]] - both)


def cell_join(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT) -> np.ndarray:
    """All links (i, j) between `left` and `right` (numbered on from left), or
    inside `left`: what the trees leave is intersected."""
    if not left or right == []:
        return np.zeros((0, 2), np.int64)
    everything = left + (right or [])
    bits = 1 << max(9, math.ceil(math.log2(8 * max(len(s) for s in everything))))
    first = SignatureTree(left, bits)
    second = first if right is None else SignatureTree(right, bits)
    pairs = tree_pairs(first, second, percent)
    pairs = np.stack([np.array(first.order)[pairs[:, 0]], np.array(second.order)[pairs[:, 1]] + (0 if right is None else len(left))], axis=1)
    return pairs[links_among(pairs, everything, percent)]


def spanning(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Some of the links that connect what all of them connect."""
    label, out = np.arange(n), []
    order = np.argsort(pairs[:, 0], kind="stable")
    pairs = pairs[order]
    at = np.searchsorted(pairs[:, 0], np.arange(n + 1))
    for i in range(n):
        near = pairs[at[i] : at[i + 1], 1]
        for j in near[label[near] != label[i]].tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def cell_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what all links of a cell connect."""
    return spanning(cell_join(left, right, percent), len(left) + len(right or []))


def _cell(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """A cell's sets -> links (u, v) that connect them, and for each set (u)
        the number n of documents of other sets that it links with here."""
        side = table["side"].to_numpy()
        order = np.argsort(side, kind="stable")
        table = table.take(pa.array(order))
        sets = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        cids, copies = table["cid"].combine_chunks(), table["copies"].to_numpy()
        n_left = int((side == 0).sum())
        inside = table["cell"][0].as_py()["inside"]
        pairs = cell_join(sets, None, percent) if inside else cell_join(sets[:n_left], sets[n_left:], percent)
        some = np.array(spanning(pairs, len(sets)), np.int64).reshape(-1, 2)
        counts = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(sets)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(sets))
        held = np.flatnonzero(counts)
        return pa.table({"u": pa.concat_arrays([cids.take(pa.array(some[:, 0])), cids.take(pa.array(held))]),
                         "v": pa.concat_arrays([cids.take(pa.array(some[:, 1])), pa.nulls(len(held), cids.type)]),
                         "n": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(counts[held].astype(np.int64))])})

    return links


def cells(candidates: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, side, cid, tokens, copies): the node pairs below each family's root.

    A family that fits a leaf is one cell.  Else its sets are in nodes by size
    band and, where a band is large, by digest; each node meets itself, the
    nodes of its band and those of the next band, as no other sizes can link."""
    own = candidates.join(roots.withColumnRenamed("node", "cid"), "cid").select(
        "root", "cid", "n", "tokens", "copies", F.floor(F.log("n") / math.log(BAND)).cast("int").alias("band"))
    n = 10 * candidates.count()
    own = written(own, "jaccard-family-sets", n)
    small = "sets <= {} and shingles <= {}".format(LEAF_SETS, LEAF_SHINGLES)
    totals = own.groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    whole = written(totals.select("root", F.expr(small).alias("whole")), "jaccard-family-sizes", n)
    parts = own.groupBy("root", "band").agg(F.greatest(F.ceil(F.count("*") / LEAF_SETS), F.ceil(F.sum("n") / LEAF_SHINGLES)).cast("int").alias("nodes"))
    parts = written(parts, "jaccard-bands", n)
    near = (parts.join(parts.select("root", (F.col("band") - 1).alias("band"), F.col("nodes").alias("above")), ["root", "band"], "left")
            .join(parts.select("root", (F.col("band") + 1).alias("band"), F.col("nodes").alias("below")), ["root", "band"], "left"))
    near = written(near.join(whole, "root"), "jaccard-nodes", n)
    rows = own.join(near, ["root", "band"])
    node = F.pmod(F.xxhash64("cid"), F.col("nodes")).cast("int")
    count = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))

    def cell(band: Column, inside: Column, low: Column, high: Column, side: Column) -> Column:
        return F.struct(F.struct(band.alias("band"), inside.alias("inside"), low.alias("low"), high.alias("high")).alias("at"), side.alias("side"))

    no, yes = F.lit(False), F.lit(True)
    rows = rows.withColumn("node", node)
    among = F.transform(count("nodes"), lambda j: cell(
        F.col("band"), F.col("node") == j, F.least("node", j), F.greatest("node", j), F.when(F.col("node") <= j, 0).otherwise(1)))
    upward = F.transform(count("above"), lambda j: cell(F.col("band"), no, -F.col("node") - 1, j, F.lit(0)))
    downward = F.transform(count("below"), lambda j: cell(F.col("band") - 1, no, -j - 1, F.col("node"), F.lit(1)))
    single = F.array(cell(F.lit(-1), yes, F.lit(0), F.lit(0), F.lit(0)))
    rows = rows.withColumn("place", F.explode(F.when(F.col("whole"), single).otherwise(F.concat(among, upward, downward))))
    return rows.select(F.struct("root", "place.at.band", "place.at.inside", "place.at.low", "place.at.high").alias("cell"), "place.side", "cid", "tokens", "copies")


def links(docs: DataFrame, sets: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between set digests that connect all linked classes, and
    (cid, n): with how many documents of other classes a class links."""
    rows = sets.count()
    candidates = candidate_sets(docs, sets, shingle, percent)
    copies = sets.where("n > 0").groupBy(F.col("cid").alias("node")).agg(F.count("*").alias("copies"))
    placed = cells(candidates, written(families(candidates).join(copies, "node"), "jaccard-copies", rows))
    found = written(placed.groupBy("cell").applyInArrow(_cell(percent), "u binary, v binary, n long"), "jaccard-found", 10 * rows)
    return found.where("v is not null").select("u", "v"), found.where("n is not null").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))


# 4. Components.


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, component_id, first, n_links) of every row
    of `docs`: the smallest doc_id reachable by links, the (doc_id, k1, k2) of
    the component's first document, and with how many other rows it links.

    Null and empty texts have no shingles and link with nothing.  Rows with a
    null doc_id take part; they are reported under the smallest id that isn't
    null, and null only where there is none.  Repeated rows are documents with
    equal sets.  Other columns are not read; an empty table gives no rows."""
    sets = written(document_sets(docs, shingle), "jaccard-documents")
    n = sets.count()
    edges, linked_with = links(docs, sets, shingle, percent)
    roots = connected(edges, "jaccard-links", 4 * n)
    some = sets.where("n > 0")
    classes = some.groupBy("cid").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "k1", "k2")).alias("first"), F.count("*").alias("copies"))
    classes = classes.join(linked_with.withColumnRenamed("n", "others"), "cid", "left")
    named = written(classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
                    .withColumn("root", F.coalesce("root", "cid")), "jaccard-roots", n)
    whole = written(named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first")), "jaccard-components", n)
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    by_class = written(named.select("cid", "root", n_links).join(whole, "root").drop("root"), "jaccard-by-class", n)
    out = ["doc_id", "k1", "k2", F.col("n").alias("n_shingles")]
    alone = sets.where("n = 0").select(*out, F.col("doc_id").alias("component_id"), F.struct("doc_id", "k1", "k2").alias("first"), F.lit(0).cast("bigint").alias("n_links"))
    return some.join(by_class, "cid").select(*out, "component_id", "first", "n_links").unionByName(alone)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row of `docs`."""
    return components(docs).select("doc_id", "n_shingles", "component_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near duplicates: the first (smallest doc_id,
    null first, then text digest) document of every component, once; documents
    without shingles all stay.  All columns as they are."""
    found = components(docs)
    keep = found.where("n_shingles = 0").select("doc_id", "k1", "k2").unionByName(found.where("n_shingles > 0").select("first.*")).distinct()
    keep = written(keep, "jaccard-kept").select(F.struct("doc_id", "k1", "k2").alias("doc"))
    bare = F.length(F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) == 0
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), document_key().alias("doc"), bare.alias("bare"))  # names of `docs` can't clash in a struct
    rows = rows.join(keep, "doc")
    own = F.when(F.col("bare"), F.monotonically_increasing_id()).otherwise(F.lit(-1))  # documents without shingles are no repeats
    return rows.withColumn("own", own).dropDuplicates(["doc", "own"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
