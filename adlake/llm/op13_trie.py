"""Prefix trie of conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns; its name is its smallest member.
Depths are cut in halves, again and again: level l holds the cuts at depths
(2j + 1) * 2^l, each in the middle of a segment of 2^(l+1) depths.

Downward, from the coarsest level, the prefixes at all cuts of a level are
named at once: those of equal root, the name at the start of their segment,
and of equal turns from there to the cut are one node.  With it the segment
falls into an upper trie and lower tries below the cut nodes, which the next
level works on side by side.  Turns of a segment are compared by a digest of
128 bits, an exclusive or over (place, turn), so it is one partial aggregate.

Upward, from the finest level, every cut node hands its totals, which then
cover the lower trie below it, to its ancestors in the upper trie.  After the
coarsest level each node has the totals of its whole subtree.

Rounds are as many as the longest conversation's length has binary digits; a
round touches the conversations that are long enough for it.  Each row is one
turn of one conversation, never a group of them: a conversation that holds a
third of all turns, or a first turn that a third of all conversations share,
is spread over tasks by partial aggregates, by joins of written tables that
AQE can split, and by ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.tables import written

SHARED_BLOCK = 100  # conversations that begin with turns of one of them
SHARED_TURNS = 6  # fewer than that
PIECE = 1 << 16  # characters of ids hashed at once


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, k1, k2, chars) of each turn: `pos` from 0 in the order of
    turn (null first; equal ones by a digest of role and text), a 128-bit
    digest of role and text, and the text's code points.  Null role or text is
    empty.  Ranges are numbered apart and shifted by the counts before them, so
    a very long conversation is more than one task."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("k1"), F.xxhash64(F.lit("2"), role, text).alias("k2"), F.length(text).cast("bigint").alias("chars"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "k1", "k2"]
    ranges = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "trie-ranges")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))  # a row for each range
    starts = written(starts.select("conv_id", "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("zero")), "trie-starts")
    return ranges.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("zero")).alias("pos"), "k1", "k2", "chars")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count("*").alias("len"))


def with_shared_beginnings(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin with h turns of the first
    of their block: h is the unsigned CRC-32 of the decimal id modulo
    SHARED_TURNS, the block's first is c - c % SHARED_BLOCK (the remainder has
    the sign of c).  They go on with their own turns after the first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).alias("h")
    own = convs.select("conv_id", "len", h, (F.col("conv_id") - F.col("conv_id") % SHARED_BLOCK).alias("base"))
    bases = convs.where(F.col("conv_id") % SHARED_BLOCK == 0).select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    plan = own.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_len", F.lit(0))))
    plan = written(plan.select("conv_id", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("len")), "trie-plan")
    rest = turns.join(plan, "conv_id").where(F.col("pos") >= F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("lent"))
    first = turns.where((F.col("conv_id") % SHARED_BLOCK == 0) & (F.col("pos") < SHARED_TURNS - 1)).withColumnRenamed("conv_id", "base")
    first = plan.where("lent > 0").join(first, "base").where(F.col("pos") < F.col("h"))
    columns = ["conv_id", "pos", "k1", "k2", "chars", "len"]
    return rest.select(*columns).unionByName(first.select(*columns)), plan.select("conv_id", "len")


def _at_level(depth: Column, level: int) -> Column:
    """Whether a depth is an odd multiple of 2^level."""
    return depth.bitwiseAND(F.lit((2 << level) - 1)) == F.lit(1 << level)


def cuts(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, chars, len) for each depth of each
    conversation: the digest of its turns from the start of the depth's segment
    on, and the code points of the last turn."""
    segments = F.expr("""transform(filter(sequence(0, cast(floor(log2(len)) as int)),
        l -> (shiftright(pos, l) & 1) = 0 and shiftleft(shiftright(pos, l) + 1, l) <= len),
        l -> shiftleft(shiftright(pos, l) + 1, l))""")
    rows = turns.withColumn("depth", F.explode(segments))
    return rows.groupBy("conv_id", "depth").agg(
        F.bit_xor(F.xxhash64("pos", "k1", "k2")).alias("d1"), F.bit_xor(F.xxhash64(F.lit("2"), "pos", "k1", "k2")).alias("d2"),
        F.max(F.when(F.col("pos") == F.col("depth") - 1, F.col("chars"))).alias("chars"), F.max("len").alias("len"))


def named_prefixes(cut: DataFrame, levels: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, name, len) of every cut, and the nodes (depth, name,
    n_convs, chars).  `levels` has the number of cuts of each level."""
    names: list[DataFrame] = []
    nodes: list[DataFrame] = []
    for level in sorted(levels, reverse=True):
        here = cut.where(_at_level(F.col("depth"), level))
        if names:
            above = reduce(DataFrame.unionByName, names).select("conv_id", F.col("depth").alias("top"), F.col("name").alias("root"))
            here = here.withColumn("top", F.col("depth") - F.lit(1 << level)).join(above, ["conv_id", "top"], "left").drop("top")
            here = here.withColumn("root", F.coalesce("root", F.lit(0).cast("bigint")))  # the trie's root, at depth 0
        else:
            here = here.withColumn("root", F.lit(0).cast("bigint"))
        keys = ["depth", "root", "d1", "d2"]
        found = here.groupBy(*keys).agg(F.min("conv_id").alias("name"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
        found = written(found, f"trie-nodes-{level}", levels[level])
        nodes.append(found.select("depth", "name", "n_convs", "chars"))
        names.append(written(here.join(found.select(*keys, "name"), keys).select("conv_id", "depth", "name", "len"), f"trie-names-{level}", levels[level]))
    return reduce(DataFrame.unionByName, names), reduce(DataFrame.unionByName, nodes)


def grafted(nodes: DataFrame, members: DataFrame, levels: dict[int, int], totals: list[str]) -> list[DataFrame]:
    """Tables (depth, name, *totals) whose sums by node, with `nodes`' own, are
    the totals of its subtree.  `members` has (conv_id, depth, name, len), the
    root's at depth 0 included."""
    parts = [nodes.select("depth", "name", *totals)]
    for level in sorted(levels):
        below = reduce(DataFrame.unionByName, parts).where(_at_level(F.col("depth"), level))
        below = below.groupBy("depth", "name").agg(*[F.sum(c).alias(c) for c in totals])
        below = below.select(F.col("name").alias("conv_id"), (F.shiftright("depth", level) - 1).alias("segment"), *totals)
        segment = F.shiftright("depth", level)
        path = members.where((segment.bitwiseAND(F.lit(1)) == 0) & (F.shiftleft(segment + 1, level) <= F.col("len")))
        path = path.select("conv_id", segment.alias("segment"), "depth", "name")
        up = path.join(below, ["conv_id", "segment"]).groupBy("depth", "name").agg(*[F.sum(c).alias(c) for c in totals])
        parts.append(written(up, f"trie-graft-{level}", levels[level] << level))
    return parts[1:]


def _id_texts(piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ordered by node and id -> joined ids, some `piece` characters at a time."""
        node, ids, size = None, [], 0

        def text() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"depth": [node[0]], "name": [node[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]}, schema=_ID_TEXTS)

        for batch in batches:
            for depth, name, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (node != (depth, name) or size > piece):
                    yield text()
                    ids, size = [], 0
                node = (depth, name)
                ids.append(conv_id)
                size += len(str(conv_id)) + 1
        if ids:
            yield text()

    return run


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces ordered by node and first id -> one digest for each node."""
    node, digest = None, None
    for batch in batches:
        done = []
        for depth, name, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node != (depth, name):
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, name), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, r)) for r in done], schema=_DIGESTS)
    if node is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, (*node, digest.hexdigest())))], schema=_DIGESTS)


_ID_TEXTS = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("ends_sha256", pa.string())])


def ends(members: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the nodes at which conversations end: the
    digest of their ids, ascending, joined by commas.  Ranges of ids become
    texts of some 64 KB, and only these meet in a node's one task, which reads
    them as a stream: a digest of a sequence has no other order."""
    order = ["depth", "name", "conv_id"]
    last = members.where(F.col("depth") == F.col("len")).select(*order)
    texts = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_id_texts(PIECE), "depth long, name long, first long, ids string")
    return (texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").select("depth", "name", "ids")
            .mapInArrow(_id_digests, "depth long, name long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    `turns` has (conv_id, pos, k1, k2, chars, len), pos from 0 without gaps;
    `convs` every conversation's (conv_id, len).  A conversation without turns
    is a member of the root alone.  Equal conversations share all nodes.  No
    conversations, no nodes, not even a root."""
    cut = written(cuts(turns), "trie-cuts")
    level = F.log2(F.col("depth").bitwiseAND(-F.col("depth"))).cast("int")
    levels = {r["level"]: r["n"] for r in cut.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}  # 63 rows at most
    root = convs.agg(F.min("conv_id").alias("name"), F.count("*").alias("n")).first()
    spark = convs.sparkSession
    if not root["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    at_root = [F.lit(0).cast("bigint").alias("depth"), F.lit(root["name"]).cast("bigint").alias("name")]
    members = convs.select("conv_id", *at_root, "len")
    top = spark.range(1).select(*at_root, F.lit(root["n"]).cast("bigint").alias("n_convs"), F.lit(0).cast("bigint").alias("chars"),
                                F.lit(None).cast("bigint").alias("parent"))
    nodes = top
    if levels:
        named, below = named_prefixes(cut, levels)
        members = written(members.unionByName(named), "trie-members")
        above = members.select(F.col("conv_id").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
        nodes = top.unionByName(below.join(above, ["depth", "name"]))
    nodes = written(nodes, "trie-nodes")
    children = written(nodes.where("parent is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name"))
                       .agg(F.count("*").alias("n_children")), "trie-children")
    nodes = nodes.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = written(nodes.select("depth", "name", "parent", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
                                 ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "trie-weights")
    totals = ["n_leaves", "saved_tokens"]
    parts = [nodes, *grafted(nodes, members, levels, totals)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, ends(members)])
    return every.groupBy(F.col("name").alias("conv_id"), "depth").agg(
        F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.max("n_children").alias("n_children"),
        *[F.sum(c).alias(c) for c in totals], F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of conversations as they are; see `turn_rows` and
    `prefix_trie`.  Rows without conv_id belong to no conversation.  Columns
    other than conv_id, turn, role and text are not read."""
    turns = written(turn_rows(conversations), "trie-turns")
    convs = written(lengths(turns), "trie-convs")
    return prefix_trie(turns.join(convs, "conv_id"), convs)


def report(conversations: DataFrame) -> DataFrame:
    """The prefix trie of conversations with shared beginnings."""
    turns = written(turn_rows(conversations), "trie-turns")
    return prefix_trie(*with_shared_beginnings(turns, written(lengths(turns), "trie-convs")))
