"""Substring ("text contains key") join by an inverted index of q-grams (JO6).

``LEFT JOIN keys ON text LIKE '%' || key || '%'`` is a theta join; Spark can
only run it as a nested loop, which compares every text with every key.  Here a
text that contains a key contains each of the key's q-grams, so the rarest of
them is a necessary prefix of the key and an equi-join on it finds the
candidates:

1. counts: the texts' q-grams, as far as a key has them, are counted (a partial
   aggregate over the texts, no text moves);
2. index: a table of the keys under the hash of their rarest q-gram, with its
   place in the key; a key with a q-gram that no text has is in no text and
   goes;
3. candidates: the places of the texts whose q-gram is in the index meet it,
   with ``AROUND`` bytes to either side, in which the key is compared.  Keys
   shorter than a gram are looked up among the texts' own 1- to 3-byte grams;
4. keys are numbered by length, as short ones occur together, and what a distinct
   text (by 128 bits) has of 64 keys is the bits of one number, an aggregate of
   numbers before anything is shuffled;
5. each text gets an array of its keys, and the rows are joined with it.  Only keys
   that reach beyond the bytes around their gram are compared again, with the
   whole text.

Many keys of one kind (numbered ids) share so few grams that each place would
meet more keys the more there are.  Keys of up to ``WHOLE`` bytes whose rarest
gram has over ``CROWD`` keys are therefore looked up whole, by each of their
sizes, at the places where a gram begins one of them: each place meets a key of a
size once, however many keys there are.

Over ``FEW`` keys of up to ``WHOLE`` bytes are all looked up whole, and no place is
shuffled: the distinct texts are dealt out once, blocks of ``BLOCK`` keys are
broadcast in buckets, one block after the other, and a text gets a list of numbers,
the places with the sizes of the keys that begin there.  The keys themselves are
cut from the text when its rows are at hand.

Grams are bytes of UTF-8, where containment is the same as in code points.
Before anything of a text is shuffled it passes a broadcast filter of at most
``FILTER_BUCKETS`` numbers; an index of up to ``FEW`` keys and ``ROOM`` bytes is
broadcast itself, and its keys are compared in the whole text at hand; of larger
ones AQE's size check decides.  Each place of a text is a row of generated code.
Everything runs in the JVM; besides what is broadcast no key or text comes to the
driver, only counts, and which lengths the short and crowded keys have.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.session import materialise, settle

Q = 4  # bytes of a gram
AROUND = 48  # bytes to either side of a gram that travel with it
PIECE = 1 << 15  # places of a text that are listed at once
FILTER_BUCKETS = 1 << 20  # a power of two
FEW = 1 << 16  # keys that are broadcast,
ROOM = 1 << 23  # of as many bytes together
CROWD = 32  # keys of a gram
WHOLE = 16  # bytes of the longest key that is looked up whole
BLOCK = 1 << 22  # keys of up to WHOLE bytes that are broadcast at once
TOGETHER = 4  # sizes that a place looks up in one row


def _places(texts: DataFrame) -> DataFrame:
    """(t, u, all, at) for each byte `at`, from 1, of texts (t, u, text)."""
    n = F.octet_length("all")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / PIECE).cast("int"), F.lit(1)) - 1)
    pieces = texts.select("t", "u", F.col("text").cast("binary").alias("all")).where(n > 0)
    pieces = pieces.select("t", "u", "all", F.explode(starts).alias("i"))
    within = F.sequence(F.col("i") * PIECE + 1, F.least((F.col("i") + 1) * PIECE, n))
    return pieces.select("t", "u", "all", F.explode(within).alias("at"))


def _gram(binary: Column | str, at: Column | str, size: int) -> Column:
    return F.substring(binary, F.col(at) if isinstance(at, str) else at, F.lit(size))


def _among(rows: DataFrame, gram: Column, index: DataFrame) -> DataFrame:
    """Rows whose `gram` may be one of the index: a semi-join with its last bits,
    a broadcast of FILTER_BUCKETS numbers at most, however many grams."""
    bucket = lambda g: g.bitwiseAND(F.lit(FILTER_BUCKETS - 1).cast("long")).alias("bucket")
    some = index.select(bucket(F.col("gram"))).distinct()
    return rows.withColumn("bucket", bucket(gram)).join(F.broadcast(some), "bucket", "left_semi").drop("bucket")


def gram_index(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(gram, off) and the columns of the distinct `keys` (key, ...) of Q bytes or more that
    can occur in `texts` (t, u, text): each under its rarest gram and a place of it."""
    places = keys.select("*", F.col("key").cast("binary").alias("all"), F.explode(F.sequence(F.lit(1), F.octet_length("key") - Q + 1)).alias("at"))
    of_keys = materialise(places.select(*keys.columns, F.xxhash64(_gram("all", "at", Q)).alias("gram"), "at"), "gram-keys")
    gram = F.xxhash64(_gram("all", "at", Q))
    counts = _among(_places(texts), gram, of_keys).groupBy(gram.alias("gram")).agg(F.count("*").alias("n"))
    rarest = (of_keys.join(materialise(counts, "gram-counts"), "gram", "left")
              .groupBy(*keys.columns).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at")).alias("least")))
    return materialise(rarest.where("least.n > 0").select("least.gram", F.col("least.at").alias("off"), *keys.columns), "gram-index")


def _by_rarest_gram(texts: DataFrame, keys: DataFrame) -> list[DataFrame]:
    """(t, u, slot, bit, sure) for `keys` (slot, bit, key) of Q bytes or more: found, or to be compared."""
    index = gram_index(texts, keys)
    crowds = index.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    size = F.octet_length("key")
    crowded = materialise(index.join(crowds, "gram", "left_semi").where(size <= WHOLE).select("slot", "bit", "key"), "gram-crowded")
    used = crowded.agg(*[F.max(size == s) for s in range(Q, WHOLE + 1)]).first()
    sizes = [s for s, there in enumerate(used, Q) if there]
    if not sizes:
        return [_by_index(texts, index)]
    index = materialise(index.join(crowded, "key", "left_anti").select("gram", "off", "slot", "bit", "key"), "gram-index")
    starts = crowded.select(F.xxhash64(_gram(F.col("key").cast("binary"), F.lit(1), Q)).alias("gram"))
    places = _among(_places(texts), F.xxhash64(_gram("all", "at", Q)), starts)
    return [_by_index(texts, index), _whole(places, crowded, sizes)]


def _by_index(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(t, u, slot, bit, sure) for the keys of an index.  Few keys come to the places of
    the texts, each of which is compared there with all of the text at hand."""
    size, gram = F.octet_length("key"), F.xxhash64(_gram("all", "at", Q))
    n, room = index.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    if n <= FEW and room <= ROOM:
        index = index.select("gram", "slot", "bit", "off", size.alias("size"), F.col("key").cast("binary").alias("own"))
        hits = _places(texts).select("t", "u", "all", "at", gram.alias("gram")).join(F.broadcast(index), "gram")
        same = F.substring("all", F.col("at") - F.col("off") + 1, F.col("size")) == F.col("own")
        return hits.where((F.col("at") >= F.col("off")) & same).select("t", "u", "slot", "bit", F.lit(True).alias("sure"))
    found = _among(_places(texts), gram, index)
    first = F.greatest(F.col("at") - AROUND, F.lit(1))
    found = found.select("t", "u", gram.alias("gram"), F.substring("all", first, F.lit(2 * AROUND + Q)).alias("around"),
                         (F.col("at") - first + 1).alias("here"))
    hits = found.join(index, "gram")
    begin = F.col("here") - F.col("off") + 1  # of the key in `around`
    fits = (F.col("off") <= AROUND + 1) & (size - F.col("off") < AROUND + Q)
    same = (begin >= 1) & (F.substring("around", F.greatest(begin, F.lit(1)), size) == F.col("key").cast("binary"))
    return hits.where(~fits | same).select("t", "u", "slot", "bit", fits.alias("sure")).distinct()


def _whole(places: DataFrame, keys: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(t, u, slot, bit, sure) for few keys of the given sizes at places (t, u, all, at)."""
    own = keys.select(F.xxhash64(F.col("key").cast("binary")).alias("hash"), F.col("key").cast("binary").alias("own"), "slot", "bit")
    pieces = [_gram("all", "at", s) for s in sizes]
    if max(sizes) < Q:  # the hash of up to 3 bytes is no other's
        grams = places.select("t", "u", F.explode(F.array(*map(F.xxhash64, pieces))).alias("hash"))
        return grams.join(F.broadcast(own), "hash").select("t", "u", "slot", "bit", F.lit(True).alias("sure"))
    grams = places.select("t", "u", F.explode(F.array(*pieces)).alias("gram")).select("t", "u", "gram", F.xxhash64("gram").alias("hash"))
    same = F.startswith("gram", "own") & F.startswith("own", "gram")  # an equality would join by two keys, far slower than by one number
    return grams.join(F.broadcast(own), "hash").where(same).select("t", "u", "slot", "bit", F.lit(True).alias("sure"))


def _by_blocks(texts: DataFrame, keys: DataFrame, sizes: Sequence[int], n: int) -> list[DataFrame]:
    """A table (t, u, spots) for each block of the `n` keys (key) of the given sizes,
    up to WHOLE bytes: a spot is a place of the text, times 2^WHOLE, and bit s - 1
    for a key of s bytes that begins there."""
    blocks, start = -(-n // BLOCK), min(sizes[0], Q)
    bucket = lambda key: F.xxhash64(key).bitwiseAND(F.lit((1 << max(0, (n >> 4).bit_length())) - 1).cast("long"))
    starts = keys.select(F.xxhash64(_gram(F.col("key").cast("binary"), F.lit(1), start)).alias("gram"))
    buckets = settle(keys.groupBy(bucket(F.col("key")).alias("bucket")).agg(F.collect_list("key").alias("keys")), "gram-buckets")
    texts = texts.groupBy("t", "u").agg(F.min("text").alias("text"))  # the one exchange: what follows stays with the text
    places = _among(_places(texts), F.xxhash64(_gram("all", "at", start)), starts)
    groups = [sizes[i : i + TOGETHER] for i in range(0, len(sizes), TOGETHER)]
    groups = F.explode(F.array(*[F.struct(*[F.lit(g[k] if k < len(g) else None).cast("int").alias(f"s{k}") for k in range(TOGETHER)]) for g in groups]))
    rows = places.select("t", "u", "all", "at", groups.alias("g"))
    size = [F.col(f"g.s{k}") for k in range(TOGETHER)]
    piece = [F.when(F.col("at") + s - 1 <= F.octet_length("all"), F.substring("all", F.col("at"), s).cast("string")).alias(f"p{k}") for k, s in enumerate(size)]
    rows = rows.select("t", "u", "at", *[s.alias(f"s{k}") for k, s in enumerate(size)], *piece)
    found = []
    for i in range(blocks):
        block, looked = buckets.where(F.pmod("bucket", F.lit(blocks)) == i), rows
        for k in range(TOGETHER):
            looked = looked.join(F.broadcast(block.select(F.col("bucket").alias(f"b{k}"), F.col("keys").alias(f"k{k}"))), bucket(F.col(f"p{k}")) == F.col(f"b{k}"), "left")
        bits = [F.when(F.array_contains(f"k{k}", F.col(f"p{k}")), F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"s{k}") - 1)).otherwise(F.lit(0).cast("long")) for k in range(TOGETHER)]
        spots = looked.select("t", "u", "at", reduce(Column.__add__, bits).alias("bits")).where("bits > 0")
        spot = F.shiftleft(F.col("at").cast("long"), WHOLE) + F.col("bits")
        found.append(settle(spots.groupBy("t", "u").agg(F.collect_list(spot).alias("spots")), "gram-spots"))
    return found


def _cut(text: Column, spots: Column, sizes: Sequence[int]) -> Column:
    """The keys of a text's spots."""
    at = lambda spot: F.shiftright(spot, WHOLE).cast("int")
    there = lambda spot: F.array(*[F.when(spot.bitwiseAND(F.lit(1 << (s - 1)).cast("long")) != 0, F.substring(text.cast("binary"), at(spot), F.lit(s)).cast("string")) for s in sizes])
    return F.array_distinct(F.array_compact(F.flatten(F.transform(spots, there))))


def _collected(found: Sequence[DataFrame], keys: DataFrame) -> DataFrame:
    """(t, u, sure, open): the distinct keys of a text, of hits (t, u, slot, bit, sure)
    with keys of their own each."""
    bits = reduce(DataFrame.unionByName, [hits.groupBy("t", "u", "sure", "slot").agg(F.bit_or("bit").alias("bits")) for hits in found])
    slots = keys.groupBy("slot").agg(F.collect_list(F.struct("bit", "key")).alias("keys"))
    some = F.transform(F.filter("keys", lambda k: k["bit"].bitwiseAND(F.col("bits")) != 0), lambda k: k["key"])
    named = bits.join(slots, "slot").select("t", "u", "sure", some.alias("keys"))
    return named.groupBy("t", "u").agg(F.flatten(F.collect_list(F.when(F.col("sure"), F.col("keys")))).alias("sure"),
                                       F.flatten(F.collect_list(F.when(~F.col("sure"), F.col("keys")))).alias("open"))


def _matched(left: DataFrame, keep: Sequence[str], text: Column, keys: DataFrame, key_col: str, ignore_case: bool) -> DataFrame:
    """Rows (c0, c1, .., found): the `keep` columns of each row of `left`, and the
    distinct keys that its text contains."""
    key = F.col(f"`{key_col}`").cast("string")
    keys = keys.select((F.lower(key) if ignore_case else key).alias("key")).where("key is not null").distinct()
    keys = keys.orderBy(F.octet_length("key"), "key").withColumn("id", F.monotonically_increasing_id())
    keys = keys.select("key", F.shiftright("id", 6).alias("slot"), F.expr("shiftleft(1L, cast(id & 63 AS int))").alias("bit"))
    keys = settle(keys, "gram-distinct")
    size = F.octet_length("key")
    empty, few, whole, *used, long = keys.agg(F.max(size == 0), F.count_if((size > 0) & (size < Q)), F.count_if((size > 0) & (size <= WHOLE)), *[F.max(size == s) for s in range(1, WHOLE + 1)], F.max(size > WHOLE)).first()
    sizes = [s for s, there in enumerate(used, 1) if there]
    text = F.lower(text) if ignore_case else text
    rows = left.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], text.alias("text"),
                       F.xxhash64(text).alias("t"), F.xxhash64(F.lit("2"), text).alias("u"))
    texts = rows.where("text is not null").select("t", "u", "text")
    none = F.array().cast("array<string>")
    found, tables, hits = [F.when(F.col("text").isNotNull(), F.array(F.lit(""))).otherwise(none)] if empty else [], [], []
    if whole > FEW:
        tables = _by_blocks(texts, keys.where((size > 0) & (size <= WHOLE)), sizes, whole)
        hits = _by_rarest_gram(texts, keys.where(size > WHOLE)) if long else []
    else:
        hits = _by_rarest_gram(texts, keys.where(size >= Q)) if long or any(s >= Q for s in sizes) else []
        hits += [_whole(_places(texts), keys.where((size > 0) & (size < Q)), [s for s in sizes if s < Q])] if few else []
    for i, spots in enumerate(tables):
        rows = rows.join(spots.withColumnRenamed("spots", f"spots{i}"), ["t", "u"], "left")
        found.append(F.coalesce(_cut(F.col("text"), F.col(f"spots{i}"), sizes), none))
    if hits:
        arrays = settle(_collected(hits, keys), "gram-matches")
        rows = rows.join(arrays, ["t", "u"], "left")
        found.append(F.coalesce("sure", none))
        if arrays.agg(F.max(F.size("open") > 0)).first()[0]:  # else no text is needed again
            found.append(F.filter(F.coalesce("open", none), lambda k: F.contains(F.col("text"), k)))
    return rows.select(*[F.col(f"c{i}") for i in range(len(keep))], (F.concat(*found) if found else none).alias("found"))


def contains_matches(left: DataFrame, ids: Sequence[str], text_col: str, keys: DataFrame, key_col: str,
                     ignore_case: bool = False) -> DataFrame:
    """Pairs (ids..., key) where ``text`` contains ``key`` (literal match),
    each distinct key once for a left row.  A NULL text contains nothing, a
    NULL key is in nothing, the empty key in every text."""
    rows = _matched(left, ids, F.col(f"`{text_col}`"), keys, key_col, ignore_case)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(ids)], F.explode("found").alias(key_col))


def contains_join(left: DataFrame, text_col: str, keys: DataFrame, key_col: str, ignore_case: bool = False) -> DataFrame:
    """Left theta join on containment: every left row once per matching key,
    or once with a NULL key when nothing matches."""
    rows = _matched(left, left.columns, F.col(f"`{text_col}`"), keys, key_col, ignore_case)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(left.columns)], F.explode_outer("found").alias(key_col))
