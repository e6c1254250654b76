"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into geometric buckets (lengths in a bucket
differ by LENGTH_STEP at most), and a large bucket into blocks of about
BLOCK_VALUES components by a hash of the row.  Each query gets a lower bound of
its k-th score from SEED_ROWS long vectors; divided by the query's length it is
the least length a vector needs, so shorter vectors are not sent to a query,
nor queries to buckets that are too short.  What is left meets in blocks: every
pair of a block of vectors and a block of queries is one small group.

Inside a block the bound divided by both lengths is the local cosine threshold
of a query.  A threshold over 1 ends the pair.  From the least threshold on at
which coordinate lists are short for the block's queries, a query looks through
the rows whose components in its FOCUS greatest coordinates can still reach the
cosine; below it, through all rows that are long enough.  Products of the rows
left are exact integers, and each block returns its best k for a query.

A vector that very many rows share is kept with its k + 1 least ids only: the
others come behind them in every result, as ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.tables import written

K = 10
LENGTH_STEP = 1.05
BLOCK_VALUES = 1 << 19  # components of the vectors, or queries, of a block
SEED_ROWS = 4096  # at most; they only set the first bounds
SEED_VALUES = 1 << 19
FOCUS = 4  # coordinates looked at
SHORT_LIST = 0.125  # of the long enough rows: coordinates pay up to here
QUERY_CHUNK = 1 << 22  # scores held at once
_SLACK = 1e-9
_EXACT = float(1 << 53)
_LEAST, _GREATEST = -(2**63), 2**63 - 1


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v, norm) of the usable rows: v holds floor(scale * x) of each
    component as a long (which stops at 64 bits).  Vectors that are null or
    hold a null or non-finite component are left out."""
    x = F.col(f"`{vector}`").cast("array<double>")
    infinite = F.lit(float("inf"))
    usable = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < infinite), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("bigint"))
    return (rows.where(usable).select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), v.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))))


def _hash(*cols: str) -> Column:
    return F.xxhash64(F.lit("topk"), *cols)


def candidate_rows(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, v, norm, bucket): the k + 1 least ids of each distinct vector.
    The limit is applied before the shuffle as well."""
    same = Window.partitionBy("key", "v").orderBy(F.col("vec_id").asc_nulls_last())
    keyed = rows.withColumn("key", F.xxhash64("v")).withColumn("no", F.row_number().over(same)).where(F.col("no") <= k + 1)
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(LENGTH_STEP))).otherwise(-1)
    return keyed.select("vec_id", "v", "norm", bucket.cast("int").alias("bucket"))


def _matrix(lists: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A long matrix of list rows; shorter vectors end in zeros."""
    col = lists.combine_chunks()
    sizes = np.diff(col.offsets.to_numpy()) if len(col) else np.zeros(0, np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    width = max(int(sizes.max(initial=0)), width or 0)
    if (sizes == width).all():
        return flat.reshape(len(col), width)
    out = np.zeros((len(col), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _both(q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with the same number of columns in a type in which all
    products and sums are exact."""
    width = max(q.shape[1], r.shape[1])
    q, r = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, r))
    most = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (q, r)]
    bound = most[0] * most[1] * max(width, 1)
    kind = np.float64 if bound < _EXACT else np.int64 if bound <= _GREATEST else object
    return q.astype(kind), r.astype(kind)


def _products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `q` with all of `r` as longs; greater ones
    stop at the ends of the range."""
    out = q @ r.T
    return np.clip(out, _LEAST, _GREATEST).astype(np.int64) if out.dtype == object else out.astype(np.int64)


def _ids(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and where they are null."""
    one = col.combine_chunks()
    return one.fill_null(0).to_numpy(zero_copy_only=False), one.is_null().to_numpy(zero_copy_only=False)


def _best(scores: np.ndarray, at: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best of `scores` (of rows `at`), ties to the
    smaller id, a null id last."""
    if len(scores) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, at = scores[keep], at[keep]
    order = np.lexsort((ids[at], nulls[at], ~scores))[:k]
    return at[order], scores[order]


def _bounds(seeds: pa.Table, k: int):
    """Adds `bound` to queries: their (k + 1)-th best product with the seeds,
    null if there are fewer."""
    held = seeds.column("v").combine_chunks()

    def run(batches):
        vectors = _matrix(pa.chunked_array([held]))
        for batch in batches:
            bounds = [None] * batch.num_rows
            if len(vectors) > k:
                q, r = _both(_matrix(pa.chunked_array([batch.column("v")])), vectors)
                step = max(1, QUERY_CHUNK // len(r))
                bounds = [int(x) for a in range(0, len(q), step)
                          for x in np.partition(_products(q[a : a + step], r), len(r) - k - 1, axis=1)[:, len(r) - k - 1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds, pa.int64())], names=[*batch.schema.names, "bound"])

    return run


def _lists(q: np.ndarray, cosine: np.ndarray, unit: np.ndarray):
    """For each query of length 1 the coordinate list of fewest rows: its
    coordinate, first and last place in the order of that coordinate, for the
    FOCUS greatest coordinates; and the ranges of all of them."""
    focus = np.argsort(-np.abs(q), axis=1, kind="stable")[:, :FOCUS]
    value = np.take_along_axis(q, focus, axis=1)
    c = np.clip(cosine, -1.0, 1.0)[:, None]
    spread = np.sqrt(np.maximum(0.0, (1 - c * c) * (1 - value * value)))
    low = np.where(-value >= c, -1.0, value * c - spread) - _SLACK
    high = np.where(value >= c, 1.0, value * c + spread) + _SLACK
    used = np.unique(focus)
    orders = {f: np.argsort(unit[:, f], kind="stable") for f in used.tolist()}
    first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f, order in orders.items():
        here = focus == f
        sorted_values = unit[order, f]
        first[here] = np.searchsorted(sorted_values, low[here], side="left")
        last[here] = np.searchsorted(sorted_values, high[here], side="right")
    return focus, low, high, orders, first, last


def search_block(q: np.ndarray, q_norm: np.ndarray, bound: np.ndarray, r: np.ndarray, r_norm: np.ndarray,
                 ids: np.ndarray, nulls: np.ndarray, k: int):
    """Yields (query, rows, scores): each query's k best rows of a block among
    those whose product reaches its `bound` (-inf if there is none)."""
    order = np.argsort(-r_norm, kind="stable")
    q, r = _both(q, r[order])
    r_norm, ids, nulls = r_norm[order], ids[order], nulls[order]
    needs = (bound > 0) & (q_norm > 0)
    length = np.where(needs, bound / np.where(q_norm > 0, q_norm, 1.0) * (1 - _SLACK), -1.0)  # a row's, at least
    long_enough = np.searchsorted(-r_norm, -length, side="right")
    longest = r_norm[0] if len(r_norm) else 0.0
    cosine = np.where(needs, length / longest, -1.0) if longest > 0 else np.where(needs, 2.0, -1.0)
    alive = (long_enough > 0) & (cosine <= 1.0)
    by_list = np.zeros(len(q), bool)
    some = np.flatnonzero(alive & needs)
    if len(some):
        unit = r.astype(np.float64) / np.where(r_norm > 0, r_norm, 1.0)[:, None]
        focus, low, high, orders, first, last = _lists(q[some].astype(np.float64) / q_norm[some][:, None], cosine[some], unit)
        least = np.argmin(last - first, axis=1)
        pick = np.arange(len(some))
        share = (last - first)[pick, least] / long_enough[some]
        down = np.argsort(-cosine[some], kind="stable")
        short = np.cumsum(share[down]) <= SHORT_LIST * np.arange(1, len(some) + 1)
        n_short = len(short) - int(np.argmax(short[::-1])) if short.any() else 0
        by_list[some[down[:n_short]]] = True
        for i in down[:n_short].tolist():
            f = least[i]
            rows = orders[int(focus[i, f])][first[i, f] : last[i, f]]
            rows = rows[rows < long_enough[some[i]]]
            for g in range(focus.shape[1]):
                if g != f:
                    x = unit[rows, focus[i, g]]
                    rows = rows[(x >= low[i, g]) & (x <= high[i, g])]
            scores = _products(q[some[i]][None, :], r[rows])[0]
            reach = scores >= bound[some[i]]
            at, found = _best(scores[reach], rows[reach], ids, nulls, k)
            yield int(some[i]), order[at], found
    rest = np.flatnonzero(alive & ~by_list)
    rest = rest[np.argsort(-long_enough[rest], kind="stable")]
    step = max(1, QUERY_CHUNK // max(1, len(r)))
    for a in range(0, len(rest), step):
        chunk = rest[a : a + step]
        scores = _products(q[chunk], r[: long_enough[chunk[0]]])
        for i, row in zip(chunk.tolist(), scores):
            reach = np.flatnonzero(row >= bound[i])
            at, found = _best(row[reach], reach, ids, nulls, k)
            yield i, order[at], found


def _search(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q_ids, q_nulls = _ids(queries.column("query_id"))
        ids, nulls = _ids(rows.column("vec_id"))
        bound = queries.column("bound").combine_chunks().cast(pa.float64(), safe=False).fill_null(-math.inf).to_numpy(zero_copy_only=False)
        out = {"no": [], "vec_id": [], "score": []}
        if len(q_ids) and len(ids):
            for i, at, scores in search_block(
                    _matrix(queries.column("v")), queries.column("norm").to_numpy(), bound, _matrix(rows.column("v")),
                    rows.column("norm").to_numpy(), ids, nulls, k + 1):
                out["no"].append(np.full(len(at), i))
                out["vec_id"].append(at)
                out["score"].append(scores)
        no, at, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out.values())
        of = queries.take(pa.array(no))
        return pa.table([of.column("query_id"), of.column("key"), of.column("self"), of.column("copies"),
                         pa.array(ids[at], pa.int64(), mask=nulls[at]), pa.array(scores, pa.int64())],
                        names=["query_id", "key", "self", "copies", "vec_id", "score"])

    return run


def _self_products(batches):
    for batch in batches:
        lists = batch.column("v").to_pylist()
        own = [min(sum(x * x for x in v), _GREATEST) for v in lists]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], names=[*batch.schema.names, "self"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of `queries` its k highest
    inner products with the rows of `rows`, all if there are fewer.  Both have
    (vec_id, v, norm) as from `integer_vectors`; a query's own row, one with
    its id and vector, doesn't count if `rows` has it.

    Ties go to the smaller id, a null id last.  Rows equal in id and vector
    are separate candidates, and separate queries.  Of vectors of different
    length the shorter ends in zeros.  Products beyond 64 bits stop there.  An
    empty table gives an empty one."""
    spark = rows.sparkSession
    candidates = written(candidate_rows(rows, k), "topk-candidates")
    sizes = candidates.groupBy("bucket").agg(F.max("norm").alias("most"), F.sum(F.greatest(F.size("v"), F.lit(1))).alias("n"), F.count("*").alias("rows"))
    buckets = sizes.orderBy("bucket").collect()  # 64-bit lengths make some 1000 buckets at most
    width = sum(b["n"] for b in buckets) / max(1, sum(b["rows"] for b in buckets))
    n_seeds = max(k + 1, min(SEED_ROWS, int(SEED_VALUES / max(1.0, width))))
    seeds = candidates.orderBy(F.desc("bucket"), _hash("vec_id", "v")).select("v").limit(n_seeds).toArrow()

    asked = queries.groupBy("vec_id", "v", "norm").agg(F.count("*").alias("copies"))
    asked = asked.select(F.col("vec_id").alias("query_id"), _hash("v").alias("key"), "v", "norm", "copies")
    kinds = "query_id long, key long, v array<long>, norm double, copies long"
    asked = asked.mapInArrow(_self_products, f"{kinds}, self long").mapInArrow(_bounds(seeds, k), f"{kinds}, self long, bound long")
    # 1 - _SLACK a second time, as the block works the length out anew
    need = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm") * (1 - 2 * _SLACK)).otherwise(-1.0)
    asked = written(asked.withColumn("need", need).withColumn("kind", F.when(F.col("need") > 0, F.floor(F.log2("need"))).otherwise(-1000).cast("int")), "topk-queries")
    kinds_found = asked.groupBy("kind").agg(F.min("need").alias("need"), F.sum(F.greatest(F.size("v"), F.lit(1))).alias("n")).orderBy("kind").collect()  # some 130 at most

    if not buckets or not kinds_found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = {q["kind"]: -(-q["n"] // BLOCK_VALUES) for q in kinds_found}
    blocks = {b["bucket"]: -(-b["n"] // BLOCK_VALUES) for b in buckets}

    def numbered(options: list[tuple[float, int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(no).alias("no"), F.lit(int(n)).alias("n")) for x, no, n in options])

    def of(table: dict[int, int], column: str) -> Column:
        return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col(column)]

    wanted = F.filter(numbered([(b["most"], b["bucket"], blocks[b["bucket"]]) for b in buckets]), lambda b: b["x"] >= F.col("need"))
    places = F.flatten(F.transform(wanted, lambda b: F.transform(F.sequence(F.lit(0), b["n"] - 1), lambda i: F.struct(b["no"].alias("bucket"), i.alias("block")))))
    left = (asked.withColumn("part", F.pmod(_hash("query_id", "key"), of(parts, "kind")).cast("int")).withColumn("at", F.explode(places))
            .select(F.struct("at.bucket", "at.block", "kind", "part").alias("pair"), "query_id", "key", "v", "norm", "copies", "self", "bound"))
    wanting = F.filter(numbered([(q["need"], q["kind"], parts[q["kind"]]) for q in kinds_found]), lambda q: q["x"] <= F.col("norm"))
    sent = F.flatten(F.transform(wanting, lambda q: F.transform(F.sequence(F.lit(0), q["n"] - 1), lambda i: F.struct(q["no"].alias("kind"), i.alias("part")))))
    right = (candidates.withColumn("block", F.pmod(_hash("vec_id", "v"), of(blocks, "bucket")).cast("int")).withColumn("to", F.explode(sent))
             .select(F.struct("bucket", "block", "to.kind", "to.part").alias("pair"), "vec_id", "v", "norm"))
    found = left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(
        _search(k), "query_id long, key long, self long, copies long, vec_id long, score long")

    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    first = found.withColumn("no", F.row_number().over(best)).where(F.col("no") <= k + 1)
    own = F.min(F.when(F.col("vec_id").eqNullSafe(F.col("query_id")) & (F.col("score") == F.col("self")), F.col("no")))
    ranked = first.withColumn("own", F.coalesce(own.over(Window.partitionBy("query_id", "key")), F.lit(k + 2))).where("no <> own")
    ranked = ranked.withColumn("rank", F.when(F.col("no") > F.col("own"), F.col("no") - 1).otherwise(F.col("no")).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def report(rows: DataFrame, k: int = K, every: int = 100) -> DataFrame:
    """The k best of every row whose vec_id is divisible by `every`, among all
    rows but its own."""
    vectors = written(integer_vectors(rows), "topk-vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
