"""Mixing sources to target weights by weighted fair queueing.

Every source has a target number of words.  Its documents, in a shuffled but
fixed order, get virtual finish times: the source's words up to and including
the document, divided by the source's target.  A source with a target above
its size goes round again, up to `max_repeats` times.  The mix is the global
order by finish time, cut where the total budget is used up.

Nothing is ordered in one task: running sums are taken inside hash buckets of a
source and shifted by the sums of the buckets before; the cut is found from a
histogram of finish times and one of its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.tables import own_columns, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
ROWS_PER_BUCKET = 2_000
MOST_BINS = 1 << 17  # of the histogram, which one task sums up; one bin is then ordered


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sized_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place): `place` is the pseudo-random place in the
    shuffled order, a function of the row alone."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text")).alias("place"))


def ranked_sources(sized: DataFrame) -> DataFrame:
    """(source, source_size, rank): sources numbered from 0 by code point, null
    last; ranges are numbered apart and shifted by the counts before them."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranges = written(
        totals.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (ranges.groupBy("part").agg(F.count("*").alias("n"))  # a row per range, not per source
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    return (ranges.withColumn("no", F.row_number().over(own) - 1).join(shift, "part")
            .select("source", "source_size", (F.col("no") + F.col("shift")).alias("rank")))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, rank, target).  The budget, the sum of all sizes,
    is shared by weight; a source's target stops at `max_repeats` times its
    size, and what it leaves is shared again by weight.  Each round sends two
    sums to the driver, whatever the number of sources."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(
        ranked_sources(sized).withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(max_repeats)), "mix-targets")
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    unit, full = 0.0, -1
    while budget:
        over = F.col("most") < F.col("weight") * unit
        n, held, free = sources.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not free:
            break
        unit, full = (budget - held) / free, n
    return sources.select("source", "source_size", "rank",
                          F.least(F.col("most"), F.col("weight") * F.lit(unit)).alias("target"))


def queued(sized: DataFrame, targets: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """`sized` with rank, source_size, target and `upto`, the source's words up
    to and including the document."""
    n = sized.count()
    buckets = max(1, -(-n // rows_per_bucket))
    known = (sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
             .drop(targets["source"]).withColumn("bucket", F.pmod(F.col("place"), F.lit(buckets))))
    sums = known.groupBy("rank", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("rank", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("shift"))
    inside = (Window.partitionBy("rank", "bucket").orderBy("place", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    return (known.withColumn("inside", F.sum("size").over(inside)).join(shift, ["rank", "bucket"])
            .withColumn("upto", F.col("inside") + F.col("shift")).drop("inside", "shift", "bucket"))


def finish_times(max_repeats: int = MAX_REPEATS) -> Column:
    """Virtual finish time of each round of a queued document."""
    return F.array(*[(F.col("upto") + F.col("source_size") * k) / F.col("target") for k in range(max_repeats)])


def cut_time(queue: DataFrame, budget: int, max_repeats: int = MAX_REPEATS,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> float:
    """The last finish time at which the mix keeps to the budget; entries of
    equal time stay together."""
    n = queue.count()
    bins = min(max(64, -(-n // rows_per_bucket) * 4), MOST_BINS)
    entries = (queue.where((F.col("size") > 0) & (F.col("target") > 0))
               .select("size", F.explode(finish_times(max_repeats)).alias("finish"))
               .withColumn("bin", F.least(F.floor(F.col("finish") * bins), F.lit(2 * bins)).cast("bigint")))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    filled = (entries.groupBy("bin").agg(F.sum("size").alias("n"), F.max("finish").alias("last"))
              .withColumn("upto", F.sum("n").over(upto)))  # a row per bin
    whole = filled.where(F.col("upto") <= budget).agg(F.max("bin"), F.max("upto"), F.max("last")).first()
    last_bin, used, last = whole[0], whole[1] or 0, whole[2] or 0.0
    after = F.lit(True) if last_bin is None else F.col("bin") > last_bin
    edge = filled.where(after).agg(F.min("bin")).first()[0]
    if edge is None:
        return last
    by_time = Window.orderBy("finish").rowsBetween(Window.unboundedPreceding, 0)
    within = (entries.where(F.col("bin") == edge).groupBy("finish").agg(F.sum("size").alias("n"))
              .withColumn("upto", F.sum("n").over(by_time)).where(F.col("upto") <= budget - used)
              .agg(F.max("finish")).first()[0])
    return last if within is None else within


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken,
    rounds (times the mix takes the document), first_finish and `place`.

    Null texts have size 0 and take nothing; null sources are one source, the
    last.  Repeated rows are separate documents of equal size.  An empty table
    gives an empty plan.  Columns other than doc_id, source and text are not
    read.  Reruns agree: order and cut are functions of the rows alone."""
    sized = written(sized_rows(docs), "mix-sized")
    targets = written(source_targets(sized, weights, max_repeats), "mix-target")
    queue = written(queued(sized, targets), "mix-queue", sized.count())
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    cut = cut_time(queue, budget, max_repeats)
    rounds = F.when(F.col("target") > 0, F.size(F.filter(finish_times(max_repeats), lambda t: t <= F.lit(cut)))).otherwise(0)
    return queue.select(
        "doc_id", "size", "source_size", "target", (rounds * F.col("size")).cast("bigint").alias("taken"),
        rounds.cast("int").alias("rounds"),
        F.when(F.col("target") > 0, F.col("upto") / F.col("target")).alias("first_finish"), "rank", "place")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: a row of `docs` for every time it is taken, with
    mix_round and mix_finish (in place of columns of these names), range-sorted
    by finish time.  Rows equal in
    doc_id and text are taken alike, as often as the one that is taken most."""
    plan = mix_plan(docs, weights, max_repeats)
    taken = (plan.where("rounds > 0").groupBy("doc_id", "place")
             .agg(F.max(F.struct("rounds", "first_finish", "source_size", "target")).alias("mix")))
    taken = taken.select(F.struct("doc_id", "place").alias("key"), "mix")
    row = F.struct(*own_columns(docs, "mix_round", "mix_finish"))  # in a struct their names can't clash
    key = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text")).alias("place"))
    rows = docs.select(row.alias("row"), key.alias("of"))
    rows = rows.join(taken, rows["of"].eqNullSafe(taken["key"])).select("row", "mix", F.explode(F.sequence(F.lit(0), F.col("mix.rounds") - 1)).alias("round"))
    finish = F.col("mix.first_finish") + F.col("round") * F.col("mix.source_size") / F.col("mix.target")
    out = rows.select("row.*", F.col("round").alias("mix_round"), finish.alias("mix_finish"))
    return out.repartitionByRange("mix_finish").sortWithinPartitions("mix_finish", "doc_id")
