"""Relational building blocks (PR/FI/JO/AG/WI/SE families).

Scale notes that apply to the whole module:

* "one row per key" picks are partial aggregates over ``struct`` values
  (``max``/``min`` of a struct compares field by field).  Spark combines them
  map-side, so a key holding a third of all rows is reduced before the
  shuffle instead of being sorted in one task as a window would be.
* totals that are attached back to detail rows are computed as a grouped
  aggregate and joined back (partial aggregation + a join AQE can split when
  skewed), not as ``sum() over (partition by key)``, which would put a hot key
  into one task.
* no explicit broadcast unless the caller passes a side whose size is bounded
  by construction; otherwise AQE converts a join to broadcast from runtime
  statistics (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(xs: Iterable[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ------------------------------------------------------------- row picks

def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 latest: bool = True, payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest (``latest=True``) or
    smallest ``order`` tuple.  Ties on ``order`` are broken by the remaining
    payload columns in their listed order (S4: a total order, deterministic).

    NULL sorts lowest inside a struct, so ``latest`` = ``ORDER BY .. DESC
    NULLS LAST`` and ``not latest`` = ``ORDER BY .. ASC NULLS FIRST``.
    """
    payload = [c for c in (payload if payload is not None else df.columns)
               if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + list(payload)])
    agg = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_pick"))
    return out.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in list(order) + list(payload)])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   payload: Sequence[str] | None = None) -> DataFrame:
    """WI1/WI2: QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ts DESC)=1."""
    return pick_per_key(df, keys, [ts], latest=True, payload=payload)


def first_by_priority(df: DataFrame, keys: Sequence[str], priority: Sequence[str],
                      payload: Sequence[str] | None = None) -> DataFrame:
    """WI4/WI6: lowest priority wins, ties broken by payload."""
    return pick_per_key(df, keys, priority, latest=False, payload=payload)


# ------------------------------------------------------------- unions

def union_tagged(arms: Sequence[tuple[DataFrame, dict]]) -> DataFrame:
    """SE1/PR2/PR3: union of arms, each tagged with literal columns; columns
    missing in an arm are NULL (by name, widened types)."""
    tagged = [df.select("*", *[F.lit(v).alias(k) for k, v in tags.items()]) for df, tags in arms]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """SE4: concatenate frames by column name (pandas ``concat``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ------------------------------------------------------------- joins

def left_join_on_filter(left: DataFrame, right: DataFrame, on, right_filter: Column) -> DataFrame:
    """JO2: constant predicate belongs to the ON clause; filtering the right
    side first keeps unmatched left rows."""
    return left.join(right.where(right_filter), on, "left")


def semi_join(left: DataFrame, ids: DataFrame, on) -> DataFrame:
    """JO18: ``id IN (subquery)`` without duplicating left rows."""
    return left.join(ids, on, "left_semi")


def coalesce_fallback(df: DataFrame, lookup: DataFrame, on, pairs: dict[str, str]) -> DataFrame:
    """JO12: ``coalesce(primary, lookup)`` for each ``primary -> lookup`` pair."""
    j = df.join(lookup, on, "left")
    return j.select(*[F.coalesce(F.col(c), F.col(pairs[c])).alias(c) if c in pairs else F.col(c)
                      for c in df.columns])


def attach_group_totals(df: DataFrame, keys: Sequence[str], measures: dict[str, Column],
                        null_keys_match: bool = False) -> DataFrame:
    """WI10/JO11: per-key totals next to every detail row.  Aggregate (partial,
    map-side) then join back; rows with a NULL key get NULL totals unless
    ``null_keys_match``."""
    totals = df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    if null_keys_match:
        cond = [df[k].eqNullSafe(totals[k]) for k in keys]
        j = df.join(totals, reduce(lambda a, b: a & b, cond), "left")
        return j.select(*[df[c] for c in df.columns], *[totals[n] for n in measures])
    return df.join(totals, list(keys), "left")


def dict_map(col: Column | str, mapping: dict, default=None) -> Column:
    """JO16: map values through a literal dict (unmapped -> default/NULL).  A
    map literal lives in the expression: no join, no shuffle."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, c)
    return v if default is None else F.coalesce(v, F.lit(default))


# ------------------------------------------------------------- aggregates

def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """AG10: pandas ``value_counts`` (NULL dropped, count descending)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(name))
            .orderBy(F.col(name).desc(), F.col(col)))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, name_fmt: str = "{}") -> DataFrame:
    """AG11/RS5: ``groupby([row, col]).size().unstack()`` with a known column
    domain (explicit pivot values keep it a single pass; absent -> NULL)."""
    p = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return p.select(row, *[F.col(f"`{v}`").alias(name_fmt.format(v)) for v in values])


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """AG13: NULL count of every column in one pass (one output row)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c + suffix) for c in cols])


# ------------------------------------------------------------- reshape

def unpivot_wide(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 var: str = "variable", value: str = "value") -> DataFrame:
    """RS1: melt; NULL values are kept."""
    return df.unpivot(list(ids), list(values), var, value)


def nth_rows_to_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                        value: str, n: int = 3, prefix: str = "slot") -> DataFrame:
    """RS4/JO7: the first ``n`` values per key (by ``order``) as columns
    ``slot1..n``.  A row number inside the key (Spark stops it at ``n`` rows of
    a key before the shuffle), then one grouped pass; no self-joins."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order])
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return ranked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_rn") == k, F.col(value))).alias(f"{prefix}{k}") for k in range(1, n + 1)])
