"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.tables import written


def _star(edges: DataFrame, name: str, rows: int) -> DataFrame:
    """Each (u, v) with `m`, the least neighbour of u.  The minimum is partial
    and written, so that the join can split a node that has very many edges."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least", rows)
    return edges.join(least, "u")


def connected(edges: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(node, root) of every node of the undirected edges (u, v): root is the
    component's least node.  Loops and repeated edges do no harm; no edges, no
    rows.  `rows` is a bound of the edges, if known.  Only counts and checksums
    come to the driver."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    current = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name, rows)
    before = state(current)
    rows = 2 * before[0]  # the number of edges never grows
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, name, rows).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = written(large, f"{name}-large", rows)
        small = _star(large, name, rows)
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = written(small.select("e.u", "e.v").where("u <> v").distinct(), name, rows)
        now = state(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
