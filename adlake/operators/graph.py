"""Adjacency lists (AG15) in bounded pages.

A vertex's neighbour list is never collected whole: neighbours are grouped by
``(vertex, neighbour // page_size)``, repeated links first made one, so no output row (and no aggregation
buffer) holds more than ``page_size`` ids even for a vertex with a third of
all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adjacency_paged(edges: DataFrame, src: str, dst: str, page_size: int = 1024) -> DataFrame:
    page = F.floor(F.col(dst) / page_size).cast("bigint")
    links = edges.select(F.col(src).alias("vertex"), F.col(dst).alias("_neighbour"), page.alias("page")).distinct()
    return links.groupBy("vertex", "page").agg(F.sort_array(F.collect_list("_neighbour")).alias("neighbours"))


def adjacency_both(edges: DataFrame, a: str, b: str, a_name: str, b_name: str,
                   page_size: int = 1024) -> DataFrame:
    """Both directions of an undirected link table, tagged by side."""
    fwd = adjacency_paged(edges.select(F.col(a).cast("bigint").alias("s"), F.col(b).cast("bigint").alias("d")),
                          "s", "d", page_size)
    rev = adjacency_paged(edges.select(F.col(b).cast("bigint").alias("s"), F.col(a).cast("bigint").alias("d")),
                          "s", "d", page_size)
    return (fwd.select(F.lit(a_name).alias("side"), "*")
            .unionByName(rev.select(F.lit(b_name).alias("side"), "*")))
