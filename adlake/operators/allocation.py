"""Even allocation (AG16).

Row counts per key are a partial aggregate; the per-key measure is divided
once per key and joined back to the detail rows (AQE splits a hot key on the
join side).  No ``count() over (partition by key)`` window, which would sort
a hot key inside one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def even_allocation(rows: DataFrame, measures: DataFrame, keys: Sequence[str],
                    outputs: dict[str, str]) -> DataFrame:
    """Spread each per-key measure evenly over the detail rows of that key:
    ``allocated = measure / rows_with_key``.  Keys with no measure, and rows
    with a NULL key, get NULL; every detail row stays."""
    n = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    per_row = n.join(measures, list(keys), "left").select(
        *keys, *[(F.col(m) / F.col("_n")).alias(o) for m, o in outputs.items()])
    return rows.join(per_row, list(keys), "left")
