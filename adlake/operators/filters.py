"""Name-based include/exclude filters (FI7) and banded rules (FI13)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_filter(df: DataFrame, name_col: str, not_contains: Sequence[str] = (),
                contains: Sequence[str] = (), status_col: str | None = None,
                statuses: Sequence[str] = (), id_col: str | None = None) -> DataFrame:
    """Every ``not_contains`` term absent AND (any ``contains`` term present),
    case-insensitive; optional status set; distinct ids.

    That nothing matches is an error for the alert job, which checks it as an
    action (``operations.require_campaigns``), outside the plan."""
    name = F.lower(F.col(name_col))
    conds: list[Column] = [~F.contains(name, F.lit(t.lower())) for t in not_contains]
    if contains:
        conds.append(reduce(lambda a, b: a | b, [F.contains(name, F.lit(t.lower())) for t in contains]))
    if status_col and statuses:
        conds.append(F.col(status_col).isin(list(statuses)))
    out = df.where(reduce(lambda a, b: a & b, conds)) if conds else df
    return out.select(id_col).distinct() if id_col else out


def banded_flag(value: Column, change: Column, bands: Sequence[tuple], yes="Yes", no="No") -> Column:
    """FI13: first band ``lo <= value <= hi`` whose change threshold is
    crossed (``change < threshold``) -> ``yes``; otherwise ``no``.
    ``hi`` None = open upper end."""
    conds = []
    for lo, hi, thr in bands:
        in_band = value >= lo if hi is None else value.between(lo, hi)
        conds.append(in_band & (change < thr))
    hit = reduce(lambda a, b: a | b, conds)
    return F.when(hit, F.lit(yes)).otherwise(F.lit(no))
