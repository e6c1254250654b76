"""Schema normalisation (PR7-PR11, PR13): plan-time column surgery.

All of it is metadata on the logical plan (one ``select``); no data moves.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise(df: DataFrame, drop: Sequence[str] = (), lower: bool = False,
              move: dict[str, int] | None = None, blanks: dict[int, str] | None = None,
              names: Sequence[str] | None = None) -> DataFrame:
    """Drop columns, lower-case names, move columns to positions, insert
    blank text columns at positions, then rename all columns positionally.
    Steps apply in that order, each on the result of the previous one."""
    cols = [c for c in df.columns if c not in set(drop)]
    exprs = {c: F.col(f"`{c}`") for c in cols}
    if lower:
        exprs = {c.lower(): e for c, e in exprs.items()}
        cols = [c.lower() for c in cols]
    for c, pos in (move or {}).items():
        cols.remove(c)
        cols.insert(pos, c)
    for pos, name in sorted((blanks or {}).items()):
        cols.insert(pos, name)
        exprs[name] = F.lit("")
    out = df.select(*[exprs[c].alias(c) for c in cols])
    if names is not None:
        if len(names) != len(cols):
            raise ValueError(f"{len(names)} names for {len(cols)} columns")
        out = out.toDF(*names)
    return out


def add_columns_if_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """PR13: conditional conversion by column presence, decided at plan
    time from ``df.columns``."""
    missing = [F.lit(v).alias(k) for k, v in defaults.items() if k not in df.columns]
    return df.select("*", *missing) if missing else df


def fill_numeric_and_text(df: DataFrame, number=0, text="0") -> DataFrame:
    """S9: pandas ``fillna(0)`` also writes into text columns."""
    return df.fillna(number).fillna(text)
