"""Lookups: last-match config rows (JO14), first exact match (JO13)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from adlake.operators.relational import pick_per_key


def last_match_lookup(cfg: DataFrame, key: str, pos: str, values: Sequence[str]) -> DataFrame:
    """Config sheet semantics: when a key appears on several rows the last
    row (greatest ``pos``) wins.  Partial aggregate, so it stays map-side."""
    return pick_per_key(cfg, [key], [pos], latest=True, payload=list(values))


def first_match_lookup(table: DataFrame, key: str, pos: str, values: Sequence[str]) -> DataFrame:
    """VLOOKUP(exact): first row (smallest ``pos``) per key."""
    return pick_per_key(table, [key], [pos], latest=False, payload=list(values))
