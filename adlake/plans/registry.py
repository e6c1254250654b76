"""Query registry: key -> (Spark plan builder, DuckDB oracle SQL).

A key's builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables; the oracle is an independent SQL text over the same tables, or
``None`` when the operator is not SQL-expressible (grouped numpy fits).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] | str = ()):
    """Decorator registering a query key.  ``ids`` names the SURVEY §2 rows
    the key exercises."""
    if isinstance(ids, str):
        ids = tuple(i.strip() for i in ids.split(",") if i.strip())

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate key {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn

    return deco
