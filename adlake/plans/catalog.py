"""Catalog of every registered query key (imports register the keys)."""

from __future__ import annotations

import importlib

from adlake.plans.registry import REGISTRY

_MODULES = (
    "adlake.plans.keys_ppc",
    "adlake.plans.keys_relational",
    "adlake.plans.keys_aggwin",
    "adlake.plans.keys_functions",
    "adlake.plans.keys_marts",
    "adlake.plans.keys_io",
    "adlake.plans.keys_landed",
    "adlake.plans.keys_ml",
)


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return {k: e.build for k, e in sorted(REGISTRY.items())}


def oracle_sql():
    _load()
    return {k: e.sql for k, e in sorted(REGISTRY.items()) if e.sql}


def entries():
    _load()
    return dict(sorted(REGISTRY.items()))
