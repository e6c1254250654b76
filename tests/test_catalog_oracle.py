"""Every registered key agrees with its DuckDB oracle on the smallest driver
data (the driver repeats this at sf0.01); keys without SQL build and run."""

import os
import subprocess
import sys

import duckdb
import pytest

from adlake.plans.catalog import entries
from tests.conftest import SMOKE
from tools.check_oracle import TABLES, compare

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_key_matches_its_oracle(spark, con):
    failed = {}
    for key, entry in entries().items():
        assert entry.ids, key
        got = entry.build(spark, SMOKE).toArrow()
        if entry.sql is None:
            assert got.num_rows, key
            continue
        res = compare(got, con.sql(entry.sql).to_arrow_table())
        if not res["ok"]:
            failed[key] = res
    assert len(entries()) >= 110 and not failed


def test_the_catalog_needs_no_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout.split()[0]) >= 110, done.stderr


def test_plans_of_the_large_joins(spark):
    """No nested loops, and no window over all rows without a partition."""
    for key in ("sales_divisors", "contains_join", "contains_documents", "ads_summary", "ppc_mart", "trends_long", "category_codes"):
        plan = entries()[key].build(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, key
    for key in ("ads_summary", "ppc_mart", "fn_coalesce"):
        assert "Window" not in entries()[key].build(spark, SMOKE)._jdf.queryExecution().executedPlan().toString().replace("WindowGroupLimit", ""), key
