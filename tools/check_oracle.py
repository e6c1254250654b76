"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tools/check_oracle.py [--sf DIR] [key ...]

Reports per key: row counts, column names, type families and values
(order-insensitive; floats exact and within 1e-9 relative).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def family(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return "int"
    if pa.types.is_floating(t):
        return "float"
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_boolean(t):
        return "bool"
    if pa.types.is_date(t):
        return "date"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return "list"
    if pa.types.is_struct(t):
        return "struct"
    return str(t)


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, v)
    if isinstance(v, decimal.Decimal):
        return (2, float(v))
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (4, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (5, tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return (6, tuple((k, norm(x)) for k, x in sorted(v.items())))
    return (7, str(v))


def close(a, b) -> bool:
    if a == b:
        return True
    if a[0] == 2 and b[0] == 2:
        x, y = a[1], b[1]
        return abs(x - y) <= 1e-9 * max(1.0, abs(x), abs(y))
    if a[0] == b[0] and a[0] in (5, 6):
        return len(a[1]) == len(b[1]) and all(close(p, q) for p, q in zip(a[1], b[1]))
    return False


def rows_of(tbl: pa.Table):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    rows = [tuple(norm(col[i]) for col in data) for i in range(tbl.num_rows)]
    rows.sort(key=lambda r: tuple((x[0], str(x[1])) for x in r))
    return cols, rows


def compare(spark_tbl: pa.Table, duck_tbl: pa.Table) -> dict:
    res = {"rows_spark": spark_tbl.num_rows, "rows_oracle": duck_tbl.num_rows}
    s_cols, d_cols = sorted(spark_tbl.column_names), sorted(duck_tbl.column_names)
    res["columns_match"] = s_cols == d_cols
    if not res["columns_match"]:
        res["cols_spark_only"] = sorted(set(s_cols) - set(d_cols))
        res["cols_oracle_only"] = sorted(set(d_cols) - set(s_cols))
        return res
    fam_diff = {c: (str(spark_tbl.schema.field(c).type), str(duck_tbl.schema.field(c).type))
                for c in s_cols
                if family(spark_tbl.schema.field(c).type) != family(duck_tbl.schema.field(c).type)}
    res["type_family_diff"] = fam_diff
    _, sr = rows_of(spark_tbl)
    _, dr = rows_of(duck_tbl)
    res["exact"] = sr == dr
    if not res["exact"] and len(sr) == len(dr):
        # sort with rounding so float noise does not reorder rows
        bad = [i for i, (a, b) in enumerate(zip(sr, dr))
               if not all(close(x, y) for x, y in zip(a, b))]
        res["close"] = not bad
        if bad:
            i = bad[0]
            res["first_diff"] = {c: (a[1], b[1]) for c, a, b in zip(s_cols, sr[i], dr[i]) if not close(a, b)}
            res["n_diff_rows"] = len(bad)
    else:
        res["close"] = res["exact"]
    res["ok"] = (res["rows_spark"] == res["rows_oracle"] and res["columns_match"]
                 and not fam_diff and res["close"])
    return res


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()

    from adlake.session import get_spark
    from adlake.plans.catalog import queries, oracle_sql

    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    keys = args.keys or sorted(qs)
    summary = {}
    for k in keys:
        t0 = time.time()
        try:
            st = qs[k](spark, args.sf).toArrow()
        except Exception as e:  # noqa: BLE001
            summary[k] = {"ok": False, "spark_error": repr(e)[:400]}
            traceback.print_exc()
            print(k, summary[k], flush=True)
            continue
        t1 = time.time()
        if k not in sqls:
            summary[k] = {"ok": None, "rows_spark": st.num_rows, "note": "no oracle"}
        else:
            try:
                dtbl = con.sql(sqls[k]).to_arrow_table()
                if hasattr(dtbl, "read_all"):
                    dtbl = dtbl.read_all()
                summary[k] = compare(st, dtbl)
            except Exception as e:  # noqa: BLE001
                summary[k] = {"ok": False, "oracle_error": repr(e)[:400]}
        summary[k]["spark_sec"] = round(t1 - t0, 2)
        print(k, json.dumps(summary[k], default=str), flush=True)
    n_ok = sum(1 for v in summary.values() if v.get("ok"))
    n_no = sum(1 for v in summary.values() if v.get("ok") is None)
    print(f"SUMMARY ok={n_ok} no_oracle={n_no} fail={len(summary) - n_ok - n_no} of {len(summary)}")
    bad = [k for k, v in summary.items() if v.get("ok") is False]
    if bad:
        print("FAILED:", " ".join(bad))


if __name__ == "__main__":
    main()
