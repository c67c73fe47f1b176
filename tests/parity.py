"""Engine-vs-oracle comparison used by the tests and by hand.

Runs a registered query on Spark and its oracle SQL on DuckDB over the same
Parquet tables, then compares row count, column names and the multiset of
rows (order-insensitive).

    python -m tests.parity [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    res = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": s_cols == o_cols, "spark_cols": s_cols, "oracle_cols": o_cols}
    if sorted(s_cols) == sorted(o_cols):
        order = [o_cols.index(c) for c in s_cols]
        o_rows = [tuple(r[i] for i in order) for r in o_rows]
    res["values_match"] = sorted(s_rows, key=_key) == sorted(o_rows, key=_key)
    res["ok"] = res["values_match"] and res["columns_match"] and len(s_rows) == len(o_rows)
    if not res["ok"]:
        ss, oo = set(s_rows), set(o_rows)
        res["only_spark"] = sorted(ss - oo, key=_key)[:5]
        res["only_oracle"] = sorted(oo - ss, key=_key)[:5]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from ludolake.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        except Exception as exc:  # report and go on
            print(f"ERROR {k}: {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        flag = "ok " if r["ok"] else "BAD"
        print(f"{flag} {k}: spark={r['spark_rows']} oracle={r['oracle_rows']} "
              f"cols={r['columns_match']} values={r['values_match']}")
        if not r["ok"]:
            bad += 1
            print("   spark cols ", r["spark_cols"], "\n   oracle cols", r["oracle_cols"])
            print("   only spark ", r.get("only_spark"))
            print("   only oracle", r.get("only_oracle"))
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
