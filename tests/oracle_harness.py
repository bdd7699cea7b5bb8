"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
Compares row count, column names, a coarse type class and an
order-insensitive multiset of normalised values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _type_class(t: str) -> str:
    t = t.lower()
    if t in ("int", "integer", "int32"):
        return "int"
    if t in ("bigint", "long", "int64"):
        return "bigint"
    if t in ("double", "float64"):
        return "double"
    if t in ("string", "varchar"):
        return "string"
    if t in ("date",):
        return "date"
    if t in ("boolean",):
        return "bool"
    return t


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = {f.name: _type_class(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"key": key, "rows": len(s_rows), "oracle": False, "spark_sec": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: _type_class(str(d[1])) for d in res.description}
    d_rows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    s_cols = list(s_types)
    out = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: spark={s_cols} duck={d_cols}"
        return out
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if type_diff:
        out["type_diff"] = type_diff
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted(tuple(r[i] for i in si) for r in s_rows)
    b = sorted(tuple(r[i] for i in di) for r in d_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_duck"] = list(sb - sa)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from noticeflow.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, con, sf_dir, key, qs[key], sqls.get(key))
        except Exception as e:  # report and continue
            r = {"key": key, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("match", not r.get("oracle", True) is True) and "error" not in r and "type_diff" not in r
        if not ok:
            bad += 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"done: {len(keys or qs)} queries, {bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
