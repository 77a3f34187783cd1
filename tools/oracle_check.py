"""Run every query in Spark and its SQL in DuckDB; compare rows, columns and values.

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def frame_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    cols = df.columns
    if sql is None:
        return dict(name=name, rows=len(rows), oracle=None, spark_s=round(t_spark, 2))
    rel = con.sql(sql)
    ocols = list(rel.columns)
    orows = rel.fetchall()
    h1, l1 = frame_hash(cols, rows)
    h2, l2 = frame_hash(ocols, orows)
    res = dict(name=name, rows=len(rows), oracle_rows=len(orows), cols_ok=sorted(cols) == sorted(ocols),
               hash_ok=h1 == h2, spark_s=round(t_spark, 2))
    if not res["cols_ok"]:
        res["cols"] = (sorted(cols), sorted(ocols))
    if not res["hash_ok"]:
        a, b = set(l1), set(l2)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
    return res


def main():
    import duckdb

    from stationday.plans.oracle import ORACLE_SQL
    from stationday.plans.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    from stationday.session import local_session

    spark = local_session(8, "stationday-oracle-check")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLE_SQL.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=n, error=f"{type(e).__name__}: {str(e)[:400]}")
        ok = "error" not in r and (r.get("oracle") is None and "oracle_rows" not in r
                                   or (r.get("hash_ok") and r.get("cols_ok") and r["rows"] == r["oracle_rows"]))
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
