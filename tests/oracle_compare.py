"""Run registered Spark queries and their DuckDB oracle SQL side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v, dp: int):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, dp)) if dp >= 0 else repr(v)
    if hasattr(v, "item"):
        return _canon(v.item(), dp)
    return str(v)


def digest(cols: list[str], rows: list[tuple], dp: int = -1) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_canon(r[i], dp) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from screenlake.plans.catalog import ORACLE, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        out["oracle"] = "none"
        return out
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    out.update(oracle_rows=len(drows), cols_match=sorted(scols) == sorted(dcols),
               exact=digest(scols, srows) == digest(dcols, drows),
               dp9=digest(scols, srows, 9) == digest(dcols, drows, 9))
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    if not out["dp9"]:
        so = sorted(scols)
        si = [scols.index(c) for c in so]
        di = [dcols.index(c) for c in so] if out["cols_match"] else si
        a = sorted("|".join(_canon(r[i], 9) for i in si) for r in srows)
        b = sorted("|".join(_canon(r[i], 9) for i in di) for r in drows)
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        out["only_spark"], out["only_oracle"] = diff_a, diff_b
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from screenlake.plans.catalog import QUERIES
    if os.environ.get("PLAIN_SESSION"):
        # what a driver might use: builder defaults, nothing from get_spark
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
            .config("spark.ui.showConsoleProgress", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from screenlake.session import get_spark
        spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names or list(QUERIES):
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("oracle") == "none" or (r.get("exact") and r.get("rows") == r.get("oracle_rows"))
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
