"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from contrail.sources.fixtures import BASE_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return [cols[i] for i in order], out


def compare(spark, name: str, sf_dir: str, con) -> dict:
    from contrail.plans.catalog import ORACLE, QUERIES
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows = [tuple(r) for r in rel.fetchall()]
    res["oracle_rows"] = len(drows)
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    if sc != dc:
        res["status"] = f"SCHEMA {sc} vs {dc}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"VALUES differ ({len(sr)} vs {len(dr)}) e.g. {diff}"
    else:
        res["status"] = "ok"
    return res


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="bare session, as the driver builds it")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from contrail.plans.catalog import QUERIES
    from contrail.session import build_session
    if a.plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session()
    con = duck(a.sf)
    bad = 0
    for n in a.names or list(QUERIES):
        try:
            r = compare(spark, n, a.sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
