"""Run registered queries in Spark and their reference SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names, and the sorted multiset of rows (exact).
Test tool only: it brings both results to the driver to compare them.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6)))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (1, str(int(v)))
    return (1, str(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    d = con.execute(sql).fetchdf()
    d_cols = sorted(d.columns)
    res["oracle_rows"] = len(d)
    if s_cols != d_cols:
        res["status"] = f"COLUMNS {s_cols} vs {d_cols}"
        return res
    a = rows_of(s_rows, s_cols)
    b = rows_of(d.to_dict("records"), d_cols)
    if a == b:
        res["status"] = "OK"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "VALUES"
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_oracle"] = [x for x in b if x not in sa][:3]
    return res


def main(argv):
    from lakelayer.session import get_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], ors.get(k), sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
