"""Run registered queries beside their DuckDB text and compare schema, row count and values.

    python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from vigilake.catalog import registry  # noqa: E402
from vigilake.session import build_session  # noqa: E402


def norm(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if value is None or (not isinstance(value, list) and pd.isna(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:26].replace("T00:00:00", "")
    return value


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return sorted(([norm(v) for v in row] for row in pdf[cols].itertuples(index=False)), key=repr)


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for f in glob.glob(f"{a.sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    bad = 0
    for name, (run, sql) in registry().items():
        if a.names and not any(n in name for n in a.names):
            continue
        t = time.time()
        try:
            got = run(spark, a.sf).toPandas()
            took = time.time() - t
            if sql is None:
                print(f"  --  {name}: {len(got)} rows, no SQL ({took:.1f}s)")
                continue
            want = con.execute(sql).df()
            g, w = rows_of(got), rows_of(want)
            if sorted(got.columns) != sorted(want.columns):
                raise AssertionError(f"columns {sorted(got.columns)} != {sorted(want.columns)}")
            kinds = {
                c: (str(got[c].dtype), str(want[c].dtype))
                for c in got.columns
                if str(got[c].dtype) != str(want[c].dtype)
            }
            if g != w:
                diff = [(x, y) for x, y in zip(g, w) if x != y][:3]
                raise AssertionError(f"{len(g)} vs {len(w)} rows; first differences {diff}")
            print(f"  ok  {name}: {len(g)} rows ({took:.1f}s){' dtypes ' + str(kinds) if kinds else ''}")
            if not g:
                print("      ^ EMPTY")
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:1500]}")
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
