"""Runs registered queries next to their SQL in DuckDB and compares the results.

    python tests/check.py [sf folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle(sf: str, text: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    # as a view, so that a text that only a session could run does not pass
    con.execute(f"CREATE VIEW wanted AS {text}")
    return con.execute("SELECT * FROM wanted").fetchdf()


def rows_of(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, sorted, in comparable form."""
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "null"
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if hasattr(v, "item"):
            v = v.item()
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    ordered = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in ordered.itertuples(index=False, name=None))


def compare(spark, sf: str, run, text: str) -> str | None:
    """None when both sides agree, else what differs."""
    got_df = run(spark, sf)
    got, want_df = got_df.toPandas(), oracle(sf, text)
    if sorted(got.columns) != sorted(want_df.columns):
        return f"columns {sorted(got.columns)} != {sorted(want_df.columns)}"
    for c in got.columns:
        # whole numbers must be whole on both sides
        if len(got) and got[c].notna().all() and \
                pd.api.types.is_integer_dtype(got[c]) != pd.api.types.is_integer_dtype(want_df[c]):
            return f"type of {c}: {got[c].dtype} != {want_df[c].dtype}"
    a, b = rows_of(got), rows_of(want_df)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(pairs)} of {len(a)} rows differ, first {pairs[0]}"
    return None if len(a) else "no rows on either side"


def main() -> int:
    from halfhourly.session import get_spark
    import __spark_entry__ as driver
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    zone = os.environ.get("CHECK_ZONE", "UTC")
    spark = get_spark("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-"),
                                              "spark.sql.session.timeZone": zone,
                                              "spark.sql.ansi.enabled": os.environ.get("CHECK_ANSI", "true")})
    spark.sparkContext.setLogLevel("ERROR")
    sqls, bad = driver.oracle_sql(), 0
    for name, run in driver.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, sf, run, sqls[name])
            else:
                problem = None if run(spark, sf).count() else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.2f}s "
              f"{problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
