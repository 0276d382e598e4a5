"""Run registered queries against DuckDB on the same tables: ``python tests/check_oracle.py SF [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        return canonical(value.item())
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def rows_of(frame: pd.DataFrame):
    columns = sorted(frame.columns)
    rows = [tuple(canonical(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return columns, sorted(rows, key=lambda row: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row))


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    (cols_a, a), (cols_b, b) = rows_of(spark_frame), rows_of(sql_frame)
    if cols_a != cols_b:
        return f"columns differ: {sorted(set(cols_a) ^ set(cols_b))}"
    if len(a) != len(b):
        return f"row count {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if bad:
        x, y = bad[0]
        diff = [(c, p, q) for c, p, q in zip(cols_a, x, y) if repr(p) != repr(q)]
        return f"{len(bad)} of {len(a)} rows differ, e.g. {diff[:3]} in {x}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from voltmart.session import get_spark

    sf, names = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_spark(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                "spark.ui.enabled": "false",
                                "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name in oracles:
                problem = compare(got, duck(sf_dir).execute(oracles[name]).df())
                status = "OK" if problem is None else f"MISMATCH {problem}"
            else:
                status = "rows-only"
        except Exception as exc:
            got, took, status = [], time.time() - start, f"ERROR {str(exc)[:600]}"
        failed += not status.startswith(("OK", "rows"))
        print(f"{name:40s} {took:6.2f}s {len(got):7d} {status}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
