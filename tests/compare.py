"""Run queries on Spark and their SQL on DuckDB and compare rows. ``python tests/compare.py 0.01 [name ...]``"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, pd.Timestamp):
        return value.date().isoformat()
    return value.isoformat()[:10] if hasattr(value, "isoformat") else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    rows = [tuple(_plain(v) for v in row) for row in frame[names].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"]
    ours, theirs = rows_of(spark_frame), rows_of(sql_frame)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows and {len(theirs)} rows"]
    names = sorted(spark_frame.columns)
    found = []
    for a, b in zip(ours, theirs):
        found += [f"{n}: {x!r} and {y!r} in {a[:4]}" for n, x, y in zip(names, a, b) if x != y]
        if len(found) > 5:
            break
    return found


def main() -> None:
    import __spark_entry__ as contract
    from ebbtide.session import build_session

    scale, wanted = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = query(spark, sf_dir).toPandas()
            spent = time.time() - started
            found = differences(frame, con.execute(oracle[name]).df()) if name in oracle else ["no SQL"]
            print(f"{name:34s} {len(frame):7d} rows {spent:6.1f} s sql {time.time() - started - spent:5.1f} s", found or "equal", flush=True)
        except Exception:
            print(name, "FAILED", traceback.format_exc()[-1500:], flush=True)


if __name__ == "__main__":
    main()
