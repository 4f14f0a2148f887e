"""Compare every registered query with its SQL counterpart in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

import datetime
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
from ridemart.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if pd.isna(value):
        return ""
    if isinstance(value, datetime.date):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float) and value == int(value) and abs(value) < 2**53:
        return str(int(value))
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(_value(value) for value in row) for row in frame.itertuples(index=False, name=None))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(want.columns)}"
    mine, theirs = rows_of(got), rows_of(want)
    if mine == theirs:
        return None
    extra, missing = set(mine) - set(theirs), set(theirs) - set(mine)
    return f"{len(mine)} rows instead of {len(theirs)}; extra {sorted(extra)[:3]}; missing {sorted(missing)[:3]}"


def main(sf_dir: str, *names: str) -> int:
    spark = local_session(8)
    connection = connect(sf_dir)
    oracle, failed = entry_point.oracle_sql(), 0
    for name, query in entry_point.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        got = query(spark, sf_dir).toPandas()
        spent = time.time() - started
        problem = difference(got, connection.execute(oracle[name]).df()) if name in oracle else "no oracle"
        failed += problem is not None
        print(f"{name:28s} {len(got):8d} rows {spent:7.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", *sys.argv[2:]))
