"""Compare a query with its SQL, value by value.

    python -m parity.compare [directory] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

from worklens.session import local_session

from .oracle import ORACLE
from .queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(table: pa.Table) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return sorted(zip(*columns), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query's result and its SQL; empty if nothing does."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    kinds = [{f.name: _kind(f.type) for f in t.schema} for t in (ours, theirs)]
    if kinds[0] != kinds[1]:
        found.append(f"schema: {sorted(kinds[0].items())} against {sorted(kinds[1].items())}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows: {ours.num_rows} against {theirs.num_rows}")
    if not found:
        pairs = zip(sorted_rows(ours), sorted_rows(theirs))
        unequal = [(a, b) for a, b in pairs if a != b]
        if unequal:
            found.append(f"{len(unequal)} rows differ, first: {unequal[0]}")
    return found


def _kind(kind: pa.DataType) -> str:
    """Type name without unit or string width."""
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz is None else "timestamp_tz"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.perf_counter()
        try:
            found = differences(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.perf_counter() - start:.2f}s")
        for line in found:
            print("     ", line[:900])
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
