"""Run the queries and their SQL on the same tables and compare: `python -m verification.compare [sf] [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from verification.queries import registered
from wattline.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def rows_as_text(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    """Values in the order of the column names, rows in the order of their values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def mismatch(df: DataFrame, rows: list[tuple], result: duckdb.DuckDBPyRelation) -> str | None:
    """What differs in names, types, number of rows or values; None when nothing does."""
    here = sorted((name, _TYPES[kind]) for name, kind in df.dtypes)
    there = sorted((name, str(kind)) for name, kind in zip(result.columns, result.types))
    if here != there:
        return f"columns {here} != {there}"
    left, right = rows_as_text(df.columns, rows), rows_as_text(result.columns, result.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(differing)} rows differ, first: {differing[0]}" if differing else None


def main() -> int:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = build_session("compare", spark__master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, failures = connect(sf_dir), 0
    for name, (fn, sql) in registered().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(row) for row in df.collect()]
            problem = mismatch(df, rows, db.sql(sql)) if sql else None
        except Exception as error:  # report and go on with the next query
            rows, problem = [], f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={len(rows)} {time.time() - begun:.1f}s {problem or ''}",
              flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main())
