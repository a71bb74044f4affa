"""Run every registered query beside its SQL and compare names, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tapeline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    positions = [names.index(n) for n in sorted(names)]
    return sorted(tuple(cell(row[i]) for i in positions) for row in rows)


def compare(spark, connection, name: str, folder: str) -> str:
    """An empty text when both sides agree, else a description of the first difference."""
    df = queries()[name](spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = connection.execute(oracle_sql()[name])
    names = [c[0] for c in relation.description]
    theirs = rows_of(names, relation.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(different)} of {len(ours)} rows differ, first {str(different[0])[:600]}" if different else ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, connection = local_session(), duck(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, connection, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name} {time.time() - start:.2f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
