"""Run registered queries next to their SQL: ``python tests/compare.py FOLDER [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from rankflow.session import local_session, scratch  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    """Rows as text, columns by name, in sorted order."""

    def show(value: object) -> str:
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        return repr(float(value) + 0.0) if isinstance(value, float) else str(value)

    ordered = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(show(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    kinds = {
        c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind)
        for c in spark_frame.columns
        if len(spark_frame) and spark_frame[c].dtype != sql_frame[c].dtype
    }
    if kinds:
        return f"types {kinds}: {spark_frame.dtypes.to_dict()} != {sql_frame.dtypes.to_dict()}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    off = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(off)} of {len(ours)} rows, first {str(off[0])[:500]}" if off else None


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, sql = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or list(queries):
        started = time.time()
        try:
            with scratch(spark):
                frame = queries[name](spark, folder).toPandas()
            ours = time.time() - started
            if name not in sql:
                print(f"rows   {name}: {len(frame)} ({ours:.1f} s)", flush=True)
                continue
            problem = difference(frame, connection.execute(sql[name]).df())
        except Exception as error:  # report and go on with the next query
            problem, ours = f"{type(error).__name__}: {str(error)[:600]}", time.time() - started
            frame = pd.DataFrame()
        failed += problem is not None
        both = time.time() - started
        print(f"{'FAIL' if problem else 'ok' if len(frame) else 'EMPTY':6} {name}: {problem or len(frame)} ({ours:.1f} s, sql {both - ours:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
