"""Helpers shared by the operators of this subpackage.

Operators read only the columns they name and return their own columns, so further input
columns, whatever their names, neither clash nor travel along.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PIECE_CHARS = 1 << 20
SLICE_ROWS = 512
_BREAK = re.compile(r"[ \t\n\r]")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns only, renamed: ``picked(df, key="doc_id", text="text")``."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """``function`` on slices of each Arrow batch, so that what it makes stays small as well.

    Spark bounds the rows and bytes of a batch. ``done`` is called at the end of a task, to
    leave no memory behind in a worker that goes on to other work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    out = function(batch.slice(at, SLICE_ROWS))
                    if out.num_rows:
                        yield out
        finally:
            if done:
                done()
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """One text at a time, null as the empty text."""
    for value in batch.column(name):
        yield value.as_py() or ""


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``limit`` characters, cut after blanks only; nearly always just one."""
    start = 0
    while len(text) - start > limit:
        found = _BREAK.search(text, start + limit)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


def one_of_each(columns: list[str]) -> Column:
    """A 128-bit digest of the columns, equal for equal rows, nulls told apart from blanks."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
