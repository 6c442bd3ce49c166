"""Embedding whitening with MLlib's BlockMatrix.

Centred rows are indexed and cut into distributed blocks. Blocks multiplied with their
transposes add up to the scatter matrix, whose eigenvectors are found on the driver (dimensions
squared, whatever the rows). The blocks multiplied by the whitening matrix are the projected rows.

An entry c counts as floor(1024 c) + 100000, so sums are exact. Rows whose vector is null, or
holds null or non-finite entries or entries of ``LARGEST`` or more, are left out; so are vectors
of another length than the commonest (of equally common ones the longest). Null and repeated keys
are rows like others. Components without variance have null values. A table without rows to
fit gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import stage

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**40
COMPONENTS = 8
BLOCK_ROWS = 1024
SPLIT_BLOCKS = 8
"""So many row blocks are multiplied with their transposes by one task before its sum moves on."""
STRETCH_ROWS = 1 << 22
"""MLlib deals R row blocks to the square root of the partitions, so longer tables go stretch by stretch."""
NO_VARIANCE = 1e-12
_IN_PART = 33
"""``monotonically_increasing_id`` counts rows of a partition in the bits below this one."""


@dataclass(frozen=True)
class Whitening:
    """The fitted figures, components by falling eigenvalue, and the projected rows."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    explained: np.ndarray
    components: np.ndarray
    identity_error: float
    rows: DataFrame
    """``(key, deviation, whitened)``, the values of a row's components as one array."""


def _whole(entry: Column) -> Column:
    return F.coalesce(F.abs(entry) < LARGEST, F.lit(False))  # not-a-number is greater than all numbers


def prepared(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, key, x)`` of the rows to fit, stored; ids rise by one within each task's rows."""
    rows = picked(vectors, key=key, v=vector).withColumn("v", F.col("v").cast("array<double>"))
    rows = rows.filter(F.col("v").isNotNull() & F.forall("v", _whole))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    whole = F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    kept = rows.filter(F.size("v") == (common[0].d if common else 0))
    return stage(kept.select(F.monotonically_increasing_id().alias("id"), "key", whole.alias("x")), "vectors")


def _stretches(rows: DataFrame, most: int) -> Iterator[tuple[DataFrame, int]]:
    """``rows`` with a gapless ``index`` from 0, and how many, in stretches of about ``most`` rows.

    What comes to the driver is one count per task that wrote the rows.
    """
    part = F.shiftright("id", _IN_PART).alias("part")
    counts = [(r.part, r.n) for r in rows.groupBy(part).agg(F.count("*").alias("n")).orderBy("part").collect()]
    while counts:
        taken, size = [], 0
        while counts and (not taken or size + counts[0][1] <= most):
            part_id, n = counts.pop(0)
            taken.append((part_id, size))
            size += n
        low, high = taken[0][0] << _IN_PART, (taken[-1][0] + 1) << _IN_PART
        starts = rows.sparkSession.createDataFrame(taken, "part bigint, start bigint")
        inside = rows.filter((F.col("id") >= low) & (F.col("id") < high)).withColumn("part", part)
        index = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << _IN_PART) - 1))
        yield inside.join(F.broadcast(starts), "part").withColumn("index", index).drop("part", "start"), size


def _blocks(rows: DataFrame, values: Column, n: int, d: int) -> BlockMatrix:
    vectors = rows.select("index", array_to_vector(values).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, d)
    return matrix.toBlockMatrix(BLOCK_ROWS, d)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left.multiply(right)`` with the inner dimension dealt to ``splits`` tasks, which Python's own call leaves out."""
    wrapper = left._java_matrix_wrapper
    product = wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The blocks' matrix times its transpose, columns by columns."""
    splits = -(-blocks.numRowBlocks // SPLIT_BLOCKS)
    return _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()


def _projected(sc: SparkContext, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``(index, values)``: the blocks' rows times a small matrix."""
    d, k = matrix.shape
    whole = DenseMatrix(d, k, matrix.ravel(order="F").tolist())
    right = BlockMatrix(sc.parallelize([((0, 0), whole)], 1), d, k, d, k)
    rows = callMLlibFunc("getIndexedRows", blocks.multiply(right).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))


def _totals(rows: DataFrame, d: int, entry: Column | str, kind: str) -> list:
    """Sums of an array column by position."""
    sums = rows.select(F.posexplode(entry).alias("at", "e")).groupBy("at").agg(F.sum(F.col("e").cast(kind)).alias("s"))
    found = {r["at"]: r["s"] for r in sums.collect()}
    return [found[i] for i in range(d)]


def _less(values: Column | str, means: list[float]) -> Column:
    return F.zip_with(values, F.array(*[F.lit(float(m)) for m in means]), lambda a, m: a.cast("double") - m)


def _deviation(n: int, sums: list[int]) -> Column:
    """The sum over dimensions of (n x - S) squared, exact; null where 38 digits do not hold it."""
    totals = F.array(*[F.lit(Decimal(s)).cast("decimal(38,0)") for s in sums])
    times = F.lit(n).cast("decimal(19,0)")
    apart = F.zip_with("x", totals, lambda x, s: (x.cast("decimal(18,0)") * times).cast("decimal(38,0)") - s)
    zero = F.lit(0).cast("decimal(38,0)")
    return F.aggregate(
        apart, zero, lambda total, a: F.try_add(total, F.try_multiply(a, a).cast("decimal(38,0)")).cast("decimal(38,0)")
    )


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, stretch_rows: int = STRETCH_ROWS
) -> Whitening | None:
    """Fit on all vectors and project them all; None where there is nothing to fit."""
    rows = prepared(vectors, key, vector)
    n = rows.count()
    d = len(rows.first().x) if n else 0
    if not d:
        return None
    sums = [int(s) for s in _totals(rows, d, "x", "decimal(18,0)")]
    means = [s / n for s in sums]
    covariance = np.zeros((d, d))
    stretches = [(part, size, _blocks(part, _less("x", means), size, d)) for part, size in _stretches(rows, stretch_rows)]
    for _, _, blocks in stretches:
        covariance += scatter(blocks) / n
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    trace = float(np.trace(covariance))
    kept = min(components, d)
    varies = values[:kept] > NO_VARIANCE * trace
    matrix = np.where(varies, columns[:, :kept] / np.sqrt(np.where(varies, values[:kept], 1.0)), 0.0)

    projected = []
    for part, _, blocks in stretches:
        deviation = part.select("index", "id", "key", _deviation(n, sums).alias("deviation"))
        projected.append(stage(deviation.join(_projected(rows.sparkSession.sparkContext, blocks, matrix), "index"), "projected"))
    whole = projected[0]
    for part in projected[1:]:
        whole = whole.union(part)
    averages = [t / n for t in _totals(whole, kept, "values", "double")]
    again = np.zeros((kept, kept))
    for part, (_, size, _) in zip(projected, stretches, strict=True):
        again += scatter(_blocks(part, _less("values", averages), size, kept)) / n
    error = np.abs(again - np.eye(kept))[np.ix_(varies, varies)].max(initial=0.0)
    shown = F.zip_with("values", F.array(*[F.lit(bool(v)) for v in varies]), lambda v, ok: F.when(ok, v))
    explained = values[:kept] / trace if trace else np.zeros(kept)
    return Whitening(n, sums, values, explained, columns[:, :kept], float(error), whole.select("key", "deviation", shown.alias("whitened")))
