"""Running totals over rows in hash blocks, so that no total needs all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 50_000
MOST_BLOCKS = 1 << 16


def block_count(rows: int) -> int:
    """Blocks of about ``BLOCK_ROWS`` rows each, up to ``MOST_BLOCKS``."""
    return min(MOST_BLOCKS, rows // BLOCK_ROWS + 1)


def with_running(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[Column], out: str, weight: Column | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (rows without one) over the earlier rows of the same ``keys``.

    Rows go by ``block``, then ``order``. Keys and block are not null; only block sums meet.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    sums = df.groupBy(*keys, block).agg(F.sum(weight).alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(*keys, block, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys, block).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        df.join(before, [*keys, block])
        .withColumn(out, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_before")
    )
