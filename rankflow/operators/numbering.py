"""Positions and ranks that never put a whole group into one task.

Three building blocks:

* ``number_blocks`` numbers rows inside small blocks and adds the row count of the
  blocks before them, so only the per-block counts meet in one place;
* ``rank_within`` ranks whole groups of any size by cutting the large ones into blocks
  along their own sort order;
* ``top_within`` keeps the first k per group, which Spark limits before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankflow.session import stage

Order = Sequence[tuple[str, bool]]
"""Sort order as (column, ascending) pairs."""

SPLIT_ROWS = 4_000_000


def sort_columns(order: Order) -> list[Column]:
    return [F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in order]


def last_wins(df: DataFrame, keys: Sequence[str], values: Sequence[str], ord: str = "ord") -> DataFrame:
    """One row per key: the values of its last row, at the position of its first row."""
    newest = [F.max_by(v, ord).alias(v) for v in values]
    return df.groupBy(*keys).agg(*newest, F.min(ord).alias(ord))


def last_wins_wide(df: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """``last_wins`` for rows too wide to shuffle, such as passage texts, in a stored table.

    Only (key, ord) is read and grouped, to find the repeated keys. Without any the rows
    stay as they are; else they meet the stored table of repeats, whose size Spark knows.
    """
    repeated = stage(
        df.groupBy(key)
        .agg(F.count("*").alias("_n"), F.min(ord).alias("_first"), F.max(ord).alias("_last"))
        .filter("_n > 1")
        .drop("_n"),
        "repeated",
    )
    if repeated.isEmpty():
        return df
    rows = df.join(repeated, key, "left")
    kept = rows.filter(F.col("_last").isNull() | (F.col(ord) == F.col("_last")))
    return kept.withColumn(ord, F.coalesce("_first", ord)).drop("_first", "_last")


def number_blocks(
    df: DataFrame, keys: Sequence[str], block: str, order: Order, out: str, counted: DataFrame | None = None
) -> DataFrame:
    """1-based running number per ``keys`` over (block, order).

    ``block`` must not decrease along ``order``. ``counted`` may name the subset of rows
    whose blocks need an offset; by default all rows are counted.
    """
    counts = (df if counted is None else counted).groupBy(*keys, block).agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*keys, block, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys, block).orderBy(*sort_columns(order))
    return (
        df.join(offsets, [*keys, block], "left")
        .withColumn(out, F.coalesce("_before", F.lit(0)) + F.row_number().over(inside))
        .drop("_before")
    )


def _precedes(a: Column, b: Column, order: Order) -> Column:
    """Whether struct ``a`` sorts strictly before struct ``b``."""
    verdict = F.lit(False)
    for name, ascending in reversed(order):
        x, y = a.getField(name), b.getField(name)
        verdict = F.when(x == y, verdict).otherwise(x < y if ascending else x > y)
    return verdict


def _insertion_point(cuts: Column, row: Column, order: Order) -> Column:
    """Binary search: how many of the sorted ``cuts`` do not sort after ``row``."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span.getField("lo"), span.getField("hi")
        mid = F.floor((lo + hi) / 2).cast("int")
        right = ~_precedes(row, F.get(cuts, mid), order)
        return F.when(lo >= hi, span).otherwise(
            F.struct(F.when(right, mid + 1).otherwise(lo).alias("lo"), F.when(right, hi).otherwise(mid).alias("hi"))
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(rounds, start, halve, lambda span: span.getField("lo"))


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    identity: Sequence[str],
    out: str = "rank",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """1-based rank of every row of every group; ``order`` must be total within a group.

    Groups are cut at the rows whose hash over ``keys`` and ``identity`` (the columns that
    tell the rows of a group apart) is 0 modulo ``split_rows``. The cuts depend on the rows
    alone, so a recomputed task sees the same ones, and the filter can move below the
    aggregation that made the rows. Groups far below ``split_rows`` rows rarely hold a cut
    and stay whole; with no cut anywhere, adaptive execution drops the cut joins. The cut
    table holds about rows / ``split_rows`` entries (tens of MB at 10^12 rows), hence its
    broadcast.
    """
    names = [name for name, _ in order]
    cuts = (
        df.filter(F.pmod(F.xxhash64(*keys, *identity), F.lit(split_rows)) == 0)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct(*names)).alias("_cuts"))
        .withColumn(
            "_cuts",
            F.array_sort(
                "_cuts",
                lambda a, b: F.when(_precedes(a, b, order), -1).when(_precedes(b, a, order), 1).otherwise(0),
            ),
        )
    )
    block = F.coalesce(_insertion_point(F.col("_cuts"), F.struct(*names), order), F.lit(0))
    cut = F.broadcast(cuts)
    in_blocks = df.join(cut, list(keys), "left").withColumn("_block", block).drop("_cuts")
    counted = df.join(cut, list(keys)).withColumn("_block", block)
    return number_blocks(in_blocks, keys, "_block", order, out, counted=counted).drop("_block")


def top_within(
    df: DataFrame, keys: Sequence[str], order: Order, k: int, out: str = "rank", fanout: int | None = None
) -> DataFrame:
    """The first ``k`` rows per group with their rank.

    Each task passes on at most ``k`` rows per group. ``fanout`` adds a merge level: the
    survivors of a group first meet in ``fanout`` tasks, then in one. Which of them a row
    takes cannot change the result.
    """
    if fanout:
        via = df.withColumn("_via", F.pmod(F.spark_partition_id(), F.lit(fanout)))
        first = W.partitionBy(*keys, "_via").orderBy(*sort_columns(order))
        df = via.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= k).drop("_rn", "_via")
    ranks = W.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(out, F.row_number().over(ranks).cast("bigint")).filter(F.col(out) <= k)
