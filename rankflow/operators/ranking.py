"""Candidates to ranked runs ``(run, qid, pid, rank, score)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.operators.numbering import SPLIT_ROWS, Order, last_wins, rank_within, top_within

# Order of rows with equal scores: by id, by id descending as text, or as first seen.
TIES: dict[str, tuple[str, bool]] = {"pid": ("pid", True), "trec": ("pid", False), "ord": ("ord", True)}


def run_order(ties: str = "pid") -> Order:
    return [("score", False), TIES[ties]]


def sortable(df: DataFrame, ties: str = "pid") -> DataFrame:
    """Fail on scores without a place in an order; compare ids as text where asked to."""
    bad = F.col("score").isNull() | F.isnan("score")
    checked = df.withColumn("score", F.when(~bad, F.col("score")).otherwise(F.raise_error(F.lit("score is not a number"))))
    return checked.withColumn("pid", F.col("pid").cast("string")) if ties == "trec" else checked


def rank_run(
    scored: DataFrame,
    ties: str = "ord",
    depth: int | None = None,
    keys: Sequence[str] = ("qid",),
    unique: bool = False,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Rank each query's candidates by score descending, from 1.

    A repeated (query, pid) counts once, with its last score at its first position; say
    ``unique`` when there is none and ``ord`` is not needed. ``depth`` keeps the top rows
    only, limited before the shuffle; without it every row of any group size is ranked.
    """
    rows = scored if unique else last_wins(scored, [*keys, "pid"], ["score"])
    rows = sortable(rows, ties)
    if depth is None:
        ranked = rank_within(rows, keys, run_order(ties), identity=["pid"], split_rows=split_rows)
    else:
        ranked = top_within(rows, keys, run_order(ties), depth)
    return ranked.select(*keys, "pid", F.col("rank").cast("bigint").alias("rank"), "score")


def judged_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """Queries with at least one grade above 0."""
    return queries.join(qrels.filter(F.col("rel") > 0).select("qid").distinct(), "qid", "left_semi")
