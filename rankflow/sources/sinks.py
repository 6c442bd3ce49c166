"""Writers; each leaves a folder of part files, as Spark does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_run(run: DataFrame, path: str, tag: str = "STANDARD", rank_base: int = 1) -> None:
    """``qid Q0 pid rank score tag`` lines, ordered by query and rank across part files.

    Ranges are cut on (qid, rank), so one very deep query spreads over several files.
    """
    line = F.concat_ws(
        " ", "qid", F.lit("Q0"), "pid", F.col("rank") + (rank_base - 1), F.col("score").cast("string"), F.lit(tag)
    )
    ordered = run.repartitionByRange("qid", "rank").sortWithinPartitions("qid", "rank")
    ordered.select(line.alias("value")).write.text(path)


def write_queries(queries: DataFrame, path: str) -> None:
    """``qid<TAB>text`` lines."""
    queries.select(F.concat_ws("\t", "qid", "text").alias("value")).write.text(path)


def write_results(results: DataFrame, path: str) -> None:
    """A result table as CSV with a header; it has one row per system, so one file."""
    results.coalesce(1).write.csv(path, header=True)
