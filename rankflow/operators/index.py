"""An inverted index in blocks with their greatest contributions, and exact retrieval that skips blocks.

A term's postings are dealt to levels by what they contribute and, within a level, to blocks of
about ``BLOCK_POSTINGS`` by hash, so no term needs to pass through one task. A block is one row:
its greatest contribution, without the term's weight, and its passages.

Retrieval reads the blocks of the asked terms once, deals their postings to cells of the collection and
lets each query skip in its cell what cannot reach its k-th best score.

``planned_blocks`` tells for a small query set which blocks it needs. Each query first takes its best
blocks, by bound, until they hold ``spare`` times k postings; exact scores of their passages, from the
forward index, give a floor under its k-th best score. It then takes blocks as long as a passage in none of
them could still reach the floor, or all of them where that skips little. What a passage outside the taken
blocks can score is at most the sum, over terms, of the best bound left, which falls by known steps along
the order of the blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankflow.operators.cells import SLACK, best_by_cell
from rankflow.operators.numbering import top_within
from rankflow.operators.scoring import Collection, part, query_terms, score_bm25
from rankflow.session import stage

BLOCK_POSTINGS = 256
MOST_LEVELS = 32
SPARE = 2
WORTH = 0.5
"""Blocks are skipped where they hold this share of a query's postings; else reading them is the shorter way."""


@dataclass(frozen=True)
class InvertedIndex:
    """A stored collection with ``blocks`` ``(id, block, bound, n, postings[pid, part])``, for one length setting."""

    collection: Collection
    blocks: DataFrame
    k1: float
    b: float

    @staticmethod
    def staged(collection: Collection, k1: float = 0.9, b: float = 0.4, block_postings: int = BLOCK_POSTINGS) -> InvertedIndex:
        """Postings are written once; later query sets read blocks and forward rows, never text."""
        if collection.vocabulary is None:
            raise ValueError("an index needs a stored collection")
        postings = collection.counts.withColumn("part", part(collection.mean_length, k1, b))
        sized = postings.join(collection.vocabulary.select(F.col("id").alias("term"), "df"), "term")
        levels = F.least(F.lit(MOST_LEVELS), F.ceil(F.col("df") / block_postings))
        level = F.least(F.floor(F.col("part") / (k1 + 1) * levels), levels - 1)
        salt = F.pmod(F.xxhash64("pid"), F.ceil(F.col("df") / block_postings))
        blocks = sized.groupBy(F.col("term").alias("id"), level.alias("level"), salt.alias("salt")).agg(
            F.max("part").alias("bound"), F.count("*").alias("n"), F.collect_list(F.struct("pid", "part")).alias("postings")
        )
        named = blocks.select("id", F.struct("level", "salt").alias("block"), "bound", "n", "postings")
        return InvertedIndex(collection, stage(named, "blocks"), k1, b)


def _ordered(index: InvertedIndex, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each query's blocks by bound: what earlier ones hold, and what passages outside the earlier ones can score.

    Taking a block lowers a term's best bound left to that of the term's next block.
    """
    heads = index.blocks.select("id", "block", "bound", "n")
    met = weights.join(heads, "id").withColumn("most", F.col("idf") * F.col("bound"))
    of_term = W.partitionBy(*keys, "id").orderBy(F.desc("most"), "block")
    step = F.col("most") - F.coalesce(F.lead("most").over(of_term), F.lit(0.0))
    met = met.withColumn("step", step)
    # Blocks of a term are cut by count, so a query's list is a small part of its postings.
    earlier = W.partitionBy(*keys).orderBy(F.desc("most"), "id", "block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    return met.withColumn("held", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn(
        "reach", F.sum("step").over(whole) - F.coalesce(F.sum("step").over(earlier), F.lit(0.0))
    )


def _passages(index: InvertedIndex, taken: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, pid, so_far)``: the passages of the taken blocks with what those contribute."""
    rows = taken.select(*keys, "id", "block", "idf").join(index.blocks.select("id", "block", "postings"), ["id", "block"])
    each = rows.select(*keys, "idf", F.explode("postings").alias("p"))
    return each.groupBy(*keys, F.col("p.pid").alias("pid")).agg(F.sum(F.col("idf") * F.col("p.part")).alias("so_far"))


def planned_blocks(
    queries: DataFrame, index: InvertedIndex, k: int, keys: Sequence[str] = ("qid",), spare: int = SPARE
) -> DataFrame:
    """All blocks of each query's terms with ``floor``, ``reach`` and whether they are ``taken``, stored."""
    names = list(keys)
    ordered = stage(_ordered(index, index.collection.weights(query_terms(queries, keys)).withColumnRenamed("term", "id"), keys), "ordered")
    first = _passages(index, ordered.filter(F.col("held") < spare * k), keys)
    best = top_within(first, keys, [("so_far", False), ("pid", True)], k).select(*keys, "pid")
    exact = score_bm25(best, queries, index.collection, index.k1, index.b, keys)
    floors = top_within(exact, keys, [("score", False), ("pid", True)], k).filter(F.col("rank") == k)
    met = ordered.join(floors.select(*keys, F.col("score").alias("floor")), names, "left")
    reached = F.col("floor").isNull() | (F.col("reach") >= F.col("floor") - SLACK)
    saved = met.groupBy(*keys).agg((F.sum(F.when(~reached, F.col("n"))) > WORTH * F.sum("n")).alias("worth"))
    whole = met.join(saved, names).withColumn("taken", reached | ~F.coalesce("worth", F.lit(False))).drop("worth")
    return stage(whole, "planned")


def retrieve_indexed(
    queries: DataFrame, index: InvertedIndex, k: int = 1000, keys: Sequence[str] = ("qid",), spare: int = SPARE
) -> DataFrame:
    """Top ``k`` passages per query: ``(keys, pid, rank, score)``, the rows of ``scoring.retrieve``.

    The asked terms' blocks are read once for all queries and meet them cell by cell (``cells``), where each
    query stops reading postings of common terms once they cannot matter; a query set of any size makes no
    row per query and block or posting.
    """
    collection = index.collection
    weights = collection.weights(query_terms(queries, keys)).select(*keys, "term", F.col("idf").alias("weight"))
    asked = weights.select(F.col("term").alias("id")).distinct()
    each = index.blocks.select("id", "postings").join(asked, "id", "left_semi").select(F.col("id").alias("term"), F.explode("postings").alias("p"))
    postings = each.select("p.pid", "term", "p.part")
    scored = best_by_cell(postings, weights, collection.cells, keys, k, spare)
    top = top_within(scored, keys, [("score", False), ("pid", True)], k)
    return top.select(*keys, "pid", "rank", "score")
