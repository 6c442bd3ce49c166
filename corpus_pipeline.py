"""A training-text pipeline over ``documents``.

Five stages: quality rules, near-duplicates, benchmark leaks, secrets, pieces. Each works on
all rows its predecessor kept; all but the last return the columns of ``documents``, with
``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import decontamination, pieces, quality, secrets, simhash
from rankflow.llm.common import table
from rankflow.llm.queries import PIECE_MODEL, PIECE_SEED, tokenizer_path
from rankflow.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their boilerplate lines."""
    return _measured(quality.filtered(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.representatives(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return _measured(secrets.redacted(docs, secrets.train_on(docs)))


def dropout_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document."""
    encoded = pieces.encode(docs, tokenizer_path(PIECE_MODEL), seed=PIECE_SEED)
    return encoded.withColumnRenamed("key", "doc_id")


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secret_spans", secret_spans),
    ("dropout_pieces", dropout_pieces),
]

ORACLE_SQL = None  # fingerprints, models and pieces are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
