"""Ranking inputs derived from the star-schema and text tables.

Suppliers stand for queries and parts for passages where only ids and scores matter; the
benchmark passages are text queries over the documents. All tables are read whole.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import words
from rankflow.operators.index import InvertedIndex
from rankflow.operators.numbering import top_within
from rankflow.operators.ranking import rank_run
from rankflow.operators.scoring import Collection, retrieve
from rankflow.session import stage

DEV_QUERIES = 200
HELD_OUT = DEV_QUERIES
"""Queries kept out of the training samples: all those of the dev set."""
STRETCHES = 32
"""A user's events are dealt to so many training queries."""
VALUE_STEPS = 20
"""Positives are values of events at this grain; the largest lie beyond the documents."""
OPENINGS, OPENING_WORDS = 8, 8
"""Texts of training queries: so many stretches of words from the start of each document."""
DEV_NEGATIVES = 200
CANDIDATES = 1000
FEEDBACK = 3


class Inputs:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @functools.cached_property
    def evidence(self) -> DataFrame:
        """Per (supplier, part): three scores, each absent without matching lines, and the
        returned quantity that judgements are made from."""
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        points = F.round(F.col("l_discount") * 100).cast("bigint")
        pairs = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("qid"), F.col("l_partkey").alias("pid"))
            .agg(
                F.sum(F.when(status == "O", F.col("l_quantity"))).alias("open"),
                F.sum(F.when(flag != "N", cents)).cast("double").alias("revenue"),
                F.sum(F.when(flag != "A", points)).cast("double").alias("discount"),
                F.sum(F.when(flag == "R", F.col("l_quantity")).otherwise(0.0)).alias("returned"),
                F.count_if(status == "F").alias("filled"),
            )
        )
        balance = self.table("supplier").select(F.col("s_suppkey").alias("qid"), F.col("s_acctbal").alias("balance"))
        return pairs.join(balance, "qid")

    @functools.cached_property
    def unranked_runs(self) -> DataFrame:
        """Three runs; ``discount`` lacks the suppliers with a negative balance."""
        scores = self.evidence.withColumn("discount", F.when(F.col("balance") >= 0, F.col("discount")))
        return scores.unpivot(["qid", "pid"], ["open", "revenue", "discount"], "run", "score").filter("score is not null")

    def ranked_runs(self) -> DataFrame:
        return rank_run(self.unranked_runs, ties="pid", keys=["run", "qid"], unique=True)

    @functools.cached_property
    def runs(self) -> DataFrame:
        """The ranked runs as stored tables, which later steps read more than once."""
        return stage(self.ranked_runs(), "runs")

    @functools.cached_property
    def qrels(self) -> DataFrame:
        """Grades 0 to 3 by returned quantity; pairs without filled lines and suppliers
        with a balance above 9000 are not judged."""
        grade = F.least(F.lit(3), F.floor(F.col("returned") / 15)).cast("int")
        judged = self.evidence.filter("filled > 0 and balance <= 9000")
        return stage(judged.select("qid", "pid", grade.alias("rel")), "qrels")

    @functools.cached_property
    def scored(self) -> DataFrame:
        """Scored candidates in input order, some (qid, pid) more than once."""
        return self.table("events").select(
            F.col("event_id").alias("ord"),
            F.col("user_id").alias("qid"),
            F.get_json_object("props", "$.k").cast("bigint").alias("pid"),
            F.floor(F.col("value") / 10).cast("double").alias("score"),
        )

    @functools.cached_property
    def triples(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("ord"),
            (F.col("user_id") * STRETCHES + F.col("event_id") % STRETCHES).alias("qid"),
            F.floor(F.col("value") * VALUE_STEPS).cast("bigint").alias("pos_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("neg_id"),
        )

    @functools.cached_property
    def queries(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("qid"), "text")

    @functools.cached_property
    def openings(self) -> DataFrame:
        """Training queries with a text: stretches of the documents' first words, blank ones left out."""
        split = self.table("documents").select("doc_id", words("text").alias("words"))
        stretch = lambda s: F.array_join(F.slice("words", s * OPENING_WORDS + 1, OPENING_WORDS), " ")
        stretches = F.transform(F.sequence(F.lit(0), F.lit(OPENINGS - 1)), stretch)
        rows = split.select("doc_id", F.posexplode(stretches).alias("at", "text")).filter("text <> ''")
        return rows.select((F.col("doc_id") * OPENINGS + F.col("at")).alias("qid"), "text")

    @functools.cached_property
    def passages(self) -> DataFrame:
        """The documents. A table in fewer splits than there are cores is dealt out first: one small
        file is one row group and so one task, whatever its text costs; large tables stay as they are. It is
        dealt to the session's shuffle partitions, not to a task per core, whose share would grow with it."""
        documents = self.table("documents").select(F.col("doc_id").alias("pid"), "text")
        cores = self.spark.sparkContext.defaultParallelism
        return documents if len(documents.inputFiles()) >= cores else documents.repartition("pid")

    @functools.cached_property
    def labelled_passages(self) -> DataFrame:
        """A collection with gaps: the documents that carry labels."""
        return self.passages.join(self.table("labels").select(F.col("doc_id").alias("pid")), "pid", "left_semi")

    @functools.cached_property
    def text_triples(self) -> DataFrame:
        """Triples of the queries that have a text."""
        return self.triples.join(self.openings.select("qid"), "qid", "left_semi")

    @functools.cached_property
    def collection(self) -> Collection:
        return Collection.staged(self.passages)

    @functools.cached_property
    def counted(self) -> Collection:
        """The passages as they are, not stored, with their number and length known for the cells of retrieval."""
        return Collection.of(self.passages).counted()

    @functools.cached_property
    def index(self) -> InvertedIndex:
        return InvertedIndex.staged(self.collection)

    @functools.cached_property
    def pairs(self) -> DataFrame:
        """First-stage candidates without text, stored: ``(qid, pid, rank, score)``."""
        return stage(retrieve(self.queries, self.collection, k=CANDIDATES), "pairs")

    @functools.cached_property
    def candidates(self) -> DataFrame:
        """``(ord, qid, pid, passage)`` in retrieval order."""
        text = self.passages.select("pid", F.col("text").alias("passage"))
        return self.pairs.join(text, "pid").select(F.col("rank").alias("ord"), "qid", "pid", "passage")

    @functools.cached_property
    def first_candidates(self) -> DataFrame:
        """Those that feedback may take. Ranks count from 1 without gaps, so none of a later rank is among a
        query's first, and only these get their text."""
        return self.candidates.filter(F.col("ord") <= FEEDBACK)

    @functools.cached_property
    def text_qrels(self) -> DataFrame:
        """Documents that hold a benchmark passage word for word, as grade 3.

        A holder must contain each inner word of the passage as a word of its own. A passage of
        one or two words has no inner word; its first word is a part of a holder's word. Only
        the documents with the rarest inner word, or with such words, are compared as text.
        A passage without words asks for nothing.
        """
        split = self.queries.select("qid", F.col("text").alias("query"), words("text").alias("words"))
        inner = F.array_distinct(F.slice("words", 2, F.greatest(F.size("words") - 2, F.lit(0))))
        asked = split.select("qid", F.explode(inner).alias("word"))
        all_held = self.passages.select("pid", F.explode(F.array_distinct(words("text"))).alias("word"))
        held = all_held.join(asked.select("word").distinct(), "word", "left_semi")
        frequency = held.groupBy("word").agg(F.count("*").alias("df"))
        rarest = top_within(asked.join(frequency, "word"), ["qid"], [("df", True), ("word", True)], 1)
        long = rarest.select("qid", "word").join(held, "word").select("qid", "pid")
        short = split.filter(F.size("words").between(1, 2)).select("qid", F.element_at("words", 1).alias("first"))
        if not short.isEmpty():
            places = F.sequence(F.lit(1), F.length("word"))
            grams = F.flatten(F.transform(places, lambda at: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.substr("word", at, n))))
            parts = all_held.select("word").distinct().select("word", F.explode(F.array_distinct(grams)).alias("gram"))
            hosts = parts.join(short.withColumn("gram", F.substring("first", 1, 3)), "gram").filter(F.contains("word", "first"))
            long = long.union(hosts.select("qid", "word").join(all_held, "word").select("qid", "pid").distinct())
        found = long.join(split.select("qid", "query"), "qid").join(self.passages, "pid").filter(F.contains("text", "query"))
        return found.select("qid", "pid", F.lit(3).alias("rel"))

    @functools.cached_property
    def responses(self) -> DataFrame:
        """Generator answers: each conversation's last assistant turn as JSON. One without
        an assistant turn answers in a field nobody reads."""
        turns = self.table("conversations")
        spoken = F.when(F.col("role") == "assistant", F.col("turn"))
        last = turns.groupBy(F.col("conv_id").alias("qid")).agg(
            F.max_by("text", spoken).alias("answer"), F.max_by("text", "turn").alias("other")
        )
        answer = F.to_json(F.struct(F.col("answer").alias("response")))
        other = F.to_json(F.struct("other"))
        return last.select("qid", F.when(F.col("answer").isNotNull(), answer).otherwise(other).alias("response"))
