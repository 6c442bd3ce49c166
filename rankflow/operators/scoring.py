"""Query-passage scoring: a batch slot for a caller's model, and BM25 as the built-in.

BM25 meets queries and passages on their terms only. Terms are counted inside each passage
row and filtered to the query vocabulary before anything moves, so passage text is never
shuffled. The filtered counts move by passage id, which serves document frequencies, and to
their cell of the collection, where every query meets them (``cells``); retrieval sends on only
the best k rows per query and cell, and makes no row per query and posting.

Given pairs are scored from the other side, with a forward index: one row per passage with its
terms and counts as arrays. A pair meets its query's weights and its passage's row once each, and
array functions do the rest; there is no row per pair and term.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.scores import LEXICAL_PLACES
from rankflow.functions.text import terms, words
from rankflow.operators.cells import best_by_cell, cell_count, cell_count_later
from rankflow.operators.numbering import top_within
from rankflow.session import exists, released, stage

COUNTED_ROWS = 1000
"""Passages whose terms are counted at a time."""
PARTS_PER_CELL = 4
"""Postings of an unstored, counted collection are dealt by passage to so many tasks per cell."""
PART_BYTES = 1 << 26
"""Pairs are sorted by length in parts of about so many bytes of text."""

Scorer = Callable[[list[str], list[str]], Sequence[float]]


def build_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Query text beside each of its candidates; queries without candidates fall away."""
    return candidates.join(queries.select("qid", F.col("text").alias("query")), "qid").select(
        "ord", "qid", "pid", "query", "passage"
    )


def by_length(pairs: DataFrame, parts: int | None = None) -> DataFrame:
    """Pairs in the order of their words, so that a batch of neighbours has little padding.

    Ranges of lengths go to the parts, which hold about equal bytes of text, ``PART_BYTES`` unless
    their number is given; a hash cuts a length that many pairs have. ``ord`` tells where a pair was.
    A job sums the bytes of every length first.
    """
    length = F.coalesce(F.size(words("query")) + F.size(words("passage")), F.lit(0))
    size = F.coalesce(F.octet_length("query"), F.lit(0)) + F.coalesce(F.octet_length("passage"), F.lit(0)) + 1
    sized = pairs.withColumn("_length", length)
    lengths = stage(sized.groupBy("_length").agg(F.sum(size).alias("_bytes")), "lengths")
    total = lengths.agg(F.sum("_bytes")).first()[0] or 1
    parts = parts or math.ceil(total / PART_BYTES)
    earlier = W.orderBy("_length").rowsBetween(W.unboundedPreceding, -1)
    before = lengths.select("_length", "_bytes", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_before"))
    share = F.pmod(F.xxhash64("qid", "pid", "ord"), F.lit(1 << 20)) / (1 << 20)
    at = F.floor((F.col("_before") + share * F.col("_bytes")) / total * parts)
    # One row per length that occurs.
    placed = sized.join(F.broadcast(before), "_length", "left")
    placed = placed.withColumn("_part", F.coalesce(F.least(at, F.lit(parts - 1)), F.lit(0)).cast("int"))
    ranged = placed.repartitionById(parts, "_part").sortWithinPartitions("_length")
    return ranged.drop("_length", "_bytes", "_before", "_part")


def score_pairs(
    pairs: DataFrame, load_scorer: Callable[[], Scorer], batch_size: int = 64, even: bool = False
) -> DataFrame:
    """Score text pairs with a caller's model, loaded once per task.

    The scorer takes up to ``batch_size`` queries and passages and returns their scores; with
    ``even`` they are of about one length. Stage the result before ranking when the model is
    costly, or keep all scores with ``score_kept``.
    """
    pairs = by_length(pairs) if even else pairs
    kept = [f for f in pairs.schema.fields if f.name not in ("query", "passage")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])
    names = [f.name for f in kept]

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load_scorer()
        for frame in frames:
            scores: list[float] = []
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                scores.extend(float(s) for s in scorer(part["query"].tolist(), part["passage"].tolist()))
            yield frame[names].assign(score=scores)

    return pairs.mapInPandas(score, schema)


def score_kept(
    pairs: DataFrame, load_scorer: Callable[[], Scorer], store: str, model: str, batch_size: int = 64, rounds: int = 8
) -> DataFrame:
    """``score_pairs`` that keeps every score in the table ``store`` and asks the model only for what is not there.

    Scores are kept by a digest of the model's name and both texts, so equal texts are scored
    once, and a later run over other candidates uses them too. Missing ones are scored in
    ``rounds``, each added to the table when it is done: a job that dies loses one round.
    """
    spark = pairs.sparkSession
    names = F.to_json(F.struct(F.lit(model).alias("m"), F.col("query").alias("q"), F.col("passage").alias("p")))
    numbered = pairs.withColumns({"digest": F.unhex(F.sha2(names, 256)), "_row": F.monotonically_increasing_id()})
    marked = stage(numbered, "marked")
    kept = None
    if exists(spark, store):
        kept = spark.read.schema("digest binary, score double").parquet(store).dropDuplicates(["digest"])
    # Of equal texts one row is chosen on digests alone; the hint keeps the texts from being sorted to meet it.
    chosen = marked.groupBy("digest").agg(F.min("_row").alias("_row"))
    chosen = (chosen if kept is None else chosen.join(kept, "digest", "left_anti")).select("_row")
    texts = marked.select("_row", "digest", "query", "passage").join(chosen.hint("shuffle_hash"), "_row", "left_semi")
    missing = stage(texts.drop("_row"), "missing")
    if kept is None or not missing.isEmpty():
        turn = F.pmod(F.xxhash64("digest"), F.lit(rounds))
        for n in range(rounds):
            part = missing.filter(turn == n)
            score_pairs(part, load_scorer, batch_size).select("digest", "score").write.mode("append").parquet(store)
    kept = spark.read.schema("digest binary, score double").parquet(store).dropDuplicates(["digest"])
    return marked.drop("query", "passage", "_row").join(kept, "digest").drop("digest")


def query_terms(queries: DataFrame, keys: Sequence[str] = ("qid",)) -> DataFrame:
    """Distinct terms per query."""
    return queries.select(*keys, F.explode(F.array_distinct(terms("text"))).alias("term"))


def _counted(passages: DataFrame) -> DataFrame:
    """``(pid, dl, terms, tfs)``: a passage's distinct terms, sorted, and their counts, made inside the row."""
    split = passages.select("pid", terms("text").alias("all")).select("pid", F.size("all").alias("dl"), "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, COUNTED_ROWS):
                batch = whole.slice(at, COUNTED_ROWS)
                lists = batch.column("all")
                named = lists.flatten().dictionary_encode()
                order = pc.sort_indices(named.dictionary).to_numpy()
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                key, tf = np.unique(row * max(len(order), 1) + place[named.indices.to_numpy()], return_counts=True)
                row, term = np.divmod(key, max(len(order), 1))
                offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
                held = pa.ListArray.from_arrays(offsets, named.dictionary.take(pa.array(order[term])))
                tfs = pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))
                yield pa.record_batch([batch.column("pid"), batch.column("dl"), held, tfs], ["pid", "dl", "terms", "tfs"])

    pid = passages.schema["pid"].dataType.simpleString()
    return split.mapInArrow(run, f"pid {pid}, dl int, terms array<string>, tfs array<int>")


def _entries(bags: DataFrame) -> DataFrame:
    """``(pid, dl, term, tf)`` of passages with their terms and counts as arrays."""
    rows = bags.select("pid", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    return rows.select("pid", "dl", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))


def term_counts(passages: DataFrame) -> DataFrame:
    """``(pid, dl, term, tf)`` without a shuffle."""
    return _entries(_counted(passages))


def term_number(term: Column | str, seed: int = 0) -> Column:
    """A 64-bit number for a term, which takes less room than the term."""
    return F.xxhash64(F.lit(seed), F.col(term) if isinstance(term, str) else term)


def _numbered(bags: DataFrame, seed: int) -> DataFrame:
    """``_entries`` with numbers for terms, made on reading: stored, they would take more room than the terms."""
    return _entries(bags).withColumn("term", term_number("term", seed))


@dataclass(frozen=True)
class Collection:
    """A passage collection as term counts, with its size and mean length in terms; ``total``, its length, once it is counted.

    A stored collection is a forward index, ``bags``; ``counts`` names terms by number then, by ``seed``, and
    ``vocabulary`` holds ``(term, id, df)``. Otherwise terms name themselves and their frequencies
    are counted when they are asked for.
    """

    counts: DataFrame
    lengths: DataFrame
    size: Column
    mean_length: Column
    vocabulary: DataFrame | None = None
    total: int | None = None
    bags: DataFrame | None = None
    seed: int = 0

    @staticmethod
    def of(passages: DataFrame | Collection) -> Collection:
        """Lazy: every job on it reads and splits the text again."""
        if isinstance(passages, Collection):
            return passages
        lengths = passages.select("pid", F.size(terms("text")).alias("dl"))
        size, mean = lengths.agg(F.count("*")).scalar(), lengths.agg(F.avg("dl")).scalar()
        return Collection(term_counts(passages), lengths, size, mean)

    @staticmethod
    def staged(passages: DataFrame, seeds: int = 8) -> Collection:
        """Forward index and vocabulary written once to the shared folder, for several jobs on one collection.

        Terms are told apart by their numbers from then on, so a seed is looked for that gives each its own.
        """
        bags = stage(_counted(passages), "bags")
        for seed in range(seeds):
            frequencies = bags.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
            vocabulary = stage(frequencies.withColumn("id", term_number("term", seed)), "vocabulary")
            with released(passages.sparkSession):
                told_apart = vocabulary.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
            if told_apart:
                break
        else:
            raise RuntimeError("no seed tells all terms apart")
        size, total = bags.agg(F.count("*"), F.sum("dl")).first()
        counts = _numbered(bags, seed)
        mean = (total or 0) / size if size else 0.0
        return Collection(counts, bags.select("pid", "dl"), F.lit(size), F.lit(mean), vocabulary, total or 0, bags, seed)

    def counted(self) -> Collection:
        """With size and length as numbers, by a job that reads an unstored collection once; later jobs don't count it then."""
        if self.total is not None:
            return self
        size, mean, total = self.lengths.agg(F.count("*"), F.avg("dl"), F.sum("dl")).first()
        return replace(self, size=F.lit(size), mean_length=F.lit(mean).cast("double"), total=total or 0)

    def counts_of(self, pids: DataFrame) -> DataFrame:
        """``counts`` of some passages; of a stored collection they are chosen while they are one row each."""
        if self.bags is None:
            return self.counts.join(pids, "pid", "left_semi")
        return _numbered(self.bags.join(pids, "pid", "left_semi"), self.seed)

    @property
    def cells(self) -> int | Column:
        """How many cells ``retrieve`` cuts it into; a number where it is counted."""
        return cell_count_later(self.size, self.mean_length) if self.total is None else cell_count(self.total)

    def wanted(self, asked: DataFrame) -> DataFrame:
        """Query terms as ``counts`` names them; with ``df`` where that is known."""
        if self.vocabulary is None:
            return asked
        return asked.join(self.vocabulary, "term").withColumn("term", F.col("id")).drop("id")

    def frequencies(self, terms_: DataFrame) -> DataFrame:
        """``(term, df)`` of the distinct ``terms_`` that the collection holds."""
        if self.vocabulary is not None:
            return self.vocabulary.join(terms_, "term", "left_semi").select("term", "df")
        return self.counts.select("term").join(terms_, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))

    def weights(self, asked: DataFrame) -> DataFrame:
        """The query terms that the collection holds, as ``counts`` names them, with their ``idf``."""
        found = self.wanted(asked)
        if self.vocabulary is None:
            found = found.join(self.frequencies(asked.select("term").distinct()), "term")
        return found.withColumn("idf", inverse_frequency(F.col("df"), self.size)).drop("df")


def filtered_counts(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Term counts for the terms of the vocabulary."""
    return counts.join(vocabulary, "term", "left_semi").select("pid", "dl", "term", "tf")


def inverse_frequency(df: Column, size: Column) -> Column:
    return F.log(1 + (size - df + 0.5) / (df + 0.5))


def part(mean_length: Column, k1: float, b: float) -> Column:
    """A posting's BM25 contribution without the weight of its term, below k1 + 1."""
    tf = F.col("tf")
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * (F.col("dl") / mean_length)))


def _weighted(wanted: DataFrame, rows: DataFrame, collection: Collection) -> DataFrame:
    """Query terms with their (inverse) document frequency; ``rows`` has one per (pid, term)."""
    idf = inverse_frequency(F.col("df"), collection.size)
    if collection.vocabulary is not None:
        return wanted.withColumn("idf", idf)
    # The rows are distinct already; saying so keeps all their columns wanted, and Spark runs
    # the shuffle that scoring reads once for both.
    frequencies = rows.distinct().groupBy("term").agg(F.count("*").alias("df"))
    return wanted.join(frequencies, "term").withColumn("idf", idf)


def retrieve(
    queries: DataFrame,
    passages: DataFrame | Collection,
    k: int = 1000,
    k1: float = 0.9,
    b: float = 0.4,
    keys: Sequence[str] = ("qid",),
    fanout: int | None = None,
    spare: int | None = None,
) -> DataFrame:
    """Top ``k`` passages per query over the whole collection: ``(qid, pid, rank, score)``.

    Passages are scored cell by cell of the collection, see ``cells``. With large collections, pass one
    that is stored or ``counted``: each cell is a task of its own then. ``fanout`` merges each query's
    bests of the cells in two steps, for very many cells. ``spare`` lets common terms meet only
    passages that can still be listed. The rows are the same.
    """
    collection = Collection.of(passages)
    wanted = collection.wanted(query_terms(queries, keys))
    postings = filtered_counts(collection.counts, wanted.select("term").distinct())
    if collection.vocabulary is None:
        # Weights and cells both read what is dealt here.
        cells = collection.cells
        postings = postings.repartition(PARTS_PER_CELL * cells, "pid") if isinstance(cells, int) else postings.repartition("pid")
    weights = _weighted(wanted, postings, collection)
    return _best(postings, weights, collection, k, k1, b, keys, fanout, spare)


def _best(
    postings: DataFrame,
    weights: DataFrame,
    collection: Collection,
    k: int,
    k1: float,
    b: float,
    keys: Sequence[str],
    fanout: int | None = None,
    spare: int | None = None,
) -> DataFrame:
    parts = postings.select("pid", "term", part(collection.mean_length, k1, b).alias("part"))
    asked = weights.select(*keys, "term", F.col("idf").alias("weight"))
    scored = best_by_cell(parts, asked, collection.cells, keys, k, spare)
    top = top_within(scored, keys, [("score", False), ("pid", True)], k, fanout=fanout)
    return top.select(*keys, "pid", "rank", "score")


def _shared(k1: float) -> Column:
    """(score, shared) of a row with a query's ``terms`` and ``idfs``, a passage's ``groups`` and its length's ``norm``."""
    hits = F.transform("groups", lambda g: F.struct(g["tf"].alias("tf"), F.array_intersect(g["terms"], F.col("terms")).alias("both")))

    def add(so_far: Column, hit: Column) -> Column:
        idf = lambda total, t: total + F.get("idfs", F.array_position("terms", t).cast("int") - 1)
        tf, weight = hit["tf"], F.aggregate(hit["both"], F.lit(0.0), idf)
        return F.struct(
            (so_far["score"] + weight * tf * (k1 + 1) / (tf + F.col("norm"))).alias("score"),
            (so_far["shared"] + F.size(hit["both"])).alias("shared"),
        )

    return F.aggregate(hits, F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("shared")), add)


def asked_bags(collection: Collection, vocabulary: DataFrame, pids: DataFrame) -> DataFrame:
    """``(pid, dl, groups)``: of each passage the terms that are asked for, by count, one row per passage.

    Passages come without what no query asks for, however long they are, and groups by count let
    a pair find what it shares as sets.
    """
    held = filtered_counts(collection.counts_of(pids), vocabulary).repartition("pid")
    by_count = held.groupBy("pid", "dl", "tf").agg(F.collect_list("term").alias("terms"))
    return by_count.groupBy("pid", "dl").agg(F.collect_list(F.struct("tf", "terms")).alias("groups"))


def _scored_pairs(
    pairs: DataFrame, queries: DataFrame, collection: Collection, k1: float, b: float, keys: Sequence[str]
) -> DataFrame:
    """``(keys, pid, score, shared)``: BM25 and the number of shared terms per pair.

    A pair takes on its query's weights, as two arrays, and meets its passage's row.
    """
    pairs = pairs.select(*keys, "pid").distinct()
    # Only the queries and the terms that the pairs ask for.
    weights = collection.weights(query_terms(queries.join(pairs.select(*keys).distinct(), list(keys), "left_semi"), keys))
    asked = weights.groupBy(*keys).agg(F.collect_list(F.struct("term", "idf")).alias("w"))
    asked = asked.select(*keys, F.col("w.term").alias("terms"), F.col("w.idf").alias("idfs"))
    bags = asked_bags(collection, weights.select("term").distinct(), pairs.select("pid").distinct())
    met = pairs.join(asked, list(keys), "left").join(bags, "pid", "left")
    met = met.withColumn("norm", k1 * (1 - b + b * (F.col("dl") / collection.mean_length)))
    found = F.when(F.col("terms").isNotNull() & F.col("groups").isNotNull(), _shared(k1)).alias("found")
    return met.select(*keys, "pid", found).select(
        *keys,
        "pid",
        F.round(F.coalesce("found.score", F.lit(0.0)), LEXICAL_PLACES).alias("score"),
        F.coalesce("found.shared", F.lit(0)).cast("bigint").alias("shared"),
    )


def score_bm25(
    pairs: DataFrame,
    queries: DataFrame,
    passages: DataFrame | Collection,
    k1: float = 0.9,
    b: float = 0.4,
    keys: Sequence[str] = ("qid",),
) -> DataFrame:
    """BM25 of given pairs ``(qid, pid)``, one row each; term weights from all passages."""
    return _scored_pairs(pairs, queries, Collection.of(passages), k1, b, keys).drop("shared")


def rank_features(
    pairs: DataFrame, queries: DataFrame, passages: DataFrame | Collection, k1: float = 0.9, b: float = 0.4
) -> DataFrame:
    """Lexical features per pair: BM25, shared terms, query terms, passage length.

    A passage without any term has length 0.
    """
    collection = Collection.of(passages)
    scored = _scored_pairs(pairs, queries, collection, k1, b, ["qid"]).withColumnRenamed("score", "bm25")
    asked = queries.select("qid", F.size(F.array_distinct(terms("text"))).cast("bigint").alias("query_terms"))
    lengths = collection.lengths.select("pid", F.col("dl").cast("bigint").alias("length"))
    return (
        scored.join(asked, "qid")
        .join(lengths, "pid", "left")
        .select("qid", "pid", "bm25", "shared", "query_terms", F.coalesce("length", F.lit(0)).alias("length"))
    )


def retrieve_weighted(asked: DataFrame, collection: Collection, k: int = 1000, k1: float = 0.9, b: float = 0.4) -> DataFrame:
    """Top ``k`` passages for weighted query terms ``(qid, term, weight)``; with weights of 1 those of ``retrieve``."""
    weights = collection.weights(asked.filter("weight > 0")).withColumn("idf", F.col("idf") * F.col("weight"))
    postings = filtered_counts(collection.counts, weights.select("term").distinct())
    return _best(postings, weights, collection, k, k1, b, ["qid"])
