"""Training and dev samples from ordered id triples ``(ord, qid, pos_id, neg_id)``.

Ids are settled first; text is joined last, once, for the ids that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.numbering import number_blocks, rank_within, top_within
from rankflow.session import stage

BLOCK_ROWS = 50_000


def select_dev_queries(triples: DataFrame, n: int = 200) -> DataFrame:
    """The first ``n`` distinct queries by first appearance."""
    first = triples.groupBy("qid").agg(F.min("ord").alias("ord"))
    return first.orderBy("ord").limit(n).select("qid")


def dev_positives(triples: DataFrame, dev: DataFrame) -> DataFrame:
    """All distinct positives of the dev queries, over all their lines."""
    return triples.join(dev, "qid", "left_semi").select("qid", F.col("pos_id").alias("pid")).distinct()


def dev_negatives(triples: DataFrame, dev: DataFrame, cap: int = 200) -> DataFrame:
    """The first ``cap`` distinct negatives of each dev query in input order."""
    first = (
        triples.join(dev, "qid", "left_semi")
        .groupBy("qid", F.col("neg_id").alias("pid"))
        .agg(F.min("ord").alias("ord"))
    )
    return top_within(first, ["qid"], [("ord", True), ("pid", True)], cap).select("qid", "pid")


def dev_samples(triples: DataFrame, n: int = 200, cap: int = 200) -> DataFrame:
    """Dev set in long form ``(qid, pid, is_pos)``; an id may appear on both sides."""
    dev = select_dev_queries(triples, n)
    positives = dev_positives(triples, dev).withColumn("is_pos", F.lit(True))
    negatives = dev_negatives(triples, dev, cap).withColumn("is_pos", F.lit(False))
    return positives.unionByName(negatives)


def exclude_dev(triples: DataFrame, dev: DataFrame) -> DataFrame:
    return triples.join(dev, "qid", "left_anti")


def label_triples(triples: DataFrame, ratio: int = 4, block_rows: int = 1 << 20) -> DataFrame:
    """One labelled id per line: of each ``ratio + 1`` lines the first gives its positive.

    ``n`` is the line's position among the given rows. Rows are numbered inside blocks of
    ``block_rows`` consecutive ``ord`` values, so a block is bounded whatever the keys.
    """
    blocked = triples.withColumn("_block", F.floor(F.col("ord") / block_rows))
    numbered = number_blocks(blocked, [], "_block", [("ord", True)], "_at").withColumn("n", F.col("_at") - 1)
    positive = F.col("n") % (ratio + 1) == 0
    return numbered.select(
        "n",
        "ord",
        "qid",
        F.when(positive, F.col("pos_id")).otherwise(F.col("neg_id")).alias("pid"),
        positive.cast("int").alias("label"),
    )


def cap_samples(labelled: DataFrame, m: int) -> DataFrame:
    """The first ``m`` labelled rows in input order."""
    return labelled.filter(F.col("n") < m)


def training_samples(
    triples: DataFrame, dev: DataFrame, ratio: int = 4, m: int | None = None, block_rows: int = 1 << 20
) -> DataFrame:
    """Labelled training ids ``(n, ord, qid, pid, label)`` outside the dev queries."""
    labelled = label_triples(exclude_dev(triples, dev), ratio, block_rows)
    return labelled if m is None else cap_samples(labelled, m)


def needed_passages(dev: DataFrame, samples: DataFrame) -> DataFrame:
    """Distinct passage ids used by the dev set or the training samples."""
    return dev.select("pid").unionByName(samples.select("pid")).distinct()


def subset_passages(passages: DataFrame, needed: DataFrame | None) -> DataFrame:
    """The needed part of the collection, or all of it."""
    return passages if needed is None else passages.join(needed, "pid", "left_semi")


def require_min_rows(df: DataFrame, n: int) -> DataFrame:
    """Fail when ``df`` holds fewer than ``n`` rows; each task counts its own."""
    found = df.count()
    if found < n:
        raise ValueError(f"incomplete input: {found} rows, expected at least {n}")
    return df


def missing_passages(needed: DataFrame, passages: DataFrame) -> DataFrame:
    """Needed ids that the collection does not hold."""
    return needed.join(passages.select("pid"), "pid", "left_anti")


def materialize_samples(samples: DataFrame, queries: DataFrame, passages: DataFrame) -> DataFrame:
    """Texts for labelled ids; rows lacking either text drop out, labels unchanged."""
    return (
        samples.join(queries.select("qid", F.col("text").alias("query")), "qid")
        .join(passages.select("pid", F.col("text").alias("passage")), "pid")
        .select("n", "qid", "pid", "query", "passage", "label")
    )


def materialize_dev(dev: DataFrame, queries: DataFrame, passages: DataFrame) -> DataFrame:
    """Dev texts in long form; missing passages drop out, a missing query is an error."""
    known = queries.select("qid", F.col("text").alias("_query"))
    message = F.concat(F.lit("dev query without text: "), F.col("qid").cast("string"))
    return (
        dev.join(known, "qid", "left")
        .withColumn("query", F.when(F.col("_query").isNotNull(), F.col("_query")).otherwise(F.raise_error(message)))
        .join(passages.select("pid", F.col("text").alias("passage")), "pid")
        .select("qid", "pid", "query", "passage", "is_pos")
    )


def nest_dev(dev: DataFrame, items: int = 1000) -> DataFrame:
    """``(qid, part, query, positive[], negative[])`` for evaluators that want lists.

    A query's rows are cut into parts of ``items`` rows by passage id, so that no list
    outgrows that and none is lost; most queries are one part, number 0.
    """
    ranked = rank_within(dev, ["qid"], [("pid", True), ("is_pos", True)], identity=["pid", "is_pos"], out="_at")
    return (
        ranked.withColumn("part", F.floor((F.col("_at") - 1) / items))
        .groupBy("qid", "part", "query")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("is_pos"), F.col("passage")))).alias("positive"),
            F.array_sort(F.collect_list(F.when(~F.col("is_pos"), F.col("passage")))).alias("negative"),
        )
    )


def block_digits(rows: int) -> int:
    """Leading hex digits that cut ``rows`` into even blocks of ``BLOCK_ROWS`` at most."""
    digits = 1
    while rows >> (4 * digits) > BLOCK_ROWS:
        digits += 1
    return digits


def assign_batches(df: DataFrame, key: str, size: int = 32, seed: int = 0, rows: int = 1 << 32) -> DataFrame:
    """Reproducible shuffle of the rows into batches of ``size`` (the last may be short).

    Rows are ordered by a seeded digest of their unique ``key``, whose first hex digits name
    the block. ``rows`` is about how many there are and sets the number of blocks, not
    the order.
    """
    prefix = block_digits(rows)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    mixed = df.withColumn("_digest", digest).withColumn("_block", F.substring("_digest", 1, prefix))
    placed = number_blocks(mixed, [], "_block", [("_digest", True), (key, True)], "_at")
    return placed.withColumn("batch", F.floor((F.col("_at") - 1) / size)).drop("_digest", "_block", "_at")


def _drawn(seed: int, epoch: Column, turn: Column, value: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), turn.cast("string"), value.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def permuted(at: Column, rows: int, seed: int, epoch: Column) -> Column:
    """Where a keyed permutation of 0 to ``rows - 1`` puts a number, without moving any row.

    Numbers are pairs below ``side``, the root of ``rows`` rounded up. Four rounds swap the halves
    and shift one by a digest of the other, which can be undone and so is a permutation. A number
    that lands beyond the rows goes round again; few do, as side squared is little more than rows.
    """
    side = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    turns = F.array(*[F.lit(t) for t in range(4)])

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / side).cast("bigint").alias("l"), (x % side).cast("bigint").alias("r"))

        def swap(pair: Column, turn: Column) -> Column:
            shifted = (pair["l"] + _drawn(seed, epoch, turn, pair["r"])) % side
            return F.struct(pair["r"].alias("l"), shifted.alias("r"))

        return F.aggregate(turns, start, swap, lambda pair: pair["l"] * side + pair["r"])

    beyond = side * side - rows
    again = F.sequence(F.lit(1), F.lit(min(beyond, 64)))
    walked = F.aggregate(again, once(at), lambda x, _: F.when(x < rows, x).otherwise(once(x))) if beyond else once(at)
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a number found no place")).cast("bigint"))


def epoch_batches(df: DataFrame, rows: int, epochs: int, key: str = "n", size: int = 32, seed: int = 0) -> DataFrame:
    """Every row once per epoch with its ``batch`` and ``place`` in it, in an order drawn anew per epoch.

    ``key`` numbers the rows from 0 to ``rows - 1``. Rows neither move nor are sorted for it.
    """
    turns = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) if epochs else df.withColumn("epoch", F.lit(0)).limit(0)
    placed = turns.withColumn("_at", permuted(F.col(key).cast("bigint"), rows, seed, F.col("epoch")))
    return placed.withColumns({"batch": F.floor(F.col("_at") / size).cast("bigint"), "place": F.col("_at") % size}).drop("_at")


def materialize_counted(samples: DataFrame, queries: DataFrame, passages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``materialize_samples`` as a stored table, and the summary of ``sample_summary`` without its joins.

    What was loaded is counted on the stored labels alone; the rows left out are the rest of the samples.
    """
    made = stage(materialize_samples(samples, queries, passages), "samples")
    total = samples.agg(F.count("*")).scalar()
    label = F.col("label")
    summary = made.agg(
        F.count("*").alias("loaded"), F.count_if(label == 1).alias("positives"), F.count_if(label == 0).alias("negatives")
    )
    return made, summary.withColumn("dropped", total - F.col("loaded"))


def sample_summary(samples: DataFrame, queries: DataFrame, passages: DataFrame) -> DataFrame:
    """Counts of loaded, positive, negative and dropped training rows."""
    resolved = samples.join(queries.select("qid", F.lit(True).alias("_q")), "qid", "left").join(
        passages.select("pid", F.lit(True).alias("_p")), "pid", "left"
    )
    kept = F.col("_q").isNotNull() & F.col("_p").isNotNull()
    return resolved.agg(
        F.count_if(kept).alias("loaded"),
        F.count_if(kept & (F.col("label") == 1)).alias("positives"),
        F.count_if(kept & (F.col("label") == 0)).alias("negatives"),
        F.count_if(~kept).alias("dropped"),
    )
