"""Retrieval metrics for many runs at once.

Metric names are ``ndcg@k``, ``recall@k``, ``map@k`` and ``mrr@k``. Runs are re-ranked by
score; the given rank column is not read. One pass serves all metrics: the top rows per
(run, query) meet the judgements once, and only hits go on to the per-query sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.numbering import top_within
from rankflow.operators.ranking import run_order, sortable

DEFAULT_METRICS = ("ndcg@10", "recall@100", "map@1000")


def parse_metric(name: str) -> tuple[str, int]:
    kind, _, k = name.partition("@")
    if kind not in ("ndcg", "recall", "map", "mrr") or not k.isdigit() or int(k) < 1:
        raise ValueError(f"unknown metric {name!r}")
    return kind, int(k)


def _discount(first: Column, last: Column) -> Column:
    """Sum of 1 / log2(i + 1) for first <= i <= last, 0 when the span is empty."""
    steps = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + 1))


def ideal_table(qrels: DataFrame, ndcg_depths: Sequence[int], min_rel: int = 1) -> DataFrame:
    """Per judged query: relevant count ``n_rel`` and ideal gain ``idcg@k``.

    Judgements are first counted per (query, grade); the ideal order runs through the grades
    of a query, best first, each filling a span of ranks. The k best ranks touch at most
    k grades, so no more are listed.
    """
    grades = qrels.groupBy("qid", "rel").agg(F.count("*").alias("n"))
    grade_list = F.sort_array(F.collect_list(F.struct("rel", "n")), asc=False)
    best = top_within(grades, ["qid"], [("rel", False)], max(ndcg_depths, default=1))
    relevant = grades.groupBy("qid").agg(F.sum(F.when(F.col("rel") >= min_rel, F.col("n")).otherwise(0)).alias("n_rel"))
    per_query = best.groupBy("qid").agg(grade_list.alias("_grades")).join(relevant, "qid")

    def ideal(k: int) -> Column:
        def add(acc: Column, g: Column) -> Column:
            seen, rel = acc.getField("seen"), g.getField("rel")
            until = F.least(seen + g.getField("n"), F.lit(k).cast("bigint"))
            gain = F.when(rel > 0, rel * _discount(seen + 1, until)).otherwise(0.0)
            return F.struct(until.alias("seen"), (acc.getField("gain") + gain).alias("gain"))

        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0.0).alias("gain"))
        return F.aggregate("_grades", start, add, lambda acc: acc.getField("gain"))

    return per_query.select("qid", "n_rel", *[ideal(k).alias(f"idcg@{k}") for k in ndcg_depths])


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def evaluate_queries(
    runs: DataFrame,
    qrels: DataFrame,
    metrics: Sequence[str] = DEFAULT_METRICS,
    ties: str = "pid",
    min_rel: int = 1,
) -> DataFrame:
    """``(run, qid, <metrics>)`` for the queries found in both the run and the judgements."""
    parsed = {name: parse_metric(name) for name in metrics}
    depth = max(k for _, k in parsed.values())
    columns = ["run", "qid", "pid", "score", *(["ord"] if ties == "ord" else [])]
    top = top_within(sortable(runs.select(*columns), ties), ["run", "qid"], run_order(ties), depth)
    if ties == "trec":
        qrels = qrels.withColumn("pid", F.col("pid").cast("string"))

    rank, rel = F.col("rank"), F.col("rel")
    relevant = rel >= min_rel
    # The first row stays even when it is no hit, so that a query without hits scores 0.
    judged = top.join(qrels, ["qid", "pid"], "left").filter((rel >= min(1, min_rel)) | (rank == 1))
    sums: dict[str, Column] = {}
    for kind, k in parsed.values():
        if kind == "ndcg":
            gain = F.when((rank <= k) & (rel > 0), rel / F.log2(rank + 1)).otherwise(0.0)
            sums[f"_dcg@{k}"] = F.sum(gain)
        elif kind == "recall":
            sums[f"_found@{k}"] = F.count_if(relevant & (rank <= k))
        else:  # ranks of the relevant rows, at most k of them
            sums[f"_hits@{k}"] = F.sort_array(F.collect_list(F.when(relevant & (rank <= k), rank)))
    per_query = judged.groupBy("run", "qid").agg(*[c.alias(name) for name, c in sums.items()])
    ideals = ideal_table(qrels, sorted({k for kind, k in parsed.values() if kind == "ndcg"}), min_rel)

    def value(kind: str, k: int) -> Column:
        if kind == "ndcg":
            return _ratio(F.col(f"_dcg@{k}"), F.col(f"idcg@{k}"))
        if kind == "recall":
            return _ratio(F.col(f"_found@{k}"), F.col("n_rel"))
        hits = F.col(f"_hits@{k}")
        if kind == "map":
            precisions = F.transform(hits, lambda r, i: (i + 1) / r)
            return _ratio(F.aggregate(precisions, F.lit(0.0), lambda acc, p: acc + p), F.col("n_rel"))
        return F.coalesce(1 / F.get(hits, F.lit(0)), F.lit(0.0))

    return per_query.join(ideals, "qid").select(
        "run", "qid", *[value(kind, k).alias(name) for name, (kind, k) in parsed.items()]
    )


def evaluate(
    runs: DataFrame,
    qrels: DataFrame,
    metrics: Sequence[str] = DEFAULT_METRICS,
    queries: str = "both",
    ties: str = "pid",
    min_rel: int = 1,
) -> DataFrame:
    """Macro means per run as ``(system, queries, <metrics>)``.

    ``queries`` says which queries count: those in ``both`` run and judgements, all of the
    ``qrels`` (one missing from a run scores 0), or both after a ``strict`` check that the
    two sets are the same.
    """
    if queries not in ("both", "qrels", "strict"):
        raise ValueError(f"unknown query policy {queries!r}")
    scores = evaluate_queries(runs, qrels, metrics, ties, min_rel)
    matched = F.count("*").alias("queries")
    if queries == "both":
        return scores.groupBy(F.col("run").alias("system")).agg(matched, *[F.avg(m).alias(m) for m in metrics])

    judged = qrels.agg(F.count_distinct("qid").alias("n")).scalar()
    sums = scores.groupBy(F.col("run").alias("system")).agg(matched, *[F.sum(m).alias(m) for m in metrics])
    if queries == "qrels":  # a run without any judged query scores 0 as well
        every = runs.select(F.col("run").alias("system")).distinct()
        sums = every.join(sums, "system", "left").fillna(0.0, list(metrics))
    if queries == "strict":
        ranked = runs.groupBy(F.col("run").alias("system")).agg(F.count_distinct("qid").alias("_ranked"))
        same = (F.col("queries") == judged) & (F.col("_ranked") == judged)
        message = F.concat(F.lit("queries of run and judgements differ: "), F.col("system"))
        sums = sums.join(ranked, "system", "right").withColumn(
            "queries", F.when(same, F.col("queries")).otherwise(F.raise_error(message))
        )
        return sums.select("system", "queries", *[(F.col(m) / F.col("queries")).alias(m) for m in metrics])
    return sums.select("system", judged.alias("queries"), *[(F.col(m) / judged).alias(m) for m in metrics])


def ndcg(runs: DataFrame, qrels: DataFrame, k: int = 10, ties: str = "pid") -> DataFrame:
    return evaluate_queries(runs, qrels, [f"ndcg@{k}"], ties)


def recall(runs: DataFrame, qrels: DataFrame, k: int = 100, min_rel: int = 1, ties: str = "pid") -> DataFrame:
    return evaluate_queries(runs, qrels, [f"recall@{k}"], ties, min_rel)


def average_precision(runs: DataFrame, qrels: DataFrame, k: int = 1000, min_rel: int = 1, ties: str = "pid") -> DataFrame:
    return evaluate_queries(runs, qrels, [f"map@{k}"], ties, min_rel)


def reranking_mrr(scored_dev: DataFrame, k: int = 10, ties: str = "pid") -> DataFrame:
    """Mean reciprocal rank over a scored dev set ``(qid, pid, is_pos, score)``.

    Queries lacking positives or negatives are left out. An id on both sides is two rows;
    between equal scores the negative comes first, so a tie is no merit.
    """
    sides = scored_dev.groupBy("qid").agg(F.max("is_pos").alias("_any"), F.min("is_pos").alias("_all"))
    usable = sides.filter(F.col("_any") & ~F.col("_all")).select("qid")
    order = [("score", False), ("is_pos", True), ("pid", True)]
    top = top_within(sortable(scored_dev, ties), ["qid"], order, k)
    best = top.groupBy("qid").agg(F.min(F.when(F.col("is_pos"), F.col("rank"))).alias("_best"))
    per_query = usable.join(best, "qid").select(F.coalesce(1 / F.col("_best"), F.lit(0.0)).alias("rr"))
    return per_query.agg(F.count("*").alias("queries"), F.avg("rr").alias(f"mrr@{k}"))
