import math

import pytest

from rankflow.functions.scores import as_percent
from rankflow.operators import metrics
from rankflow.operators.ranking import judged_queries, rank_run

RUN = "run string, qid string, pid string, score double"
QRELS = "qid string, pid string, rel int"


def reference_metrics(run, qrels, ndcg=10, recall=100, ap=1000, min_rel=1, descending=False):
    """Metric definitions applied one query at a time."""
    out = {}
    for (name, qid), scores in run.items():
        if qid not in qrels:
            continue
        judged = qrels[qid]
        order = sorted(scores, reverse=descending)
        order.sort(key=lambda p: -scores[p])
        gains = [max(judged.get(p, 0), 0) for p in order]
        ideal = sorted((max(r, 0) for r in judged.values()), reverse=True)

        def dcg(values):
            return sum(g / math.log2(i + 2) for i, g in enumerate(values[:ndcg]))

        hits = [judged.get(p, 0) >= min_rel for p in order]
        total = sum(r >= min_rel for r in judged.values())
        precisions = [sum(hits[: i + 1]) / (i + 1) for i, hit in enumerate(hits[:ap]) if hit]
        out[name, qid] = (
            dcg(gains) / dcg(ideal) if dcg(ideal) else 0.0,
            sum(hits[:recall]) / total if total else 0.0,
            sum(precisions) / total if total else 0.0,
        )
    return out


def random_data(rng, queries=12, depth=40):
    run, qrels = {}, {}
    for name in ("a", "b"):
        for q in range(queries):
            pids = rng.sample([f"p{i}" for i in range(60)], rng.randint(1, depth))
            run[name, f"q{q}"] = {p: float(rng.randint(0, 6)) for p in pids}
    for q in range(2, queries + 2):
        pids = rng.sample([f"p{i}" for i in range(60)], rng.randint(1, 20))
        qrels[f"q{q}"] = {p: rng.choice([-1, 0, 0, 1, 2, 3]) for p in pids}
    qrels["q3"] = {"p1": 0, "p2": 0}
    return run, qrels


def frames(spark, run, qrels):
    return (
        spark.createDataFrame([(n, q, p, s) for (n, q), d in run.items() for p, s in d.items()], RUN),
        spark.createDataFrame([(q, p, r) for q, d in qrels.items() for p, r in d.items()], QRELS),
    )


@pytest.mark.parametrize("settings", [(10, 100, 1000, 1, "pid"), (3, 5, 7, 1, "pid"), (5, 4, 9, 2, "trec")])
def test_metrics_equal_sequential_definitions(spark, rng, settings):
    ndcg, recall, ap, min_rel, ties = settings
    run, qrels = random_data(rng)
    names = [f"ndcg@{ndcg}", f"recall@{recall}", f"map@{ap}"]
    got = metrics.evaluate_queries(*frames(spark, run, qrels), names, ties=ties, min_rel=min_rel).collect()
    want = reference_metrics(run, qrels, ndcg, recall, ap, min_rel, descending=ties == "trec")
    assert {(r.run, r.qid) for r in got} == set(want)
    for r in got:
        assert [r[n] for n in names] == pytest.approx(want[r.run, r.qid], abs=1e-12)
        assert all(0 <= r[n] <= 1 for n in names)


def test_ideal_run_scores_one(spark, rng):
    _, qrels = random_data(rng)
    run = {("ideal", q): {p: float(r) for p, r in d.items()} for q, d in qrels.items()}
    got = metrics.evaluate_queries(*frames(spark, run, qrels)).collect()
    for r in got:
        assert r["ndcg@10"] == pytest.approx(0.0 if max(qrels[r.qid].values()) <= 0 else 1.0)


def test_query_policies(spark):
    run = {("a", "q1"): {"p1": 2.0, "p2": 1.0}, ("a", "q2"): {"p1": 1.0}, ("a", "unjudged"): {"p": 1.0}}
    qrels = {"q1": {"p1": 1}, "q2": {"p9": 1}, "q3": {"p1": 1}}
    data = frames(spark, run, qrels)
    both = metrics.evaluate(*data).first()
    assert (both["queries"], both["ndcg@10"]) == (2, 0.5)
    every = metrics.evaluate(*data, queries="qrels").first()
    assert (every["queries"], every["ndcg@10"]) == (3, pytest.approx(1 / 3))
    with pytest.raises(Exception, match="differ: a"):
        metrics.evaluate(*data, queries="strict").collect()
    same = frames(spark, {("a", "q1"): {"p1": 1.0}}, {"q1": {"p1": 1}})
    assert metrics.evaluate(*same, queries="strict").first()["map@1000"] == 1.0
    with pytest.raises(ValueError):
        metrics.evaluate(*data, queries="some")
    with pytest.raises(ValueError):
        metrics.evaluate(*data, metrics=["gain@10"])


def test_single_metric_helpers_and_percent(spark):
    data = frames(spark, {("a", "q"): {"p1": 1.0, "p2": 2.0, "p3": 3.0}}, {"q": {"p1": 1, "p3": 1}})
    assert metrics.recall(*data, k=2).first()["recall@2"] == 0.5
    assert metrics.average_precision(*data).first()["map@1000"] == pytest.approx((1 + 2 / 3) / 2)
    assert metrics.ndcg(*data, k=1).first()["ndcg@1"] == 1.0
    assert as_percent(metrics.evaluate(*data, metrics=["map@10"])).first()["map@10"] == 83.33


def test_ranking_ties_duplicates_and_bad_scores(spark, rows):
    scored = spark.createDataFrame(
        [(0, "q", "b", 1.0), (1, "q", "a", 1.0), (2, "q", "c", 5.0), (3, "q", "b", 1.0), (4, "q", "c", 0.0)],
        "ord long, qid string, pid string, score double",
    )
    assert rows(rank_run(scored), "rank", "pid") == [(1, "b"), (2, "a"), (3, "c")]
    assert rows(rank_run(scored, ties="pid"), "rank", "pid") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(rank_run(scored, ties="trec"), "rank", "pid") == [(1, "b"), (2, "a"), (3, "c")]
    assert rows(rank_run(scored, depth=1), "rank", "pid") == [(1, "b")]
    with pytest.raises(Exception, match="not a number"):
        rank_run(spark.createDataFrame([(0, "q", "a", float("nan"))], scored.schema)).collect()


def test_judged_queries_need_a_positive_grade(spark, rows):
    queries = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "qid string, text string")
    qrels = spark.createDataFrame([("1", "p", 0), ("2", "p", 1), ("2", "r", 2)], QRELS)
    assert rows(judged_queries(queries, qrels), "qid") == [("2",)]


def test_reranking_mrr_skips_one_sided_queries(spark):
    dev = [
        ("q1", "a", True, 1.0), ("q1", "b", False, 2.0),  # first positive at rank 2
        ("q2", "a", True, 5.0), ("q2", "b", False, 5.0),  # tie: the negative goes first
        ("q3", "a", True, 9.0),  # no negatives: left out
        ("q4", "a", True, 0.0), *[("q4", f"n{i}", False, 1.0) for i in range(10)],  # beyond 10
    ]
    frame = spark.createDataFrame(dev, "qid string, pid string, is_pos boolean, score double")
    got = metrics.reranking_mrr(frame).first()
    assert (got["queries"], got["mrr@10"]) == (3, pytest.approx((0.5 + 0.5 + 0) / 3))
