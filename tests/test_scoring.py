import math
import re

import pytest
from pyspark.sql import functions as F

from rankflow.functions.scores import positive_softmax
from rankflow.functions.text import normalize_line, strip, terms, truncate_words
from rankflow.operators import ranker, scoring

WORDS = "ash birch cedar Ébène fir GUM holly ivy juniper larch".split()


def corpus(rng, n=60):
    passages = [(p, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 30)))) for p in range(n)]
    passages += [(n, "..., 12 3!"), (n + 1, passages[0][1])]  # no terms; an exact copy
    queries = [(q, " ".join(rng.sample(WORDS, 3)) + "! " + WORDS[q % 10]) for q in range(6)] + [(6, "unknown")]
    return queries, passages


def split(text):
    return re.findall(r"[^\W\d_]+", text.lower())


def bm25_by_hand(queries, passages, k1=0.9, b=0.4):
    held = {p: split(t) for p, t in passages}
    mean = sum(map(len, held.values())) / len(held)
    scores = {}
    for q, text in queries:
        for p, tokens in held.items():
            total, shared = 0.0, 0
            for term in set(split(text)) & set(tokens):
                df = sum(term in t for t in held.values())
                tf = tokens.count(term)
                idf = math.log(1 + (len(held) - df + 0.5) / (df + 0.5))
                total += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(tokens) / mean))
                shared += 1
            scores[q, p] = (total, shared)
    return scores


def frames(spark, queries, passages):
    return (
        spark.createDataFrame(queries, "qid long, text string"),
        spark.createDataFrame(passages, "pid long, text string"),
    )


@pytest.mark.parametrize(("k", "spare"), [(3, 1), (3, 8), (15, 2), (1, 1)])
def test_bounded_retrieval_gives_the_same_rows(spark, rng, k, spare):
    asked, held = frames(spark, *corpus(rng, 200))
    plain = {tuple(r) for r in scoring.retrieve(asked, held, k=k).collect()}
    assert {tuple(r) for r in scoring.retrieve(asked, held, k=k, spare=spare).collect()} == plain


@pytest.mark.parametrize("staged", [False, True])
def test_retrieval_equals_scoring_every_pair(spark, rng, staged):
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    scores = bm25_by_hand(queries, passages)
    top = scoring.retrieve(asked, scoring.Collection.staged(held) if staged else held, k=15, fanout=2 if staged else None)
    got = {(r.qid, r["rank"]): (r.pid, r.score) for r in top.collect()}
    want = {}
    for q, _ in queries:
        matched = sorted((p for (q2, p), (_, n) in scores.items() if q2 == q and n), key=lambda p: (-round(scores[q, p][0], 9), p))
        want.update({(q, at): (p, pytest.approx(scores[q, p][0], abs=1e-8)) for at, p in enumerate(matched[:15], 1)})
    assert got == want


def test_given_pairs_keep_unmatched_ones(spark, rng):
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    pairs = asked.select("qid").crossJoin(held.select("pid"))  # test data only
    scores = bm25_by_hand(queries, passages, 1.2, 0.75)
    got = {(r.qid, r.pid): r.score for r in scoring.score_bm25(pairs, asked, held, 1.2, 0.75).collect()}
    assert got == pytest.approx({key: s for key, (s, _) in scores.items()}, abs=1e-8)


def test_pair_features(spark, rng):
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    pairs = spark.createDataFrame([(q, p) for q, _ in queries for p, _ in passages[::7] + passages[-2:]], "qid long, pid long")
    scores = bm25_by_hand(queries, passages)
    text_q, text_p = dict(queries), dict(passages)
    for r in scoring.rank_features(pairs, asked, held).collect():
        assert (r.shared, r.query_terms, r.length) == (
            scores[r.qid, r.pid][1], len(set(split(text_q[r.qid]))), len(split(text_p[r.pid])),
        )
        assert r.bm25 == pytest.approx(scores[r.qid, r.pid][0], abs=1e-8)


def test_passage_text_is_not_shuffled(spark, tmp_path):
    """Between the scan and the first exchange, text has become counts of query terms."""
    asked, held = frames(spark, [(1, "fir")], [(i, "fir ash " * 3) for i in range(50)])
    held.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = scoring.retrieve(asked, stored)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(pid" in line]
    assert exchanges and all("text" not in line for line in exchanges)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_term_counts(spark):
    held = spark.createDataFrame([(1, "b a b  B, c"), (2, ""), (3, "a")], "pid long, text string")
    got = {(r.pid, r.term): (r.dl, r.tf) for r in scoring.term_counts(held).collect()}
    assert got == {(1, "a"): (5, 1), (1, "b"): (5, 3), (1, "c"): (5, 1), (3, "a"): (1, 1)}


def test_scorer_is_loaded_per_task_and_called_in_batches(spark):
    pairs = spark.createDataFrame(
        [(i, "q", i, "x" * (i % 5), "y" * i) for i in range(25)], "ord long, qid string, pid long, query string, passage string"
    ).coalesce(1)

    def load():
        sizes = []

        def score(asked, held):
            sizes.append(len(asked))
            assert len(asked) == len(held) <= 8
            return [len(p) * 100 + len(sizes) for p in held]

        return score

    got = sorted((r.pid, r.score) for r in scoring.score_pairs(pairs, load, batch_size=8).collect())
    assert got == [(i, float(i * 100 + i // 8 + 1)) for i in range(25)]


def test_pairs_skip_queries_without_candidates(spark, rows):
    queries = spark.createDataFrame([("1", "a"), ("2", "b")], "qid string, text string")
    candidates = spark.createDataFrame([(0, "1", "p", "t")], "ord long, qid string, pid string, passage string")
    assert rows(scoring.build_pairs(queries, candidates)) == [(0, "1", "p", "a", "t")]


def test_softmax(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), ([1000.0, 1001.0],), ([1.0, 2.0, 3.0],)], "x array<double>")
    got = [r[0] for r in frame.select(positive_softmax("x")).collect()]
    third = math.exp(2) / (math.exp(1) + math.exp(2) + math.exp(3))
    assert got == pytest.approx([0.5, 1 / (1 + math.exp(-1)), third])


def test_text_functions_follow_python(spark):
    samples = ["  a\tb \n c  ", "", "  x y　", "one", "\x1ca\x1fb"]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = frame.select("i", strip("s").alias("a"), truncate_words("s", 2).alias("b"), normalize_line("s").alias("c"), terms("s").alias("d"))
    for r in got.collect():
        text = samples[r.i]
        assert (r.a, r.b, r.c) == (text.strip(), " ".join(text.split()[:2]), re.sub(r"\s+", " ", text.strip()))
        assert r.d == split(text)


def test_ranker_prefers_matching_passages(spark, rng):
    rows = [(i % 5, i, float(i % 10), i % 4, 3, 10 + i % 3, float(i % 10 > 6)) for i in range(200)]
    features = spark.createDataFrame(rows, "qid long, pid long, bm25 double, shared long, query_terms long, length long, label double")
    scored = ranker.score_with_ranker(ranker.fit_ranker(features), features).join(features, ["qid", "pid"])
    means = {r.label: r.m for r in scored.groupBy("label").agg(F.avg("score").alias("m")).collect()}
    assert means[1.0] > 0.5 > means[0.0]


def test_building_plans_starts_no_job(spark, rng):
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans")
    try:
        top = scoring.retrieve(asked, held, k=5)
        scoring.score_bm25(top, asked, held)
        scoring.rank_features(top, asked, held)
        assert tracker.getJobIdsForGroup("building") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def text_pairs(spark, rng, n=300):
    rows = [(i, i % 10, i, " ".join(["q"] * (1 + i % 3)), " ".join(["w"] * rng.choice([1, 2, 3, 5, 8, 40, 200])) + f" {i % 50}") for i in range(n)]
    return spark.createDataFrame(rows, "ord long, qid long, pid long, query string, passage string")


def test_even_batches_pad_less_and_score_the_same(spark, rng):
    pairs = text_pairs(spark, rng).repartition(1)

    def padded():
        return lambda asked, held: [float(max(len(p.split()) for p in held)) for _ in held]

    plain = scoring.score_pairs(pairs, padded, batch_size=16).agg(F.sum("score")).first()[0]
    even = scoring.score_pairs(pairs, padded, batch_size=16, even=True).agg(F.sum("score")).first()[0]
    words = sum(len(r.passage.split()) for r in pairs.collect())
    assert words <= even < 1.5 * words < plain
    own = lambda: lambda asked, held: [float(len(p)) for p in held]
    both = [sorted(tuple(r) for r in scoring.score_pairs(pairs, own, even=e).collect()) for e in (False, True)]
    assert both[0] == both[1] and [r[0] for r in both[0]] == list(range(300))


def test_kept_scores_are_not_asked_for_again(spark, rng, tmp_path):
    pairs, store, calls = text_pairs(spark, rng), str(tmp_path / "store"), spark.sparkContext.accumulator(0)

    def load():
        def score(asked, held):
            calls.add(len(held))
            return [float(len(p)) for p in held]

        return score

    distinct = pairs.select("query", "passage").distinct().count()
    first = sorted(tuple(r) for r in scoring.score_kept(pairs, load, store, "m", rounds=3).collect())
    assert calls.value == distinct < 300 and len(first) == 300
    assert sorted(tuple(r) for r in scoring.score_kept(pairs, load, store, "m").collect()) == first and calls.value == distinct
    more = pairs.union(spark.createDataFrame([(300, 1, 300, "new", "text"), (301, 1, 301, None, None)], pairs.schema))
    assert scoring.score_kept(more.filter("ord <> 301"), load, store, "m").count() == 301 and calls.value == distinct + 1
    scoring.score_kept(pairs, load, store, "another").count()
    assert calls.value == 2 * distinct + 1
    assert scoring.score_kept(pairs.limit(0), load, str(tmp_path / "none"), "m").collect() == []


def test_a_job_that_dies_keeps_its_rounds(spark, rng, tmp_path):
    pairs, store = text_pairs(spark, rng), str(tmp_path / "store")
    last = pairs.select(F.unhex(F.sha2(F.to_json(F.struct(F.lit("m").alias("m"), F.col("query").alias("q"), F.col("passage").alias("p"))), 256)).alias("d"), "query", "passage")
    doomed = {(r.query, r.passage) for r in last.filter(F.pmod(F.xxhash64("d"), F.lit(4)) == 3).collect()}

    def failing():
        def score(asked, held):
            if doomed & set(zip(asked, held, strict=True)):
                raise RuntimeError("lost")
            return [0.5] * len(held)

        return score

    with pytest.raises(Exception, match="lost"):
        scoring.score_kept(pairs, failing, store, "m", rounds=4)
    kept = spark.read.parquet(store).count()
    assert 0 < kept < pairs.select("query", "passage").distinct().count()
    calls = spark.sparkContext.accumulator(0)

    def load():
        return lambda asked, held: (calls.add(len(held)), [0.5] * len(held))[1]

    assert scoring.score_kept(pairs, load, store, "m").count() == 300
    assert calls.value == pairs.select("query", "passage").distinct().count() - kept


def test_weights_of_one_are_plain_retrieval(spark, rng):
    asked, held = frames(spark, *corpus(rng))
    collection = scoring.Collection.staged(held)
    plain = {tuple(r) for r in scoring.retrieve(asked, collection, k=9).collect()}
    ones = scoring.query_terms(asked).withColumn("weight", F.lit(1.0))
    assert {tuple(r) for r in scoring.retrieve_weighted(ones, collection, k=9).collect()} == plain
    gone = ones.withColumn("weight", F.when(F.col("term") == "fir", 0.0).otherwise(2.0))
    without = scoring.retrieve(asked.withColumn("text", F.regexp_replace("text", "fir", "")), collection, k=9).collect()
    twice = {(r.qid, r.pid): r.score for r in scoring.retrieve_weighted(gone, collection, k=9).collect()}
    assert twice == pytest.approx({(r.qid, r.pid): 2 * r.score for r in without}, abs=1e-8)


def test_parts_by_length_hold_about_equal_bytes(spark):
    """Few pairs have nearly all of the text; their parts take no more of it than others, and neighbours stay alike."""
    rows = [(i, i % 10, i, "q", "w " * (400 if i % 20 == 0 else 1 + i % 3)) for i in range(400)]
    rows += [(400, 0, 400, None, None)]
    pairs = spark.createDataFrame(rows, "ord long, qid long, pid long, query string, passage string")
    placed = scoring.by_length(pairs, 8).withColumn("part", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:5] for r in placed) == sorted(rows) and placed[0].asDict().keys() == {*pairs.columns, "part"}
    held = {}
    for r in placed:
        held.setdefault(r.part, []).append(len((r.passage or "").split()))
    assert all(lengths == sorted(lengths) for lengths in held.values())
    assert all(max(held[p]) <= min(held[p + 1]) for p in sorted(held) if p + 1 in held)
    assert max(sum(lengths) for lengths in held.values()) < 2 * sum(map(sum, held.values())) / 8


def test_texts_with_missing_scores_are_not_grouped(spark, rng, tmp_path, monkeypatch):
    """Equal texts are told by their digests: no aggregate or sort takes the texts along."""
    plans, plain = {}, scoring.stage

    def watched(df, label="stage"):
        plans[label] = df._jdf.queryExecution()
        return plain(df, label)

    monkeypatch.setattr(scoring, "stage", watched)
    own = lambda: lambda asked, held: [float(len(p)) for p in held]
    scoring.score_kept(text_pairs(spark, rng), own, str(tmp_path / "store"), "m", rounds=1).count()
    groups = [line for line in plans["missing"].optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert groups and not [line for line in groups if "passage" in line]
    assert "SortMergeJoin" not in plans["missing"].executedPlan().toString()
