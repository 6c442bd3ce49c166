import pytest
from pyspark.sql import functions as F

from rankflow.operators import samples

TRIPLES = "ord long, qid string, pos_id string, neg_id string"


def make_triples(rng, n=400):
    return [(i, f"q{rng.randint(0, 11) if i % 3 else 0}", f"p{rng.randint(0, 30)}", f"n{rng.randint(0, 25)}") for i in range(n)]


def read_in_order(triples, dev_count, cap, ratio, limit=None):
    """The sample rules as one pass over the lines."""
    dev = {}
    for _, qid, pos, neg in triples:
        if qid not in dev and len(dev) < dev_count:
            dev[qid] = (set(), set())
        if qid in dev:
            dev[qid][0].add(pos)
            if len(dev[qid][1]) < cap:
                dev[qid][1].add(neg)
    labelled = []
    for ord_, qid, pos, neg in triples:
        if qid in dev or (limit is not None and len(labelled) >= limit):
            continue
        first = len(labelled) % (ratio + 1) == 0
        labelled.append((len(labelled), ord_, qid, pos if first else neg, int(first)))
    return dev, labelled


@pytest.mark.parametrize("block_rows", [7, 64, 1 << 20])
def test_samples_equal_one_pass_over_the_lines(spark, rng, rows, block_rows):
    triples = make_triples(rng)
    frame = spark.createDataFrame(triples, TRIPLES).repartition(5)
    dev, labelled = read_in_order(triples, 4, 6, 3)
    chosen = samples.select_dev_queries(frame, 4)
    assert {r.qid for r in chosen.collect()} == set(dev)
    got = samples.dev_samples(frame, 4, 6)
    assert rows(got) == sorted(
        [(q, p, True) for q, (ps, _) in dev.items() for p in ps] + [(q, n, False) for q, (_, ns) in dev.items() for n in ns]
    )
    assert rows(samples.training_samples(frame, chosen, 3, block_rows=block_rows)) == labelled
    _, capped = read_in_order(triples, 4, 6, 3, limit=50)
    assert rows(samples.training_samples(frame, chosen, 3, 50, block_rows)) == capped
    needed = {p for ps, ns in dev.values() for p in ps | ns} | {p for _, _, _, p, _ in labelled}
    assert {r.pid for r in samples.needed_passages(got, samples.training_samples(frame, chosen, 3)).collect()} == needed


def texts(spark):
    queries = spark.createDataFrame([("q1", "one"), ("q2", "two")], "qid string, text string")
    passages = spark.createDataFrame([("p1", "a"), ("p2", "b")], "pid string, text string")
    return queries, passages


def test_texts_drop_missing_rows_and_summary_counts_them(spark, rows):
    chosen = spark.createDataFrame(
        [(0, 0, "q1", "p1", 1), (1, 1, "q1", "gone", 0), (2, 2, "gone", "p1", 0), (3, 3, "q2", "p2", 0)],
        "n long, ord long, qid string, pid string, label int",
    )
    made = samples.materialize_samples(chosen, *texts(spark))
    assert rows(made, "n", "query", "passage", "label") == [(0, "one", "a", 1), (3, "two", "b", 0)]
    assert tuple(samples.sample_summary(chosen, *texts(spark)).first()) == (2, 1, 1, 2)


def test_dev_texts_and_lists(spark, rows):
    dev = spark.createDataFrame(
        [("q1", "p1", True), ("q1", "p2", False), ("q1", "gone", False), ("q2", "p1", True)],
        "qid string, pid string, is_pos boolean",
    )
    long = samples.materialize_dev(dev, *texts(spark))
    assert rows(long, "qid", "passage", "is_pos") == [("q1", "a", True), ("q1", "b", False), ("q2", "a", True)]
    assert rows(samples.nest_dev(long)) == [("q1", 0, "one", ["a"], ["b"]), ("q2", 0, "two", ["a"], [])]
    assert rows(samples.nest_dev(long, items=1)) == [("q1", 0, "one", ["a"], []), ("q1", 1, "one", [], ["b"]), ("q2", 0, "two", ["a"], [])]
    unknown = spark.createDataFrame([("q9", "p1", True)], dev.schema)
    with pytest.raises(Exception, match="dev query without text: q9"):
        samples.materialize_dev(unknown, *texts(spark)).collect()


def test_collection_checks(spark, rows):
    _, passages = texts(spark)
    needed = spark.createDataFrame([("p2",), ("p3",)], "pid string")
    assert rows(samples.subset_passages(passages, needed), "pid") == [("p2",)]
    assert samples.subset_passages(passages, None) is passages
    assert rows(samples.missing_passages(needed, passages)) == [("p3",)]
    assert samples.require_min_rows(passages, 2) is passages
    with pytest.raises(ValueError, match="2 rows"):
        samples.require_min_rows(passages, 3)


def test_batches_are_full_shuffled_and_reproducible(spark):
    frame = spark.range(1000).withColumnRenamed("id", "n")
    got = [
        {r.n: r.batch for r in samples.assign_batches(frame.repartition(parts), "n", 32, seed, rows).collect()}
        for parts, seed, rows in ((1, 5, 1 << 32), (7, 5, 1000), (3, 6, 1 << 32))
    ]
    assert got[0] == got[1] != got[2]
    sizes = [list(got[0].values()).count(b) for b in range(32)]
    assert sizes == [32] * 31 + [8]
    assert [n for n in range(32) if got[0][n] == 0] != list(range(32))


def test_registered_queries_train_on_no_dev_query(spark, monkeypatch):
    from rankflow.plans import catalog
    from rankflow.plans.fixtures import DEV_QUERIES, Inputs

    rows = [(n, n % (DEV_QUERIES + 30), n, n + 1) for n in range(2000)]
    triples = spark.createDataFrame(rows, "ord bigint, qid bigint, pos_id bigint, neg_id bigint")
    monkeypatch.setattr(Inputs, "triples", triples)
    monkeypatch.setattr(Inputs, "openings", triples.select("qid").distinct().withColumn("text", F.lit("x")))
    i = Inputs(spark, "")
    dev = {r.qid for r in samples.select_dev_queries(triples, DEV_QUERIES).collect()}
    trained = [catalog._labelled(i), catalog._text_samples(i), samples.exclude_dev(triples, samples.select_dev_queries(triples, catalog.HELD_OUT))]
    for frame in trained:
        assert {r.qid for r in frame.select("qid").distinct().collect()} == set(range(DEV_QUERIES + 30)) - dev


@pytest.mark.parametrize("rows", [1, 2, 5, 31, 1000, 4097])
def test_permutation_is_one(spark, rows):
    df = spark.range(rows).withColumnRenamed("id", "n")
    got = [(r.epoch, r.n, r.batch * 32 + r.place) for r in samples.epoch_batches(df, rows, epochs=2, seed=3).collect()]
    for epoch in (0, 1):
        assert sorted(at for e, _, at in got if e == epoch) == list(range(rows))
    if rows > 100:
        first, second = ({n: at for e, n, at in got if e == epoch} for epoch in (0, 1))
        assert sum(first[n] == second[n] for n in first) < rows / 20
        assert sum(abs(first[n] - first[n + 1]) < rows / 100 for n in range(rows - 1)) < rows / 20


def test_epochs_move_no_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "n")
    plan = samples.epoch_batches(df, 1000, epochs=2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    assert samples.epoch_batches(df.limit(0), 0, epochs=1).collect() == []


def test_counts_on_the_way_equal_the_summary(spark):
    labelled = spark.createDataFrame([(n, n % 7, n % 5, int(n % 3 == 0)) for n in range(60)], "n bigint, qid bigint, pid bigint, label int")
    queries = spark.createDataFrame([(q, "q") for q in range(5)], "qid bigint, text string")
    passages = spark.createDataFrame([(p, "p") for p in range(4)], "pid bigint, text string")
    made, summary = samples.materialize_counted(labelled, queries, passages)
    assert summary.first() == samples.sample_summary(labelled, queries, passages).first()
    assert made.count() == summary.first()["loaded"] > 0 and summary.first()["dropped"] > 0
    none = samples.materialize_counted(labelled, queries.limit(0), passages)[1].first()
    assert tuple(none) == (0, 0, 0, 60)
