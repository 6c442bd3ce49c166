import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_scoring import bm25_by_hand, corpus, frames

from rankflow.operators import cells, index, scoring
from rankflow.sources import files


def test_cells_hold_the_best_of_all(spark, rng):
    """Queries of more than one batch, text ids, a passage that comes twice; the same rows from one cell and from many."""
    n, asked = 300, 40
    rows = [(f"p{p}", f"t{t}", 0.5 + rng.random()) for p in range(n) for t in rng.sample(range(30), 6)]
    rows += rows[:20]
    weights = [(f"q{q}", f"t{t}", 1.0 + rng.random()) for q in range(asked) for t in rng.sample(range(35), 5)]
    postings, wanted = spark.createDataFrame(rows, "pid string, term string, part double"), spark.createDataFrame(weights, "qid string, term string, weight double")
    sums = {}
    for q, t, w in weights:
        for p, u, x in rows:
            if t == u:
                sums[q, p] = sums.get((q, p), 0.0) + w * x
    for count, spare in ((1, None), (7, None), (3, 1)):
        found = cells.best_by_cell(postings, wanted, F.lit(count), ["qid"], 4, spare).collect()
        assert all(abs(sums[r.qid, r.pid] - r.score) < 1e-8 for r in found) and len(found) <= 4 * count * asked
        for q in {q for q, _, _ in weights}:
            best = sorted(((-s, p) for (q2, p), s in sums.items() if q2 == q))[:4]
            assert sorted((-r.score, r.pid) for r in found if r.qid == q)[:4] == [(np.round(s, 9), p) for s, p in best]


def test_ties_go_by_id(spark):
    held = pa.table({"pid": [5, 3, 9, 1], "term": ["a"] * 4, "part": [1.0, 1.0, 2.0, 1.0]})
    cell = cells._Cell(held)
    docs, scores = cell.best(np.array([0]), np.array([1.0]), 2, None)
    assert [cell.pids[int(d)].as_py() for d in docs] == [9, 1] and scores.tolist() == [2.0, 1.0]


def test_no_row_per_query_and_posting(spark, rng):
    """Queries meet postings in their cells: neither retrieval joins them on terms or sums rows of pairs."""
    asked, held = frames(spark, *corpus(rng))
    collection = scoring.Collection.staged(held)
    plans = [scoring.retrieve(asked, collection, k=5, spare=s) for s in (None, 8)]
    plans.append(index.retrieve_indexed(asked, index.InvertedIndex.staged(collection), k=5))
    for found in plans:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Aggregate [qid#" in plan
        assert not [line for line in plan.splitlines() if "Aggregate [qid#" in line and "pid#" in line.split("]")[0]]


def test_pairs_weigh_only_their_own_queries(spark, rng):
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    pairs = spark.createDataFrame([(1, 3), (2, 4)], "qid long, pid long")
    scores = bm25_by_hand(queries, passages)
    got = scoring.score_bm25(pairs, asked, scoring.Collection.staged(held))
    assert all(abs(r.score - scores[r.qid, r.pid][0]) < 1e-8 for r in got.collect())
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi") > 3


def test_table_names_are_made_once_per_block(spark, tmp_path):
    (tmp_path / "one.run").write_text("1 Q0 7 1 0.5 t\n" * 3)
    rows = files.read_runs(spark, str(tmp_path / "one.run"))
    assert [tuple(r) for r in rows.collect()] == [("one", "1", "7", 1, 0.5)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert ".gz$" in plan and ".gz$" not in plan[: plan.index("Join")]


def test_repeated_rows_give_the_rows_of_retrieve(spark, rng):
    """A query or a passage that comes twice counts alike in both ways of retrieval."""
    queries, passages = corpus(rng, 200)
    asked, held = frames(spark, queries + queries[:3], passages + passages[:30])
    collection = scoring.Collection.staged(held)
    built = index.InvertedIndex.staged(collection, block_postings=8)
    plain = {tuple(r) for r in scoring.retrieve(asked, collection, k=5).collect()}
    assert {tuple(r) for r in index.retrieve_indexed(asked, built, k=5).collect()} == plain


def test_a_known_cell_is_a_task_of_its_own(spark, rng, monkeypatch):
    """A task sorts one cell's postings, however few shuffle partitions there are."""
    monkeypatch.setattr(cells, "LEAST_TERMS", 100)
    asked, held = frames(spark, *corpus(rng, 200))
    plain = {tuple(r) for r in scoring.retrieve(asked, held, k=5).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for collection in (scoring.Collection.staged(held), scoring.Collection.of(held).counted()):
            assert collection.cells == cells.SMALL_CELLS
            weights = collection.weights(scoring.query_terms(asked)).withColumnRenamed("idf", "weight")
            parts = collection.counts.select("pid", "term", F.col("tf").cast("double").alias("part"))
            found = cells.best_by_cell(parts, weights, collection.cells, ["qid"], 5)
            at = found.select("pid", F.spark_partition_id().alias("task")).distinct().collect()
            number = {r.pid: r.n for r in held.select("pid", F.pmod(F.xxhash64("pid"), F.lit(cells.SMALL_CELLS)).alias("n")).collect()}
            assert found.rdd.getNumPartitions() == cells.SMALL_CELLS and all(number[r.pid] == r.task for r in at)
            assert {tuple(r) for r in scoring.retrieve(asked, collection, k=5).collect()} == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_counting_first_changes_no_row(spark, rng):
    """Passages without a text count for the size and not for the mean length, counted before or in the query; none at all give no rows."""
    asked, held = frames(spark, *corpus(rng))
    held = held.unionByName(spark.createDataFrame([(901, None), (902, "")], held.schema))
    collection = scoring.Collection.of(held)
    plain = {tuple(r) for r in scoring.retrieve(asked, collection, k=5).collect()}
    assert plain and {tuple(r) for r in scoring.retrieve(asked, collection.counted(), k=5).collect()} == plain
    assert scoring.retrieve(asked, scoring.Collection.of(held.limit(0)).counted(), k=5).isEmpty()


def test_stored_index_holds_terms_without_numbers(spark, rng):
    """Numbers of terms are made when the index is read; they are not stored beside the terms."""
    _, held = frames(spark, *corpus(rng, 50))
    counts = scoring.Collection.staged(held).counts
    read = [line for line in counts._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line]
    assert read and not [line for line in read if "ids#" in line]
    number = {r.term: r.id for r in scoring.term_counts(held).select("term", scoring.term_number("term").alias("id")).collect()}
    plain = sorted((r.pid, r.dl, number[r.term], r.tf) for r in scoring.term_counts(held).collect())
    assert sorted(tuple(r) for r in counts.collect()) == plain


@pytest.mark.parametrize("share", [1, 4, 10**6])
@pytest.mark.parametrize("figures", [0, 2000, 10**6])
def test_batches_answer_as_plain_sums(rng, monkeypatch, share, figures):
    """Many queries at once, terms that few, many and all passages hold, kept as rows or not: the best by (score, id) of plain sums."""
    monkeypatch.setattr(cells, "COMMON_SHARE", share)
    monkeypatch.setattr(cells, "COMMON_FIGURES", figures)
    monkeypatch.setattr(cells, "MET_FIGURES", 7 * 300)
    monkeypatch.setattr(cells, "MET_POSTINGS", 500)
    part = {(p, t): rng.choice([0.5, 1.0, 1.5]) for p in range(300) for t in range(40) if rng.random() < (1.0 if t < 2 else 1 / t)}
    rows = [(p, t) for p, t in part]
    rng.shuffle(rows)
    cell = cells._Cell(pa.table({"pid": [p for p, _ in rows], "term": [t for _, t in rows], "part": [part[r] for r in rows]}))
    place = {t: at for at, t in enumerate(cell.terms.to_pylist())}
    asked = [[(place[t], 0.1 + t) for t in rng.sample(sorted(place), rng.randint(0, 6))] for _ in range(50)]
    row = np.repeat(np.arange(50), [len(a) for a in asked])
    terms, weights = (np.array([x[at] for a in asked for x in a], kind) for at, kind in ((0, np.int64), (1, float)))
    back = {at: t for t, at in place.items()}
    for k, spare in ((1, None), (3, 1), (5, 2), (5, None), (400, 1)):
        got = {}
        for batch in cell.best_of_many(row, terms, weights, 50, k, spare):
            for q, d, s in zip(*(x.tolist() for x in batch), strict=True):
                got.setdefault(q, []).append((-s, cell.pids[d].as_py()))
        for q, own in enumerate(asked):
            sums = {p: sum(w * part.get((p, back[t]), 0.0) for t, w in own) for p in range(300)}
            assert sorted(got.get(q, [])) == sorted((-np.floor(s * 1e9 + 0.5) / 1e9, p) for p, s in sums.items() if s)[:k]


def test_a_batch_takes_few_calls(rng):
    """Ten thousand queries of a cell take calls per batch and per common term, none per query or posting."""
    import cProfile
    import pstats

    rows = [(p, t) for p in range(500) for t in rng.sample(range(400), 5)]
    cell = cells._Cell(pa.table({"pid": [p for p, _ in rows], "term": [t for _, t in rows], "part": [1.0] * len(rows)}))
    row, terms = np.repeat(np.arange(10_000), 3), np.array([t for _ in range(10_000) for t in rng.sample(range(len(cell.terms)), 3)])
    with cProfile.Profile() as profile:
        found = sum(len(np.unique(q)) for q, _, _ in cell.best_of_many(row, terms, np.ones(len(row)), 10_000, 3, 2))
    assert found == 10_000 and pstats.Stats(profile).total_calls < 20_000
