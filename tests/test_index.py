import pytest
from pyspark.sql import functions as F
from test_scoring import bm25_by_hand, corpus, frames

from rankflow.operators import index as indexed
from rankflow.operators import scoring


def rare_corpus(rng, n=400):
    """Common and rare words, so that blocks of common words can be skipped."""
    common, rare = [f"c{chr(97 + k)}" for k in range(4)], [f"r{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(5)]
    passages = [(p, " ".join([*rng.choices(common, k=rng.randint(3, 12)), *rng.choices(rare, k=rng.randint(1, 6))])) for p in range(n)]
    queries = [(q, " ".join([*rng.sample(common, 2), *rng.sample(rare, 3)])) for q in range(12)] + [(12, "unknown"), (13, "ca")]
    return queries, passages


@pytest.mark.parametrize(("k", "block", "spare"), [(1, 4, 1), (5, 8, 2), (40, 16, 1), (1000, 256, 2)])
@pytest.mark.parametrize("make", [corpus, rare_corpus])
def test_equals_full_retrieval(spark, rng, make, k, block, spare):
    asked, held = frames(spark, *make(rng))
    index = indexed.InvertedIndex.staged(scoring.Collection.staged(held), block_postings=block)
    plain = {tuple(r) for r in scoring.retrieve(asked, held, k=k).collect()}
    assert {tuple(r) for r in indexed.retrieve_indexed(asked, index, k=k, spare=spare).collect()} == plain


def test_reads_fewer_postings_and_no_text(spark, rng):
    queries, passages = rare_corpus(rng, 2000)
    asked, held = frames(spark, queries, passages)
    index = indexed.InvertedIndex.staged(scoring.Collection.staged(held), block_postings=16)
    planned = indexed.planned_blocks(asked, index, k=5)
    taken, all_ = planned.agg(F.sum(F.when(F.col("taken"), F.col("n"))), F.sum("n")).first()
    assert 0 < taken < 0.6 * all_
    again = asked.select(F.col("qid") + 100, F.upper("text")).toDF("qid", "text")
    found = indexed.retrieve_indexed(again, index, k=5)
    assert "text" not in str(index.blocks.schema) and {r.qid for r in found.collect()} == {q + 100 for q, _ in queries if q != 12}


def test_bounds_hold(spark, rng):
    """No passage outside the blocks taken so far scores more than ``reach``."""
    queries, passages = rare_corpus(rng, 150)
    asked, held = frames(spark, queries, passages)
    index = indexed.InvertedIndex.staged(scoring.Collection.staged(held), block_postings=8)
    scores = bm25_by_hand(queries, passages)
    ordered = indexed._ordered(index, index.collection.weights(scoring.query_terms(asked)).withColumnRenamed("term", "id"), ["qid"])
    rows = ordered.join(index.blocks.select("id", "block", "postings"), ["id", "block"]).collect()
    for q, _ in queries[:6]:
        mine = sorted((r for r in rows if r.qid == q), key=lambda r: (-r.most, r.id, tuple(r.block)))
        seen = set()
        for r in mine:
            assert all(scores[q, p][0] <= r.reach + 1e-9 for p, _ in passages if p not in seen)
            seen |= {x.pid for x in r.postings}


def test_blocks_are_bounded(spark):
    held = spark.range(20_000).select(F.col("id").alias("pid"), F.lit("the same words").alias("text"))
    index = indexed.InvertedIndex.staged(scoring.Collection.staged(held))
    sizes = index.blocks.agg(F.sum("n"), F.max("n"), F.count("*")).first()
    assert sizes[0] == 60_000 and sizes[1] < 2 * indexed.BLOCK_POSTINGS and sizes[2] == 3 * 79


def test_empty_tables(spark):
    asked, held = frames(spark, [(1, "word")], [(1, "word")])
    nothing = indexed.InvertedIndex.staged(scoring.Collection.staged(held.limit(0)))
    assert indexed.retrieve_indexed(asked, nothing).collect() == []
    index = indexed.InvertedIndex.staged(scoring.Collection.staged(held))
    assert indexed.retrieve_indexed(asked.limit(0), index).collect() == []
    with pytest.raises(ValueError):
        indexed.InvertedIndex.staged(scoring.Collection.of(held))


def test_pairs_make_no_row_per_term(spark, rng):
    """Queries and passages are taken apart; a pair is never, and meets one row of each."""
    queries, passages = corpus(rng)
    asked, held = frames(spark, queries, passages)
    collection = scoring.Collection.staged(held)
    pairs = spark.createDataFrame([(q, p) for q, _ in queries for p, _ in passages[::5]], "qid long, pid long")
    plan = scoring.score_bm25(pairs, asked, collection)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join LeftOuter")]
    assert "Generate" not in above and "Aggregate [" not in above
    assert all("text" in line or "arrays_zip" in line for line in plan.splitlines() if "Generate" in line)


def test_numbers_that_clash_are_drawn_anew(spark, monkeypatch):
    """A seed under which two terms share a number is passed over."""
    plain = scoring.term_number
    clash = lambda term, seed=0: F.lit(7).cast("bigint") if seed == 0 else plain(term, seed)
    monkeypatch.setattr(scoring, "term_number", clash)
    asked, held = frames(spark, [(1, "ash fir")], [(1, "ash"), (2, "fir fir ash"), (3, "oak")])
    got = {r.pid for r in scoring.retrieve(asked, scoring.Collection.staged(held)).collect()}
    assert got == {1, 2}
