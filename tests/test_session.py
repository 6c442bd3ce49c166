import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scoring import corpus, frames

from rankflow.operators import fusion, scoring, text_ranker
from rankflow.session import released, stage

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for at in range(blocks.size()) if (name := blocks.apply(at).getName()).startswith("shuffle_")}


def left_by(spark, job):
    """Shuffle files that are there after the job and were not before, once deletions are through.

    The fewer of two runs, as a stage that an earlier test did not wait for may end meanwhile.
    """
    left = []
    for run in range(2):
        before = shuffle_files(spark)
        job(run)
        for _ in range(30):
            if not (now := shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        left.append(now)
    return min(left, key=len)


@pytest.fixture
def sums(spark):
    return lambda: spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"))


def test_a_staged_write_leaves_no_shuffle_files(spark, sums):
    kept = {}
    assert not left_by(spark, lambda run: kept.update(made=stage(sums())))
    assert kept["made"].count() == 700 and spark.conf.get(CLEANED) == "false"
    assert left_by(spark, lambda run: sums().collect())


def test_settings_come_back_after_a_failure(spark):
    with pytest.raises(KeyError), released(spark):
        assert spark.conf.get(CLEANED) == "true"
        raise KeyError
    assert spark.conf.get(CLEANED) == "false"


def test_fetched_figures_leave_no_shuffle_files(spark, sums, tmp_path):
    """The choice of the best method, the scaling and the steps of the ranker."""
    results = sums().select(F.concat(F.lit("fuse:"), F.when(F.col("k") == 3, "rrf").otherwise("sum")).alias("system"), F.col("s").alias("ndcg@10"))
    assert not left_by(spark, lambda run: fusion.best_method(results))
    figures = F.array(*[F.lit(1.0)] * text_ranker.FIGURES)
    rows = sums().select(
        (F.col("k") % 9).alias("qid"), F.col("k").alias("pid"), (F.col("k") % 3 == 0).alias("is_pos"), (F.col("k") % 2).alias("label"),
        (F.col("k") % 8).alias("batch"), F.array((F.col("k") % 50 + 1).cast("int")).alias("slots"), figures.alias("figures"),
        *[F.col("s").cast("double").alias(c) for c in text_ranker.FEATURES],
    )
    assert not left_by(spark, lambda run: text_ranker.scaling(rows))
    assert not left_by(spark, lambda run: text_ranker.train(rows, rows, f"{tmp_path}/{run}", steps=3))
    assert np.any(text_ranker.best_weights(spark, f"{tmp_path}/0")[1])


def test_pairs_choose_passages_before_their_terms(spark, rng):
    """The terms of passages that no pair names are not taken apart."""
    asked, held = frames(spark, *corpus(rng))
    collection = scoring.Collection.staged(held)
    vocabulary = collection.weights(scoring.query_terms(asked)).select("term").distinct()
    bags = scoring.asked_bags(collection, vocabulary, held.select("pid").limit(3))
    lines = bags._jdf.queryExecution().optimizedPlan().toString().splitlines()
    taken_apart = next(at for at, line in enumerate(lines) if "Generate explode(arrays_zip" in line)
    assert any("Join LeftSemi" in line and "pid#" in line for line in lines[taken_apart + 1 :])
    assert bags.count() <= 3


def test_repeated_runs_are_written_compressed(spark):
    """Run files with every row twice would take several times the tables they come from."""
    from rankflow.plans import catalog
    from rankflow.plans.fixtures import Inputs

    for path in catalog._repeated_zero_based(Inputs(spark, "/root/testdata/sf0.001")):
        assert all(name.endswith(".gz") for name in spark.read.text(path).inputFiles())
