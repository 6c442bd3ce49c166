import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import cotraining

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_held_out_accuracy(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    scored = cotraining.classify(docs, labels.filter(part > 0))
    assert scored.count() == docs.count()
    held = scored.join(labels.filter(part == 0), scored["key"] == labels["doc_id"]).collect()
    right = sum(r.keep == bool(r.quality) for r in held) / len(held)
    kept_good = sum(r.keep for r in held if r.quality) / sum(r.quality for r in held)
    assert right > 0.93 and kept_good > 0.96
    bins = [[r for r in held if lo <= r.score < lo + 0.5] for lo in (0, 0.5)]
    assert all(0 <= r.score <= 1 for r in held) and len(bins[1]) > len(bins[0])


def test_samples_are_bounded(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = cotraining.views(docs)
    model = cotraining.co_train(rows, labels, rounds=1, labelled_rows=200, pool_rows=100)
    assert model.score(rows).count() == docs.count()
    assert cotraining._sample(rows, 100, 3).count() < 200


def test_all_unlabelled_rows_take_part(spark, monkeypatch):
    x = F.when(F.col("id") % 2 == 0, F.lit(9.0)).otherwise(F.lit(-9.0)).cast("float")
    rows = spark.range(60_000).select(F.col("id").alias("key"), F.array(x).alias("content"), F.array(x).alias("page"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (1 - F.col("id") % 2).cast("int").alias("quality"))
    fit, taught = cotraining._fit, []
    monkeypatch.setattr(cotraining, "_fit", lambda data, *a: taught.append(data.count()) or fit(data, *a))
    cotraining.co_train(rows, labels, rounds=1)
    assert taught[2] == taught[3] == taught[0] + 59_600


def test_rows_without_a_lesson(spark):
    rows = [(1, "a b", "s", "en", 3), (1, "a b", "s", "en", 3), (None, None, None, None, None), (2, "", "t", "fr", 0), (3, "x " * 200_000, "s", "en", -5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    df = df.withColumns({"score": F.lit(1), "page": F.lit("x"), "key": F.lit(0), "label": F.lit(1)})
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0), (99, 0)], "doc_id bigint, quality int")
    assert {r.score for r in cotraining.classify(df, none).collect()} == {0.5}
    got = cotraining.classify(df, one).collect()
    assert len(got) == 5 and {r.score for r in got} == {1.0}
    assert cotraining.classify(df.limit(0), one).collect() == []


def test_equal_rows_get_equal_scores(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    some = docs.limit(200)
    got = cotraining.classify(docs.union(some), labels).groupBy("key").agg(F.countDistinct("score").alias("n")).filter("n > 1")
    assert got.count() == 0


def plain_fit(x, y, regularization=0.005):
    """Logistic regression with a penalty on the weights of scaled features, by Newton's steps: weights and intercept."""
    scale = x.std(axis=0, ddof=1)
    scaled = np.column_stack([x / scale, np.ones(len(x))])
    penalty = np.diag([regularization] * x.shape[1] + [0.0])
    w = np.zeros(x.shape[1] + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-scaled @ w))
        slope = scaled.T @ (p - y) / len(x) + penalty @ w
        bend = (scaled * (p * (1 - p))[:, None]).T @ scaled / len(x) + penalty
        w = w - np.linalg.solve(bend, slope)
    return w[:-1] / scale, w[-1]


def plain_scores(content, page, label, held, rounds):
    """Both views' probabilities and the combined one, by plain loops; ``label`` is NaN where there is none."""
    logit = lambda model, x: x @ model[0] + model[1]
    chance = lambda z: 1 / (1 + np.exp(-z))
    views, known = (content, page), ~np.isnan(label)
    taught, held, pool = known & ~held, known & held, ~known
    models = [plain_fit(x[taught], label[taught]) for x in views]
    learned = []
    for _ in range(rounds):
        sure = [chance(logit(m, x[pool])) for m, x in zip(models, views, strict=True)]
        models = []
        for x, p in zip(views, sure[::-1], strict=True):
            certain = (p >= cotraining.SURE) | (p <= 1 - cotraining.SURE)
            learned.append(int(certain.sum()))
            models.append(
                plain_fit(np.vstack([x[taught], x[pool][certain]]), np.concatenate([label[taught], p[certain] >= cotraining.SURE]))
            )
    calibrated = []
    for m, x in zip(models, views, strict=True):
        own = logit(m, x)[:, None]
        calibrated.append(logit(plain_fit(own[held], label[held], 1e-4), own))
    both = np.column_stack(calibrated)
    combined = logit(plain_fit(both[held], label[held], 1e-4), both)
    return [chance(z) for z in (*calibrated, combined)], learned


@pytest.mark.parametrize("rounds", [0, 3])
def test_equals_plain_co_training(spark, rounds):
    rng = np.random.default_rng(5)
    truth = rng.random(3000) < 0.4
    content = (rng.normal(size=(3000, 2)) * [1, 3] + truth[:, None] * [1.5, 4]).astype(np.float32).astype(float)
    page = (rng.normal(size=(3000, 3)) + truth[:, None] * [1.2, 0, -1.5]).astype(np.float32).astype(float)
    label = np.where(np.arange(3000) < 600, truth.astype(float), np.nan)
    data = [(i, content[i].tolist(), page[i].tolist()) for i in range(3000)]
    rows = spark.createDataFrame(data, "key bigint, content array<float>, page array<float>")
    labels = spark.createDataFrame([(i, int(label[i])) for i in range(600)], "doc_id bigint, quality int")
    held = {r.key: r.held for r in rows.select("key", (cotraining._draw(2) < cotraining.HELD_SHARE).alias("held")).collect()}
    wanted, learned = plain_scores(content, page, label, np.array([held[i] for i in range(3000)]), rounds)
    assert all(n > 200 for n in learned)
    got = {r.key: r for r in cotraining.co_train(rows, labels, rounds=rounds).score(rows).collect()}
    for name, plain in zip(("p_content", "p_page", "score"), wanted, strict=True):
        assert np.abs(np.array([got[i][name] for i in range(3000)]) - plain).max() < 0.005
