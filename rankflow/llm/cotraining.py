"""Quality classifier by co-training of two views of a document.

One classifier sees the text, the other what the page says about itself: source, language,
size. Both start from the labels. In each round either view labels those unlabelled rows it
is sure of, and the other view learns from them. Each view's score is then calibrated on
labels held out of the training, and the two are combined, also on held-out labels, into a
probability for every document.

Of the labelled rows at most ``LABELLED_ROWS`` are used, chosen by hash of the key. All
unlabelled rows are scored in every round, and the fits, which are distributed, take in all
that a view is sure of. All documents are scored in the end.

Null texts count as empty, null metadata as a value of its own. Labels with null key or class
and labels of unknown documents teach nothing; a document with several labels counts with the
highest. Repeated rows get equal scores. If the labels lack one of the two classes there is
nothing to tell apart, and every document gets the share of good labels, 0.5 without any.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import map_batches, picked, pieces
from rankflow.llm.quality import repeated_words
from rankflow.session import stage

LABELLED_ROWS = 40_000
ROUNDS = 3
SURE = 0.95
HELD_SHARE = 0.25
KEEP = 0.5

WORD_BINS, SOURCE_BINS, LANG_BINS = 64, 64, 16
_PUNCTUATION = np.array([b for b in range(33, 127) if not chr(b).isalnum()])


def content_features(text: str) -> np.ndarray:
    """Shares of character classes, punctuation, repetition and hashed words."""
    raw = text.encode()
    size = max(len(raw), 1)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = [bytes_[65:91].sum(), bytes_[97:123].sum(), bytes_[48:58].sum(), bytes_[32], bytes_[10], bytes_[128:].sum()]
    counts: Counter[bytes] = Counter()
    repeated, total, same_next, letters = 0, 0, 0, 0
    for piece in pieces(text):
        words = piece.encode().split()
        counts.update(words)
        repeated += repeated_words(words)
        same_next += sum(map(bytes.__eq__, words, words[1:]))
        total += len(words)
        letters += sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    n = max(total, 1)
    bins = np.zeros(WORD_BINS)
    for word, count in counts.items():
        bins[zlib.crc32(word.lower()) % WORD_BINS] += count
    figures = [
        math.log1p(total),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        repeated / n,
        same_next / n,
        letters / n,
        1 - len(set(lines)) / max(len(lines), 1),
        math.log1p(total / max(len(lines), 1)),
    ]
    return np.concatenate(
        [np.array(classes) / size, np.sqrt(bytes_[_PUNCTUATION] / size), figures, np.sqrt(bins / n)], dtype=np.float32
    )


def page_features(source: str | None, lang: str | None, size: int | None) -> np.ndarray:
    """One-hot source and language, by hash, and the logarithm of the size with its square."""
    features = np.zeros(SOURCE_BINS + LANG_BINS + 2, np.float32)
    features[zlib.crc32((source or "\0").encode()) % SOURCE_BINS] = 1
    features[SOURCE_BINS + zlib.crc32((lang or "\0").encode()) % LANG_BINS] = 1
    log = math.log1p(max(size or 0, 0))
    features[-2:] = log, log * log / 10
    return features


def views(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", size: str = "n_chars"
) -> DataFrame:
    """``(key, content, page)`` with the features of both views per document."""
    rows = picked(docs, key=key, text=text, source=source, lang=lang, size=size)
    kind = rows.schema["key"].dataType.simpleString()

    def stacked(vectors: list[np.ndarray]) -> pa.ListArray:
        flat = np.concatenate(vectors)
        ends = np.arange(len(vectors) + 1, dtype=np.int32) * len(vectors[0])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        content = stacked([content_features(t.as_py() or "") for t in batch.column("text")])
        about = (batch.column(c).to_pylist() for c in ("source", "lang", "size"))
        page = stacked([page_features(*row) for row in zip(*about, strict=True)])
        return pa.record_batch([batch.column("key"), content, page], ["key", "content", "page"])

    return map_batches(rows, run, f"key {kind}, content array<float>, page array<float>")


@dataclass(frozen=True)
class Linear:
    """A logistic model; ``logit`` is its column expression over an array column."""

    weights: tuple[float, ...]
    intercept: float

    def logit(self, features: Column) -> Column:
        weights = F.array(*[F.lit(w) for w in self.weights])
        products = F.zip_with(features, weights, lambda x, w: x.cast("double") * w)
        return F.aggregate(products, F.lit(self.intercept), lambda total, x: total + x)


def _fit(rows: DataFrame, features: Column, regularization: float = 0.005) -> Linear:
    data = rows.select(array_to_vector(features).alias("features"), F.col("label").cast("double").alias("label"))
    model = LogisticRegression(maxIter=40, regParam=regularization).fit(data)
    return Linear(tuple(model.coefficients.toArray().tolist()), float(model.intercept))


@dataclass(frozen=True)
class CoTrained:
    """Both views, calibrated, and their combination; or one constant score."""

    content: Linear | None = None
    page: Linear | None = None
    calibration: tuple[Linear, Linear] | None = None
    combination: Linear | None = None
    constant: float = 0.5

    def _calibrated(self) -> tuple[Column, Column]:
        pairs = zip((self.content, self.page), self.calibration, ("content", "page"), strict=True)
        return tuple(calibration.logit(F.array(view.logit(F.col(name)))) for view, calibration, name in pairs)

    def score(self, rows: DataFrame) -> DataFrame:
        """``(key, p_content, p_page, score)`` for rows of ``views``."""
        if self.content is None:
            constant = F.lit(self.constant)
            return rows.select("key", constant.alias("p_content"), constant.alias("p_page"), constant.alias("score"))
        content, page = self._calibrated()
        both = rows.select("key", content.alias("a"), page.alias("b"))
        combined = self.combination.logit(F.array("a", "b"))
        return both.select("key", _sigmoid(F.col("a")).alias("p_content"), _sigmoid(F.col("b")).alias("p_page"), _sigmoid(combined).alias("score"))


def _sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def _draw(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1_000_000)) / 1_000_000


def _sample(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """About ``most`` rows chosen by hash of the key, or all if there are no more."""
    count = rows.count()
    return rows if count <= most else rows.filter(_draw(seed) < most / count)


def co_train(
    rows: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    rounds: int = ROUNDS,
    labelled_rows: int = LABELLED_ROWS,
    pool_rows: int | None = None,
) -> CoTrained:
    """Train on rows of ``views`` and 0/1 labels by key; ``pool_rows`` bounds the unlabelled rows, which are all used without it."""
    known = picked(labels, id=key, label=label).filter("id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
    joined = rows.join(known, rows["key"] == known["id"], "left").drop("id")
    labelled = stage(_sample(joined.filter("label IS NOT NULL"), labelled_rows, 1), "labelled")
    held, taught = labelled.filter(_draw(2) < HELD_SHARE), labelled.filter(_draw(2) >= HELD_SHARE)
    by_part = {
        (r.held, r.label): r.n
        for r in labelled.groupBy((_draw(2) < HELD_SHARE).alias("held"), "label").agg(F.count("*").alias("n")).collect()
    }
    good, bad = (sum(n for (_, label_), n in by_part.items() if label_ == x) for x in (1, 0))
    if len(by_part) < 4:  # a class is missing from the training or from the held-out rows
        return CoTrained(constant=good / (good + bad) if good + bad else 0.5)
    pool = joined.filter("label IS NULL").drop("label")
    pool = stage(pool if pool_rows is None else _sample(pool, pool_rows, 3), "pool")

    content, page = _fit(taught, F.col("content")), _fit(taught, F.col("page"))
    for _ in range(rounds):
        scored = pool.select("content", "page", _sigmoid(content.logit(F.col("content"))).alias("a"), _sigmoid(page.logit(F.col("page"))).alias("b"))
        content, page = (
            _fit(taught.select("content", "label").union(_sure(scored, "b", "content")), F.col("content")),
            _fit(taught.select("page", "label").union(_sure(scored, "a", "page")), F.col("page")),
        )
    logits = [F.array(view.logit(F.col(name))) for view, name in ((content, "content"), (page, "page"))]
    calibration = tuple(_fit(held, logit, 1e-4) for logit in logits)
    trained = CoTrained(content, page, calibration)
    a, b = trained._calibrated()
    return CoTrained(content, page, calibration, _fit(held, F.array(a, b), 1e-4))


def _sure(scored: DataFrame, judge: str, view: str) -> DataFrame:
    """Rows of the pool that ``judge`` is sure of, with its label, for the other view to learn from."""
    sure = scored.filter((F.col(judge) >= SURE) | (F.col(judge) <= 1 - SURE))
    return sure.select(view, (F.col(judge) >= SURE).cast("int").alias("label"))


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", keep: float = KEEP, columns: Sequence[str] = ()
) -> DataFrame:
    """``(key, p_content, p_page, score, keep)``; ``columns`` may name text, source, language and size."""
    names = dict(zip(("text", "source", "lang", "size"), columns, strict=False))
    rows = stage(views(docs, key, **names), "views")
    scored = co_train(rows, labels, key, label).score(rows)
    return scored.withColumn("keep", F.col("score") >= keep)
