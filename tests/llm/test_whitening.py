import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import whitening

FOLDER = "/root/testdata/sf0.001"


def slow(vectors):
    """Plain numpy on vectors without odd entries: x, centred, eigenvalues, components."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    deviation = [int(((n * row - total) ** 2).sum()) for row in x]
    centred = x.astype(float) - np.array([s / n for s in total], float)
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], columns[:, ::-1]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return made.withColumns({"id": F.lit("x"), "key": F.lit(1), "index": F.lit(2), "values": F.lit(None).cast("int"), "x": F.lit("y")})


def compare(found, keys, vectors):
    deviation, centred, values, columns = slow(vectors)
    assert found.n == len(vectors) and np.allclose(found.eigenvalues, values, rtol=1e-9, atol=1e-9 * values[0])
    got = {r.key: r for r in found.rows.collect()}
    assert set(got) == set(keys) and len(got) == found.n
    kept = found.components.shape[1]
    signs = np.sign((found.components * columns[:, :kept]).sum(axis=0))
    expected = centred @ columns[:, :kept] / np.sqrt(values[:kept]) * signs
    for i, key in enumerate(keys):
        assert int(got[key].deviation) == deviation[i]
        assert np.allclose(got[key].whitened, expected[i], atol=1e-6)
    assert found.identity_error < 1e-6
    assert np.allclose(found.explained, values[:kept] / values.sum())


@pytest.mark.parametrize("stretch", [1 << 22, 700])
def test_equals_plain_computation(spark, stretch):
    draw = np.random.default_rng(3)
    vectors = (draw.normal(size=(3000, 12)) * np.linspace(3, 0.2, 12) + draw.normal(size=12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(-1, None), (-2, [1.0, None, *[0.0] * 10]), (-3, [float("nan")] * 12), (-4, [float("inf"), *[0.0] * 11]), (-5, [2.0**41] * 12), (-6, []), (-7, [1.0] * 5)]
    found = whitening.whiten(frame(spark, rows + odd).repartition(9), stretch_rows=stretch)
    compare(found, [i for i, _ in rows], vectors)


def test_repeated_rows_null_keys_and_few_dimensions(spark):
    rows = [(None, [1.0, 2.0, 3.0])] * 5 + [(1, [2.0, 1.0, 3.0]), (1, [0.0, 1.0, 3.0])]
    found = whitening.whiten(frame(spark, rows))
    got = found.rows.collect()
    assert len(got) == 7 and sum(r.key is None for r in got) == 5
    assert all(r.whitened[2] is None and r.whitened[0] is not None for r in got)  # the last dimension is constant
    deviation = slow([v for _, v in rows])[0]
    assert sorted(int(r.deviation) for r in got) == sorted(deviation)
    assert found.identity_error < 1e-9


def test_equal_vectors_and_empty_tables(spark):
    found = whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(4)]))
    assert all(r.whitened == [None, None] and r.deviation == 0 for r in found.rows.collect())
    assert found.identity_error == 0 and list(found.explained) == [0, 0]
    assert whitening.whiten(frame(spark, [])) is None
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])) is None


def test_query(spark):
    from rankflow.llm.queries import QUERIES

    source = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = [r.embedding for r in source]
    deviation, centred, values, columns = slow(vectors)
    got = {}
    for r in QUERIES["op12_embedding_whitening"](spark, FOLDER).collect():
        got[r.vec_id, r.component] = r
    assert len(got) == 8 * len(source)
    for k in range(8):
        expected = centred @ columns[:, k] / np.sqrt(values[k])
        own = np.array([got[r.vec_id, k + 1].whitened for r in source])
        assert np.allclose(own * np.sign(own @ expected), expected, atol=1e-6)
        one = got[source[0].vec_id, k + 1]
        assert one.n == len(source) and one.identity_error < 1e-6
        assert abs(one.explained - values[k] / values.sum()) < 1e-9
    assert all(got[r.vec_id, 1].deviation == d for r, d in zip(source, deviation, strict=True))
