import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import linededup

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def slow(docs):
    """``{(id, text): (n_lines, n_dropped, kept)}`` by the definition; null ids come last."""
    held = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                held.setdefault(key_of(line), set()).add((doc is None, doc or 0))
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        own = (doc is None, doc or 0)
        kept = [x for x in lines if key_of(x) not in held or min(held[key_of(x)]) == own]
        out[doc, text or ""] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def corpus(rng, n=60, first=0):
    lines = ["short", "", "  A line of TEN chars\t", "a line of ten chars", "É accents count É", "é accents count é", "123456789", "1234567890"]
    lines += [f"line number {k} of many" for k in range(20)]
    return [(first + d, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for d in range(n)]


def frame(spark, docs):
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    return rows.withColumns({"line": F.lit("x"), "n": F.lit(1), "row": F.lit(None).cast("int"), "first": F.lit(2), "lines": F.lit("y")})


@pytest.mark.parametrize("n", [1000, 200_000, 250_000])
def test_filter_has_no_false_negatives_and_forgets(n):
    hashes = np.random.default_rng(n).integers(-(1 << 63), 1 << 63, 2 * n, dtype=np.int64)
    filter_ = linededup.CuckooFilter()
    filter_.add(hashes[:n])
    again = linededup.CuckooFilter(filter_.table.tobytes(), filter_.stash)
    assert again.holds(hashes[:n]).all()
    assert again.holds(hashes[n:]).mean() < 0.001
    again.remove(hashes[: n // 2][:5000])
    assert again.holds(hashes[5000:n] if n > 10_000 else hashes[n // 2 : n]).all()
    assert (again.table != 0).sum() + len(again.stash) == n - min(5000, n // 2)


def test_filter_keeps_what_finds_no_slot():
    hashes = np.full(20, (7 << 48) + (9 << 24), np.int64)
    filter_ = linededup.CuckooFilter()
    filter_.add(hashes)
    assert len(filter_.stash) == 12 and filter_.holds(hashes).all()
    for left in range(20, 0, -1):
        assert filter_.holds(hashes[:1])[0]
        filter_.remove(hashes[:1])
    assert not filter_.holds(hashes[:1])[0] and not filter_.stash


@pytest.mark.parametrize("batches", [1, 3])
def test_equals_definition(spark, rng, batches):
    docs = [*corpus(rng), (None, "a line of ten chars\nonly the null id has this"), (None, "1234567890"), (70, None), (71, ""), (72, "\n\n"), (3, "a line of ten chars")]
    docs += [(80, "again and again\nagain and again\nagain and again")] * 3 + [(81, "again and again\nlast")]
    rows = frame(spark, docs)
    index = linededup.indexed(rows, batches=batches)
    expected = slow(docs)
    got = [(r.key, r.n_lines, r.n_dropped, r.text) for r in linededup.clean(index, rows).collect()]
    assert sorted(got, key=str) == sorted([(d, *expected[d, t or ""]) for d, t in docs], key=str)


def test_inserting_and_deleting_is_reversible(spark, rng, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_LINES", 8)  # several shards, which double on the way
    parts = [corpus(rng, 25, 100 * k) for k in range(3)]
    index = linededup.empty(spark)
    for part in parts:
        index = linededup.insert(index, frame(spark, part))
    assert index.shards > 1
    before = index
    gone = [d for d, _ in parts[0]] + [d for d, _ in parts[2][::2]]
    index = linededup.delete(index, spark.createDataFrame([(d,) for d in [*gone, 12345]], "doc_id bigint"))
    left = [row for part in parts for row in part if row[0] not in set(gone)]
    assert _all(index, spark, left) == slow(left)
    index = linededup.insert(index, frame(spark, parts[0]))
    left += parts[0]
    assert _all(index, spark, left) == slow(left)
    everything = [row for part in parts for row in part]
    assert _all(before, spark, everything) == slow(everything)  # the earlier index still stands
    index = linededup.delete(index, spark.createDataFrame([(d,) for d, _ in left], "doc_id bigint"))
    assert index.repeated.count() == 0
    assert all(not np.frombuffer(r.slots, np.uint16).any() and not r.stash for r in index.filters.collect())


def _all(index, spark, docs):
    texts = dict(docs)
    return {(r.key, texts[r.key]): (r.n_lines, r.n_dropped, r.text) for r in linededup.clean(index, frame(spark, docs)).collect()}


def test_only_positives_meet_the_exact_table(spark, rng):
    index = linededup.insert(linededup.empty(spark), frame(spark, corpus(rng)))
    hashes = spark.range(5000).select(F.xxhash64(F.col("id").cast("string")).alias("hash"))
    assert linededup.probe(index.filters, hashes, index.shards).count() < 10


def test_one_line_in_every_document_and_a_long_text(spark):
    docs = [(d, f"the very same line\nown line number {d}") for d in range(500)] + [(900, "\n".join(["the very same line"] * 30_000 + ["end of this text"]))]
    rows = frame(spark, docs)
    got = {r.key: r for r in linededup.clean(linededup.indexed(rows), rows).collect()}
    assert got[0].n_dropped == 0 and all(got[d].text == f"own line number {d}" for d in range(1, 500))
    assert got[900].n_dropped == 30_000 and got[900].text == "end of this text"


def test_text_ids_and_empty_table(spark):
    rows = spark.createDataFrame([("b", "the same line here"), ("a", "The same LINE here ")], "doc_id string, text string")
    assert {r.key: r.n_dropped for r in linededup.clean(linededup.indexed(rows), rows).collect()} == {"a": 0, "b": 1}
    none = rows.limit(0)
    assert linededup.clean(linededup.indexed(none), none).collect() == []


def test_query(spark):
    from rankflow.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected, texts = slow(docs), dict(docs)
    got = QUERIES["op13_line_dedup"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        lines, dropped, kept = expected[r.doc_id, texts[r.doc_id] or ""]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(kept.encode()).hexdigest())
