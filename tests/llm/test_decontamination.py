import random
import re

from pyspark.sql import functions as F

from rankflow.llm import decontamination
from rankflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingles(text, n):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def slow_leaks(docs, items):
    found = []
    for item, item_text in items:
        n = min(5, len(re.findall(r"[^\W_]+", (item_text or "").lower())))
        wanted = shingles(item_text, n) if n else set()
        for doc, text in docs:
            held = len(wanted & shingles(text, n)) if wanted else 0
            if wanted and held >= 0.8 * len(wanted) - 1e-9:
                found.append((doc, item, len(wanted), held))
    return sorted(found, key=str)


def made(rng):
    def words(n):
        return [rng.choice("abcdefghijk") + rng.choice("xyz") + str(rng.randrange(30)) for _ in range(n)]

    items = [(i, words(rng.randint(5, 60))) for i in range(40)] + [(50, words(2)), (51, words(4)), (52, [])]
    docs = [(d, words(rng.randint(0, 300))) for d in range(60)]
    for d, text in docs[:45]:
        _, item = rng.choice(items)
        item = list(item)
        for _ in range(rng.randint(0, 3)):
            if item:
                item[rng.randrange(len(item))] = "changed"
        at = rng.randint(0, len(text))
        text[at:at] = item
    docs[50][1][3:3] = items[3][1][:20]  # one item in two places
    docs[50][1].extend(items[3][1][16:])
    docs = [(d, ", ".join(t).upper() if d % 2 else "\n".join(t)) for d, t in docs]
    return [*docs, (70, None), (71, ""), (3, docs[3][1]), (None, docs[4][1])], [*((i, " ".join(t)) for i, t in items), (53, None)]


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("item", F.lit("x"))
    return d, spark.createDataFrame(items, "item_id bigint, text string").withColumn("block", F.lit(2))


def test_leaks_equal_brute_force(spark):
    for seed, block in ((1, decontamination.BLOCK_BYTES), (2, 2000)):
        docs, items = made(random.Random(seed))
        got = decontamination.leaks(*frames(spark, docs, items), block_bytes=block).collect()
        assert sorted(((r.key, r.item, r.n_item, r.n_shared) for r in got), key=str) == slow_leaks(docs, items)


def test_pieces_of_long_texts(spark, monkeypatch):
    import rankflow.llm.common as common

    docs, items = made(random.Random(5))
    block = decontamination.Items.of(items, 0.8)
    whole = [block.contained(t or "") for _, t in docs]
    monkeypatch.setattr(decontamination, "pieces", lambda t: common.pieces(t, 40))
    assert [block.contained(t or "") for _, t in docs] == whole


def test_sketch_cannot_miss():
    for q in range(1, 2000):
        lacking = q - next(n for n in range(q + 1) if n >= 0.8 * q - 1e-9)
        assert decontamination.sketch_size(q) >= min(q, lacking + 1)


def test_without_leaks(spark):
    docs, items = made(random.Random(3))
    d, i = frames(spark, docs, items)
    leaked = {doc for doc, *_ in slow_leaks(docs, items)}
    for block in (decontamination.BLOCK_BYTES, 2000):
        kept = decontamination.without_leaks(d, i, block_bytes=block)
        assert kept.columns == d.columns
        assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(k) for k, _ in docs if k not in leaked)


def test_columns_named_like_results(spark):
    docs, items = [(1, "a b c d e f g"), (2, "u v w x y z")], [(9, "b c d e f g")]
    d, i = frames(spark, docs, items)
    clash = {"n_item": F.lit("x"), "containment": F.lit(-1), "n_shared": F.lit(None), "item": F.lit(5), "item_id": F.lit(6), "key": F.lit("k")}
    d, i = d.withColumns(clash), i.withColumns({"doc_id": F.lit(4), "key": F.lit("k"), "containment": F.lit(0)})
    got = decontamination.leaks(d, i).collect()
    assert [(r.key, r.item, r.n_item, r.n_shared, r.containment) for r in got] == [(1, 9, 2, 2, 1.0)]
    kept = decontamination.without_leaks(d, i)
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == [tuple(d.filter("doc_id = 2").first())]


def test_empty_tables(spark):
    docs, items = frames(spark, [], [])
    full, more = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    assert decontamination.leaks(docs, more).count() == decontamination.leaks(full, items).count() == 0
    assert decontamination.without_leaks(full, items).count() == 1 and decontamination.leaks(full, more).count() == 1


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = QUERIES["op5_benchmark_leaks"](spark, FOLDER).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got), key=str) == slow_leaks(docs, items)
    assert got
