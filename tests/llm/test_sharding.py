import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rankflow.llm import sharding
from rankflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def checked(rows, texts, shards):
    """Even counts, gapless slots, right sizes; how many groups each shard count holds."""
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(texts)
    assert all(0 <= s < shards for s in counts)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    want = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r.key, r.size, r.text_crc32) for r in rows) == want


def spread(rows, quota):
    """Cut edges beyond those that no placement can avoid, per group of equal texts."""
    groups = {}
    for r in rows:
        groups.setdefault((r.size, r.text_crc32), Counter())[r.shard] += 1
    return [(sum(g.values()), len(g)) for g in groups.values() if sum(g.values()) > 1]


def test_groups_stay_together(spark, rng):
    texts = [(i, f"alone {i} é") for i in range(400)]
    texts += [(1000 + 50 * g + i, f"copied {g}") for g in range(20) for i in range(rng.randint(2, 9))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("shard", F.lit("x")).withColumn("size", F.lit(0))
    rows = sharding.shard(docs, shards=6).collect()
    checked(rows, texts, 6)
    assert all(held == 1 for _, held in spread(rows, None))


def test_hot_group_fills_whole_shards(spark):
    texts = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(300)] + [(5000 + i, f"u{i // 3}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = sharding.shard(docs, shards=9, salts=4).collect()
    checked(rows, texts, 9)
    hot = Counter(r.shard for r in rows if r.key < 1000)
    assert sum(sorted(hot.values(), reverse=True)[:4]) > 270  # three shards could hold it alone
    cut = [held for size, held in spread(rows, None) if size == 3]
    assert sum(held == 1 for held in cut) > 0.9 * len(cut)


def test_all_rows_linked(spark, rng):
    texts = [(i, f"g{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    first = sharding.shard(docs, shards=5, rounds=0).collect()
    rows = sharding.shard(docs, shards=5).collect()
    checked(first, texts, 5)
    checked(rows, texts, 5)
    inside = lambda found: sum(n * n for n in Counter((r.text_crc32, r.shard) for r in found).values())
    assert inside(rows) > 3 * inside(first)


def test_edges(spark):
    texts = [(None, None), (None, ""), (1, "a"), (1, "a"), (1, "b"), (2, "x" * 100_000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = sharding.shard(docs, shards=4).collect()
    checked(rows, texts, 4)
    assert sharding.shard(docs.limit(0), shards=4).collect() == []


def test_flows_fit_quotas():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(2, 6)
        wanted = {(i, j): rng.randint(1, 30) for i in range(n) for j in range(n) if i != j and rng.random() < 0.7}
        room = [rng.choice([0, rng.randint(0, 40)]) for _ in range(n)]
        allowed = sharding.allowed_flows(wanted, room)
        for s in range(n):
            gained = sum(k for (i, j), k in allowed.items() if j == s) - sum(k for (i, j), k in allowed.items() if i == s)
            assert gained <= room[s]
        assert all(0 <= allowed[ij] <= wanted[ij] for ij in wanted)
        for j in range(n):
            left = sum(wanted[ij] - allowed[ij] for ij in wanted if ij[1] == j)
            used = sum(allowed[ij] - min(wanted[ij], wanted.get(ij[::-1], 0)) for ij in wanted if ij[1] == j)
            assert left == 0 or used == room[j]


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = QUERIES["op1_text_shards"](spark, FOLDER).withColumnRenamed("doc_id", "key").collect()
    checked(rows, texts, 24)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert all(held == 1 for size, held in spread(rows, None) if size < 8)
