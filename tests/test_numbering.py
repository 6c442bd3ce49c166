from pyspark.sql import functions as F

from rankflow.operators.numbering import last_wins, last_wins_wide, number_blocks, rank_within, top_within


def skewed(spark, n=3000):
    """One group holds most rows; scores are full of ties."""
    ids = spark.range(n)
    return ids.select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("qid"),
        ((F.col("id") * 7919) % n).alias("pid"),
        ((F.col("id") * 31) % 13).cast("double").alias("score"),
    )


def expected_ranks(df, descending_pid=False):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.qid, []).append((r.score, r.pid))
    ranks = {}
    for qid, members in groups.items():
        members.sort(key=lambda m: m[1], reverse=descending_pid)
        members.sort(key=lambda m: -m[0])
        ranks.update({(qid, pid): at for at, (_, pid) in enumerate(members, 1)})
    return ranks


def test_rank_within_equals_a_sort_for_any_split(spark):
    df = skewed(spark)
    for descending in (False, True):
        order = [("score", False), ("pid", not descending)]
        want = expected_ranks(df, descending)
        for split_rows in (5, 40, 4_000_000):
            ranked = rank_within(df, ["qid"], order, identity=["pid"], split_rows=split_rows)
            assert {(r.qid, r.pid): r["rank"] for r in ranked.collect()} == want


def test_rank_within_does_not_depend_on_partitioning(spark):
    df = skewed(spark, 1000)
    order = [("score", False), ("pid", True)]
    results = [
        sorted(map(tuple, rank_within(df.repartition(n), ["qid"], order, ["pid"], split_rows=20).collect())) for n in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2]


def test_hot_group_is_cut_into_blocks(spark):
    """No block of the cut group comes near the size of the group."""
    from rankflow.operators import numbering

    df = skewed(spark)
    seen = {}
    original = numbering.number_blocks

    def spy(rows, keys, block, order, out, counted=None):
        seen["largest"] = rows.groupBy(*keys, block).count().agg(F.max("count")).first()[0]
        return original(rows, keys, block, order, out, counted)

    numbering.number_blocks = spy
    try:
        rank_within(df, ["qid"], [("score", False), ("pid", True)], ["pid"], split_rows=20)
    finally:
        numbering.number_blocks = original
    assert seen["largest"] < 240  # of 2,400


def test_number_blocks_is_contiguous(spark):
    df = spark.range(0, 1000, 3).withColumn("block", F.floor(F.col("id") / 64))
    for parts in (1, 5):
        out = number_blocks(df.repartition(parts), [], "block", [("id", True)], "at").orderBy("id").collect()
        assert [r["at"] for r in out] == list(range(1, len(out) + 1))


def test_top_within_with_and_without_merge_level(spark):
    df = skewed(spark, 2000)
    order = [("score", False), ("pid", True)]
    want = {k: v for k, v in expected_ranks(df).items() if v <= 25}
    for fanout in (None, 3):
        top = top_within(df.repartition(6), ["qid"], order, 25, fanout=fanout)
        assert {(r.qid, r.pid): r["rank"] for r in top.collect()} == want


def test_top_within_limits_before_the_shuffle(spark):
    plan = top_within(skewed(spark), ["qid"], [("score", False), ("pid", True)], 5)._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") >= 0 and "Partial" in plan


def test_last_wins_keeps_last_value_at_first_position(spark, rows):
    df = spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, "a", None)], "ord long, k string, v double")
    assert rows(last_wins(df.filter("v is not null"), ["k"], ["v"]), "k", "v", "ord") == [("a", 3.0, 0), ("b", 2.0, 1)]
    assert rows(last_wins_wide(df.filter("v is not null"), "k"), "k", "v", "ord") == [("a", 3.0, 0), ("b", 2.0, 1)]
