"""Sharding by balanced label propagation.

Documents with equal texts are linked. Shard counts differ by one at most: a shard's quota is
its even share of the rows. Linked documents start dealt out evenly over the shards. In each
round they want to move to the shard that holds most of their neighbours; flows between two
shards are exchanged as far as they match, and beyond that move into free room, by gain.
Documents without links then fill the quotas up.

Documents of one group in one shard have the same neighbours, so a round moves *cells*
(group, shard, rows): joins and sums over cells instead of documents, at most ``shards``
cells per group however large the group. What comes to the driver are the loads of the
shards and the flows between them. A group's documents take their places from the cells by
their number within the group, counted in ``SALTS`` parts.

Null texts count as empty texts, so they are linked to each other and to empty texts. Null
and repeated keys are rows like others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankflow.llm.blocks import block_count, with_running
from rankflow.llm.common import picked
from rankflow.session import stage

SHARDS = 24
ROUNDS = 16
SALTS = 1024

Flows = dict[tuple[int, int], int]


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def allowed_flows(wanted: Flows, room: list[int]) -> Flows:
    """How many rows may move along each flow: matched exchanges, then shares of the free room."""
    allowed = {(i, j): min(n, wanted.get((j, i), 0)) for (i, j), n in wanted.items()}
    for j, free in enumerate(room):
        left = {ij: wanted[ij] - allowed[ij] for ij in wanted if ij[1] == j}
        total = sum(left.values())
        for ij in sorted(left):  # what rounding leaves goes to the first flows
            share = min(left[ij], -(-free * left[ij] // total) if total else 0)
            share = min(share, free)
            allowed[ij] += share
            free -= share
            total -= left[ij]
    return allowed


def _lookup(values: dict[int, int], at: Column) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.element_at(F.create_map(*pairs), at) if pairs else F.lit(None).cast("bigint")


def _dealt(linked: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Even first cells: the rows of all groups are numbered on and dealt out by turns."""
    block = F.pmod(F.xxhash64("group"), F.lit(blocks))
    numbered = with_running(linked.withColumn("block", block), [], "block", [F.col("group")], "first", F.col("size"))
    turns = F.sequence(F.lit(0), F.least(F.col("size"), F.lit(shards)).cast("int") - 1)
    rows = F.floor((F.col("size") - 1 - F.col("turn")) / shards) + 1
    return numbered.select("group", "size", "first", F.explode(turns).alias("turn")).select(
        "group", F.pmod(F.col("first") + F.col("turn"), F.lit(shards)).cast("int").alias("shard"), rows.cast("bigint").alias("n")
    )


def _round(cells: DataFrame, quota: list[int], turn: int, blocks: int) -> tuple[DataFrame, int]:
    """One round of moves, and the rows that moved. Even rounds look at shards with room only."""
    load = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = [q - load.get(s, 0) for s, q in enumerate(quota)]
    rank = F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")
    open_to = F.col("shard").isin([s for s, free in enumerate(room) if free > 0]) if turn % 2 == 0 else F.lit(True)
    best = stage(cells.groupBy("group").agg(F.max(F.when(open_to, rank)).alias("best")).filter("best IS NOT NULL"), "best")
    wish = cells.join(best, "group", "left")
    target = F.when(F.col("best") > rank, F.col("best")["shard"]).otherwise(F.col("shard"))
    gain = F.col("best")["n"] - F.col("n") + 1
    wish = stage(wish.select("group", "shard", "n", target.alias("to"), gain.alias("gain")), "wishes")
    movers = wish.filter("to <> shard")
    wanted = {(r.shard, r.to): r.n for r in movers.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
    allowed = allowed_flows(wanted, room)
    if not sum(allowed.values()):
        return cells, 0
    limit = _lookup({i * len(quota) + j: n for (i, j), n in allowed.items()}, F.col("shard") * len(quota) + F.col("to"))
    # By gain: blocks go by its power of two first, and rows of a block by the gain itself.
    scale = F.lit(64) - F.floor(F.log2(F.greatest(F.col("gain"), F.lit(1))))
    block = (scale * blocks + F.pmod(F.xxhash64("group"), F.lit(blocks))).cast("bigint")
    order = [F.col("gain").desc(), F.col("group")]
    queued = with_running(movers.withColumn("block", block), ["shard", "to"], "block", order, "ahead", F.col("n"))
    moved = queued.withColumn("go", F.least("n", F.greatest(limit - F.col("ahead"), F.lit(0))))
    after = (
        moved.select("group", F.col("to").alias("shard"), F.col("go").alias("n"))
        .union(moved.select("group", "shard", F.col("n") - F.col("go")))
        .union(wish.filter("to = shard").select("group", "shard", "n"))
    )
    after = after.filter("n > 0").groupBy("group", "shard").agg(F.sum("n").alias("n"))
    return stage(after, "cells"), sum(allowed.values())


def propagated(cells: DataFrame, quota: list[int], rounds: int = ROUNDS, blocks: int = 1) -> DataFrame:
    """``cells`` after rounds of moves, until an even and an odd round have moved nothing."""
    still = 0
    for turn in range(rounds):
        cells, moved = _round(cells, quota, turn, blocks)
        still = 0 if moved else still + 1
        if still == 2:
            break
    return cells


def shard(
    docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, salts: int = SALTS
) -> DataFrame:
    """``(key, size, text_crc32, shard, slot)``, one row per document.

    ``size`` is the UTF-8 bytes of the text plus 8. Shards hold numbers of rows at most one
    apart, and ``slot`` numbers a shard's rows from 0. More rounds than ``rounds`` are not made.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        picked(docs, key=key, text=text).select(
            "key",
            (F.octet_length(body) + 8).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(body.cast("binary"))).alias("group"),
            F.xxhash64("key", F.crc32(body.cast("binary"))).alias("draw"),
        ),
        "shard-rows",
    )
    total = rows.count()
    quota, blocks = quotas(total, shards), block_count(total)
    salted = rows.withColumn("salt", F.pmod("draw", F.lit(salts)).cast("int"))
    counts = stage(salted.groupBy("group", "salt").agg(F.count("*").alias("rows")), "salted")
    linked = stage(counts.groupBy("group").agg(F.sum("rows").alias("size")).filter("size > 1"), "linked")
    cells = propagated(stage(_dealt(linked, shards, blocks), "cells"), quota, rounds, blocks)

    # A group's numbers 0, 1, ... go to its shards in stretches; each salted part starts at a number.
    in_group = W.partitionBy("group").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    stretches = cells.withColumn("from", F.coalesce(F.sum("n").over(in_group), F.lit(0)))
    stretches = stretches.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("from", "shard"))).alias("stretches"))
    by_salt = W.partitionBy("group").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    parts = counts.join(linked.select("group"), "group", "left_semi")
    parts = parts.select("group", "salt", F.coalesce(F.sum("rows").over(by_salt), F.lit(0)).alias("start"))
    parts = stage(parts.join(stretches, "group"), "parts")

    load = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    in_part = W.partitionBy("group", "salt").orderBy("key", "draw")
    placed = salted.join(parts, ["group", "salt"], "left")
    number = F.col("start") + F.row_number().over(in_part) - 1
    own = F.filter("stretches", lambda s: s["from"] <= F.col("number"))
    placed = stage(
        placed.withColumn("number", number).select(
            "key", "size", "text_crc32", "draw", F.when(F.col("number").isNotNull(), F.element_at(own, -1)["shard"]).alias("shard")
        ),
        "placed",
    )
    block = F.pmod("draw", F.lit(blocks))
    alone = placed.filter("shard IS NULL").withColumn("block", block)
    alone = with_running(alone, [], "block", [F.col("draw"), F.col("key")], "number")
    fill, full = F.lit(None).cast("int"), 0
    for s in range(shards):
        full += quota[s] - load.get(s, 0)
        fill = F.coalesce(fill, F.when(F.col("number") < full, F.lit(s)))
    columns = ["key", "size", "text_crc32", "draw", "shard"]
    placed = placed.filter("shard IS NOT NULL").select(*columns).union(alone.withColumn("shard", fill).select(*columns))
    placed = stage(placed, "sharded").withColumn("block", block)
    slots = with_running(placed, ["shard"], "block", [F.col("draw"), F.col("key")], "slot")
    return slots.select("key", "size", "text_crc32", "shard", F.col("slot").cast("bigint").alias("slot"))
