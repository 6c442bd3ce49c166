"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are linked when at most four bits differ. The bits are cut into
segments with a radius each, chosen so that a linked pair must agree in some segment up to
its radius: were every segment off by more than its radius, the pair would differ in more
than four bits. Each fingerprint enters its segments' tables and probes the small Hamming
ball around each segment; fetched matches are checked on all 64 bits.

Null texts count as empty, and empty texts have fingerprint zero. Copies collapse into one
fingerprint before the search. Null ids are passed over when a component is named; a
component without any id has a null name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rankflow.llm.common import map_batches, one_of_each, picked, texts_of
from rankflow.llm.components import components
from rankflow.session import stage

Segments = tuple[tuple[int, int, int], ...]

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Segments as (lowest bit, bits, radius). Larger segments have emptier buckets and more probes.
FINE = ((42, 22, 1), (20, 22, 1), (0, 20, 0))
COARSE = ((32, 32, 2), (0, 32, 1))
MOST_FINE = 1 << 24
"""Up to so many fingerprints ``FINE`` segments are used; the links are the same."""
CROWD = 4096
"""Buckets of more fingerprints than this are linked through midpoints instead of in one task."""

_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_HASHES = 1 << 16


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of the text's word shingles, repeats included."""
    line = text.encode().lower().translate(_BLANKS).strip(b" ")
    while b"  " in line:
        line = line.replace(b"  ", b" ")
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(line)]))
    if len(starts) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES):
        spans = zip(starts[at : at + _HASHES].tolist(), ends[at : at + _HASHES].tolist(), strict=True)
        hashes = np.array([digest(line[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(set_bits * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, print)``; the print as a signed 64-bit number."""
    rows = picked(docs, key=key, text=text)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.fromiter((fingerprint(t) for t in texts_of(batch)), np.uint64, batch.num_rows)
        return pa.record_batch([batch.column("key"), pa.array(prints.view(np.int64))], ["key", "print"])

    return map_batches(rows, run, f"key {kind}, print bigint")


def _bits(n: int, low: int = 0) -> Column:
    """``n`` set bits above ``low`` unset ones."""
    return F.lit(_signed(((1 << n) - 1) << low)).cast("bigint")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _masks(bits: list[int], radius: int) -> list[list[int]]:
    """By weight: all masks of up to ``radius`` of the ``bits``."""
    return [[sum(1 << b for b in some) for some in combinations(bits, weight)] for weight in range(radius + 1)]


def _entries(prints: DataFrame, segments: Segments) -> DataFrame:
    """``(bucket, print, off)``: each print in its own buckets and, ``off`` bits off, in the balls around.

    Of two values the smaller one probes the greater one's bucket; that is enough to meet.
    """
    kinds = []
    for i, (low, bits, radius) in enumerate(segments):
        value = F.shiftrightunsigned("print", low).bitwiseAND(_bits(bits)).bitwiseOR(F.lit(i << 32).cast("bigint"))
        for off, masks in enumerate(_masks(range(bits), radius)):
            kinds.append(_ball(value, off, masks))
    return prints.select("print", F.explode(F.concat(*kinds)).alias("e")).select("e.bucket", "print", "e.off")


def _ball(value: Column, off: int, masks: list[int]) -> Column:
    near = F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda mask: value.bitwiseXOR(mask))
    return F.transform(F.filter(near, lambda v: v >= value), lambda v: F.struct(v.alias("bucket"), F.lit(off).alias("off")))


def _forest(prints: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what links connect, one less than members at most."""
    left = np.arange(len(prints))
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= DISTANCE
            for other in left[near]:
                yield at, other
            todo.extend(left[near].tolist())
            left = left[~near]


def _linked_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in, edges out; the last bucket of a batch waits for the next batch."""

    def edges(bucket: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        size = np.diff(np.concatenate((first, [len(bucket)])))
        twos = first[size == 2]
        near = np.bitwise_count(prints[twos] ^ prints[twos + 1]) <= DISTANCE
        a, b = [prints[twos[near]]], [prints[twos[near] + 1]]
        for start, n in zip(first[size > 2], size[size > 2], strict=True):
            group = prints[start : start + n]
            found = np.array(list(_forest(group)), np.int64).reshape(-1, 2)
            a.append(group[found[:, 0]])
            b.append(group[found[:, 1]])
        ends = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
        return pa.record_batch(ends, ["a", "b"])

    held_bucket, held_print = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        bucket = np.concatenate((held_bucket, batch.column("bucket").to_numpy()))
        prints = np.concatenate((held_print, batch.column("print").to_numpy().view(np.uint64)))
        if not len(bucket):
            continue
        cut = int(np.searchsorted(bucket, bucket[-1]))
        held_bucket, held_print = bucket[cut:], prints[cut:]
        if cut:
            yield edges(bucket[:cut], prints[:cut])
    if len(held_bucket):
        yield edges(held_bucket, held_print)


def _linked_by_midpoints(crowded: DataFrame, segments: Segments) -> DataFrame:
    """Edges inside crowded buckets, linear in their members.

    Members that are ``off`` bits off in the segment step to all points within two bits less
    ``off`` in the other bits. Two prints that share a point differ in at most four bits in
    all, and every linked pair of the bucket shares one, halfway between. A point is shared
    by some two thousand prints at most.
    """
    steps = []
    for i, (low, bits, radius) in enumerate(segments):
        rest = [b for b in range(64) if not low <= b < low + bits]
        by_weight = _masks(rest, DISTANCE // 2)
        steps += [(i, off, _signed(m)) for off in range(radius + 1) for masks in by_weight[: DISTANCE // 2 + 1 - off] for m in masks]
    steps = F.broadcast(crowded.sparkSession.createDataFrame(steps, "segment int, off int, mask bigint"))
    keep = F.lit(None).cast("bigint")
    for i, (low, bits, _) in enumerate(segments):
        keep = F.when(F.col("segment") == i, F.bitwise_not(_bits(bits, low))).otherwise(keep)
    points = (
        crowded.withColumn("segment", F.shiftright("bucket", 32).cast("int"))
        .join(steps, ["segment", "off"])
        .withColumn("point", F.col("print").bitwiseAND(keep).bitwiseXOR(F.col("mask")))
    )
    lowest = F.min("print").over(W.partitionBy("bucket", "point"))
    return points.select(F.col("print").alias("a"), lowest.alias("b")).filter("a <> b")


def links(prints: DataFrame, crowd: int = CROWD, segments: Segments | None = None) -> DataFrame:
    """Edges ``(a, b)`` that connect distinct ``print`` values at most four bits apart.

    Not all links: within a bucket, no more edges than members, but none is needed further
    to connect what links connect.
    """
    if segments is None:
        segments = FINE if prints.count() <= MOST_FINE else COARSE
    entries = _entries(prints, segments)
    busy = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("off").alias("least")).filter("n > 1 AND least = 0")
    members = stage(entries.join(stage(busy.select("bucket", "n"), "buckets"), "bucket"), "members")
    small = members.filter(F.col("n") <= crowd).select("bucket", "print")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.repartition(parts, "bucket").sortWithinPartitions("bucket")
    edges = dealt.mapInArrow(_linked_in_buckets, "a bigint, b bigint")
    crowded = members.filter(F.col("n") > crowd).select("bucket", "print", "off")
    return edges.union(_linked_by_midpoints(crowded, segments))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``(key, print, component)`` per row; ``component`` is the smallest key that links reach."""
    rows = stage(fingerprints(docs, key, text), "prints")
    prints = stage(rows.groupBy("print").agg(F.min("key").alias("first")), "firsts")
    label = components(links(prints.select("print"), crowd))
    named = prints.join(label, prints["print"] == label["node"], "left").withColumn(
        "label", F.coalesce("label", "print")
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("component"))
    component = stage(named.join(smallest, "label").select("print", "component"), "components")
    return rows.join(component, "print").select("key", "print", "component")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One document of each component, the one with the smallest key, with all its columns.

    Keys name documents: of rows that repeat a key the first by digest stands for all, and
    rows without a key, which no component can name, all stay.
    """
    found = stage(near_duplicates(docs, key, text, crowd), "found")
    per_key = found.filter("key IS NOT NULL").groupBy("key")
    per_key = per_key.agg(F.max(F.col("component") == F.col("key")).alias("stays"), F.count("*").alias("n"))
    names = stage(per_key.filter("n > 1 OR NOT stays").select(F.col("key").alias("_key"), "stays"), "names")
    gone, repeated = names.filter("NOT stays").select("_key"), names.filter("stays").select("_key")
    kept = docs.join(gone, docs[key] == gone["_key"], "left_anti")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, kept[key] == repeated["_key"], "left_anti")
    first = F.row_number().over(W.partitionBy(key).orderBy("_digest"))
    again = kept.join(repeated, kept[key] == repeated["_key"], "left_semi").withColumn("_digest", one_of_each(docs.columns))
    return once.union(again.withColumn("_first", first).filter("_first = 1").drop("_digest", "_first"))
