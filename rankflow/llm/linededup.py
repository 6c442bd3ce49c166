"""Reversible line dedup: sharded cuckoo filters in front of exact reference tables.

A line's key is the line without blanks at its ends, A-Z in lower case. Keys of ``LEAST_CHARS``
code points or more that two documents or more hold keep their lines in the smallest document
only. An index takes in documents batch by batch and lets them go again:

* ``refs``, the exact table, has signed rows (line digest, document, n): a deletion adds what
  brings a document's references to zero. Nothing is ever rewritten.
* ``filters`` has one cuckoo filter per shard of the digests that are in use. A batch probes them;
  only its positives meet the exact table, so a batch costs what it holds, not what the index holds.
* ``repeated`` has the lines of two documents or more and the document that keeps them.

Every index is a new value over stored tables, and the earlier one stays usable.

A null text is one empty line. Null ids are one document, which comes after all others. Rows of
one id are one document; equal rows get equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import stage

BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS = 10
BATCHES = 2

BUCKETS, SLOTS = 1 << 16, 4
SHARD_LINES = 160_000
"""A shard's filter holds that many on average, three fifths of its slots."""
KICKS = 500
FILTER = "shard int, slots binary, stash array<bigint>"


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; what finds no place is kept in a stash."""

    def __init__(self, slots: bytes | None = None, stash: list[int] | None = None):
        held = np.zeros(BUCKETS * SLOTS, np.uint16) if slots is None else np.frombuffer(slots, np.uint16).copy()
        self.table = held.reshape(BUCKETS, SLOTS)
        self.stash = [int(code) for code in stash] if stash is not None else []

    @staticmethod
    def _jump(print_: np.ndarray) -> np.ndarray:
        """From one of a fingerprint's buckets to the other, by exclusive or."""
        return (print_.astype(np.int64) * 0x5BD1E995 >> 7) & (BUCKETS - 1)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets. The lowest 24 bits of a hash name its shard."""
        bits = hashes.astype(np.int64).view(np.uint64)
        print_ = np.maximum(bits >> np.uint64(48), 1).astype(np.uint16)
        first = (bits >> np.uint64(24)).astype(np.int64) & (BUCKETS - 1)
        return print_, first, first ^ self._jump(print_)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been added; false for sure."""
        print_, first, second = self._places(hashes)
        found = (self.table[first] == print_[:, None]).any(axis=1) | (self.table[second] == print_[:, None]).any(axis=1)
        if self.stash:
            found |= np.isin(first << 16 | print_, self.stash) | np.isin(second << 16 | print_, self.stash)
        return found

    def _fill(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; which ones found one."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        turn = np.arange(len(at)) - np.searchsorted(at, at)
        taken = self.table[at] != 0
        fits = turn < SLOTS - taken.sum(axis=1)
        slot = np.argsort(taken[fits], axis=1, kind="stable")[np.arange(fits.sum()), turn[fits]]
        self.table[at[fits], slot] = print_[order][fits]
        placed = np.zeros(len(at), bool)
        placed[order[fits]] = True
        return placed

    def add(self, hashes: np.ndarray) -> None:
        """Add each hash once more."""
        print_, first, second = self._places(hashes)
        left = ~self._fill(print_, first)
        print_, second = print_[left], second[left]
        left = ~self._fill(print_, second)
        for own, at in zip(print_[left], second[left].tolist(), strict=True):
            self._push(own, at)

    def _push(self, own: np.uint16, at: int) -> None:
        """Push fingerprints on to their other buckets until one finds a free slot."""
        for kick in range(KICKS):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = own
                return
            slot = kick % SLOTS
            own, self.table[at, slot] = self.table[at, slot], own
            at ^= int(self._jump(own))
        self.stash.append(at << 16 | int(own))

    def remove(self, hashes: np.ndarray) -> None:
        """Take each hash, which must have been added, out once."""
        for own, *buckets in zip(*self._places(hashes), strict=True):
            for at in buckets:
                found = np.flatnonzero(self.table[at] == own)
                if len(found):
                    self.table[at, found[0]] = 0
                    break
            else:
                self.stash.remove(next(c for c in (int(at) << 16 | int(own) for at in buckets) if c in self.stash))


@dataclass(frozen=True)
class LineIndex:
    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    lines: int
    """How many lines have been added, those that are gone again included."""


def empty(spark: SparkSession, kind: str = "bigint") -> LineIndex:
    """An index without documents, for ids of type ``kind``."""
    refs = spark.createDataFrame([], f"line binary, doc {kind}, n bigint")
    repeated = spark.createDataFrame([], f"line binary, first {kind}")
    return LineIndex(refs, repeated, spark.createDataFrame([], FILTER), 1, 0)


def _keys(body: Column) -> Column:
    """Keys of the lines of a text, null for those too short."""
    trimmed = lambda line: F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)
    long = lambda key: F.when(F.char_length(key) >= LEAST_CHARS, F.unhex(F.md5(key.cast("binary"))))
    return F.transform(F.transform(F.split(body, "\n", -1), trimmed), long)


def _body(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def references(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(line, doc, n)``: each line of each row once, with its document."""
    lines = F.array_distinct(F.filter(_keys(_body()), lambda k: k.isNotNull()))
    return picked(docs, doc=key, text=text).select(F.explode(lines).alias("line"), "doc", F.lit(1).cast("bigint").alias("n"))


def _live(refs: DataFrame) -> DataFrame:
    return refs.groupBy("line", "doc").agg(F.sum("n").alias("n")).filter("n > 0")


def _holders(refs: DataFrame) -> DataFrame:
    """``(line, first, last, lost)``: who holds a line, without a list of them."""
    return refs.groupBy("line").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.bool_or(F.col("doc").isNull()).alias("lost"))


def _repeated(holders: DataFrame) -> DataFrame:
    several = (F.col("first") < F.col("last")) | (F.col("lost") & F.col("first").isNotNull())
    return holders.filter(several).select("line", "first")


def _hashed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("hash", F.xxhash64("line"))


def _dealt(hashes: DataFrame, shards: int) -> DataFrame:
    return hashes.select("hash", F.col("hash").bitwiseAND(F.lit(shards - 1).cast("bigint")).cast("int").alias("shard")).distinct()


def _opened(frame: pd.DataFrame) -> CuckooFilter:
    return CuckooFilter(frame["slots"].iloc[0], frame["stash"].iloc[0]) if len(frame) else CuckooFilter()


def probe(filters: DataFrame, hashes: DataFrame, shards: int) -> DataFrame:
    """The distinct hashes that the filters may hold."""

    def run(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = _opened(own).holds(asked["hash"].to_numpy(np.int64)) if len(own) else np.zeros(len(asked), bool)
        return asked.loc[found, ["hash"]]

    return _dealt(hashes, shards).groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(run, "hash bigint")


def changed(filters: DataFrame, hashes: DataFrame, shards: int, remove: bool = False) -> DataFrame:
    """The filters with the distinct hashes added or removed, stored."""

    def run(shard: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        held = _opened(own)
        (held.remove if remove else held.add)(asked["hash"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [shard[0]], "slots": [held.table.tobytes()], "stash": [held.stash]})

    return stage(_dealt(hashes, shards).groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(run, FILTER), "filters")


def shards_for(lines: int) -> int:
    shards = 1
    while lines > shards * SHARD_LINES:
        shards *= 2
    return shards


def _with_room(index: LineIndex, lines: int) -> LineIndex:
    """The index with filters for so many more lines; made anew from the exact table when shards double."""
    total = index.lines + lines
    shards = shards_for(total)
    if shards == index.shards or not index.lines:
        return replace(index, shards=max(shards, index.shards), lines=total)
    in_use = _hashed(_live(index.refs).select("line"))
    none = index.refs.sparkSession.createDataFrame([], FILTER)
    return replace(index, filters=changed(none, in_use, shards), shards=shards, lines=total)


def insert(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
    """The index with these documents as well. Further rows of a known id add to that document."""
    added = stage(references(docs, key, text), "line-refs")
    lines = stage(_hashed(_holders(added)), "lines")
    known_before = index.lines > 0
    index = _with_room(index, lines.count())
    new = lines
    if known_before:
        maybe = stage(probe(index.filters, lines, index.shards), "positives")
        asked = lines.join(maybe, "hash", "left_semi").select("line")
        known = stage(_holders(_live(index.refs.join(asked, "line", "left_semi"))), "known")
        # Of two lines of equal hash one may be known and the other not: the hash is in the filter then.
        new = lines.join(_hashed(known).select("hash"), "hash", "left_anti")
        old = known.select("line", *[F.col(c).alias(f"old_{c}") for c in ("first", "last", "lost")])
        lines = lines.join(old, "line", "left").select(
            "line",
            F.least("first", "old_first").alias("first"),
            F.greatest("last", "old_last").alias("last"),
            (F.col("lost") | F.coalesce("old_lost", F.lit(False))).alias("lost"),
        )
    settled = stage(_repeated(lines), "settled")
    repeated = stage(index.repeated.join(settled, "line", "left_anti").union(settled), "repeated") if known_before else settled
    return replace(index, refs=index.refs.union(added), repeated=repeated, filters=changed(index.filters, new, index.shards))


def delete(index: LineIndex, ids: DataFrame, key: str = "doc_id") -> LineIndex:
    """The index without the documents of these ids; ids that it does not hold change nothing."""
    out = ids.select(F.col(key).alias("id")).distinct()
    gone = stage(_live(index.refs.join(out, F.col("doc").eqNullSafe(F.col("id")), "left_semi")), "gone")
    refs = index.refs.union(gone.select("line", "doc", -F.col("n")))
    lines = stage(_hashed(gone.select("line").distinct()), "gone-lines")
    same_hash = _hashed(refs).join(lines.select("hash").distinct(), "hash", "left_semi")
    left = stage(_holders(_live(same_hash)), "left")
    dead = lines.join(_hashed(left).select("hash"), "hash", "left_anti")
    still = _repeated(left.join(lines, "line", "left_semi"))
    repeated = stage(index.repeated.join(lines, "line", "left_anti").union(still), "repeated")
    return replace(index, refs=refs, repeated=repeated, filters=changed(index.filters, dead, index.shards, remove=True))


def indexed(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> LineIndex:
    """An index of all documents, taken in batch by batch; how they are dealt changes no result."""
    index = empty(docs.sparkSession, docs.schema[key].dataType.simpleString())
    turn = F.pmod(F.xxhash64(key), F.lit(batches))
    for batch in range(batches):
        index = insert(index, docs.filter(turn == batch), key, text)
    return index


def clean(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_lines, n_dropped, text)``: documents of the index without the lines that others keep."""
    rows = picked(docs, doc=key, text=text).withColumn("text", _body())
    rows = rows.withColumn("row", F.unhex(F.md5(F.concat_ws(":", F.col("doc").isNull().cast("string"), F.col("doc").cast("string"), "text"))))
    held = rows.select("row", "doc", F.posexplode(_keys(F.col("text"))).alias("at", "line")).filter("line IS NOT NULL")
    elsewhere = held.join(index.repeated, "line").filter(~F.col("doc").eqNullSafe(F.col("first")))
    drops = stage(elsewhere.groupBy("row").agg(F.collect_set("at").alias("drop")), "drops")
    lines = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    left = F.array_join(F.transform(places, lambda at: F.get(F.col("lines"), at)), "\n")
    joined = rows.join(drops, "row", "left").withColumn("lines", lines)
    return joined.select(
        F.col("doc").alias("key"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(left).alias("text"),
    )
