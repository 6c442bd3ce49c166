"""Benchmark decontamination by MinHash containment search, partitioned by item size.

A test item leaks into a document that holds at least ``share`` of its distinct word
shingles. Jaccard similarity says nothing here: a short item inside a long document has
almost none. So only the short side is sketched. Items fall into classes by the number q of
their shingles, and each item keeps the k smallest shingle hashes, k set per class as the
most shingles that a leaked item of the class may lack, plus one. A document that holds
enough of an item's shingles then holds at least one of its sketch: the search loses
nothing. Every shingle of every document is looked up in the sketches, and the items hit
are verified by counting exact shingles. Texts are never cut short and never shuffled.

Words are runs of letters and digits in lower case. Items of fewer than five words are one
shingle of all their words; items without a word leak nowhere. Null texts are empty. Repeated
documents and items each give their own pairs. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import map_batches, picked, pieces, texts_of
from rankflow.session import stage

SHINGLE = 5
SHARE = 0.8
BLOCK_BYTES = 16 << 20
"""Items go to the tasks in blocks of about so many bytes of text, one pass over the documents each."""

_WORD = re.compile(r"[^\W_]+")
_KNOWN_WORDS = 200_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


class _Hashes(dict):
    """Hash of each word met, emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def _forget() -> None:
    _hashes.clear()


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of ``length`` words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(length):
        mixed += hashes[i : i + n] * _FACTORS[i]
    return mixed ^ (mixed >> np.uint64(29))


def windows(words: list[str], length: int) -> Iterator[tuple[str, ...]]:
    return zip(*(words[i:] for i in range(length)), strict=False)


def sketch_size(q: int, share: float = SHARE) -> int:
    """Hashes to keep of an item with ``q`` shingles, as for the largest item of its size class."""
    largest = (1 << q.bit_length()) - 1
    return min(q, largest - math.ceil(share * largest - 1e-9) + 1)


@dataclass
class Items:
    """A block of test items, ready for lookup."""

    share: float
    ids: list = field(default_factory=list)
    shingles: list[frozenset] = field(default_factory=list)
    sketches: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    """By shingle length: sorted sketch hashes, and the item of each."""

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]], share: float) -> Items:
        items = cls(share)
        found: dict[int, list] = defaultdict(list)
        for item, text in rows:
            words = words_of(text or "")
            length = min(SHINGLE, len(words))
            if not length:
                continue
            items.ids.append(item)
            items.shingles.append(frozenset(windows(words, length)))
            hashes = np.unique(shingle_hashes(word_hashes(words), length))
            found[length] += [(h, len(items.ids) - 1) for h in hashes[: sketch_size(len(hashes), share)]]
        for length, pairs in found.items():
            pairs.sort()
            items.sketches[length] = np.array([h for h, _ in pairs], np.uint64), np.array([i for _, i in pairs])
        return items

    def candidates(self, text: str) -> set[int]:
        """Items of whose sketch the text holds a hash."""
        hit: set[int] = set()
        longest = max(self.sketches, default=1)
        tail = np.empty(0, np.uint64)
        for piece in pieces(text):
            hashes = np.concatenate((tail, word_hashes(words_of(piece))))
            tail = hashes[len(hashes) - longest + 1 :] if longest > 1 else tail
            for length, (sketch, items) in self.sketches.items():
                mine = shingle_hashes(hashes, length)
                at = np.searchsorted(sketch, mine)
                mine = np.unique(mine[sketch[np.minimum(at, len(sketch) - 1)] == mine])
                for first, last in zip(np.searchsorted(sketch, mine), np.searchsorted(sketch, mine, "right"), strict=True):
                    hit.update(items[first:last].tolist())
        return hit

    def contained(self, text: str) -> list[tuple[object, int, int]]:
        """``(item, its shingles, those the text holds)`` for each leaked item."""
        candidates = self.candidates(text)
        if not candidates:
            return []
        by_length: dict[int, list[int]] = defaultdict(list)
        for i in candidates:
            by_length[len(next(iter(self.shingles[i])))].append(i)
        held: dict[int, set] = {i: set() for i in candidates}
        tail: list[str] = []
        for piece in pieces(text):
            words = tail + words_of(piece)
            tail = words[max(0, len(words) - SHINGLE + 1) :]
            for length, items in by_length.items():
                mine = set(windows(words, length))
                for i in items:
                    held[i] |= self.shingles[i] & mine
        found = [(self.ids[i], len(self.shingles[i]), len(held[i])) for i in sorted(held)]
        return [(item, q, n) for item, q, n in found if n >= self.share * q - 1e-9]


def _blocks(items: DataFrame, share: float, block_bytes: int) -> Iterator[tuple[Items, bool]]:
    """The items in blocks of bounded size, each with whether it is the last one."""
    total = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = math.ceil(total / block_bytes)
    rows = stage(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n or 1))), "items") if n > 1 else items
    for block in range(n):
        part = rows.filter(F.col("block") == block) if n > 1 else rows
        yield Items.of([(r.item, r.text) for r in part.select("item", "text").collect()], share), block == n - 1


def _settled(found: DataFrame, block: Broadcast, last: bool) -> DataFrame:
    """What a block finds, stored before the next block is sent, so that tasks hold one block at a time."""
    if last:
        return found
    kept = stage(found, "searched")
    block.destroy()
    return kept


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(key, item, n_item, n_shared, containment)`` for each leaked item of each document."""
    rows = picked(docs, key=key, text=text)
    items = picked(benchmark, item=item, text=item_text)
    kinds = [frame.schema[c].dataType.simpleString() for frame, c in ((rows, "key"), (items, "item"))]
    schema = f"key {kinds[0]}, item {kinds[1]}, n_item bigint, n_shared bigint"
    types = [rows.schema["key"].dataType, items.schema["item"].dataType]

    def searched(block: Items, last: bool) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [(i, *hit) for i, t in enumerate(texts_of(batch)) for hit in shared.value.contained(t)]
            keys = batch.column("key").take(pa.array([f[0] for f in found], pa.int64()))
            columns = [pa.array([f[1] for f in found], arrow_item), *(pa.array([f[n] for f in found], pa.int64()) for n in (2, 3))]
            return pa.record_batch([keys, *columns], ["key", "item", "n_item", "n_shared"])

        return _settled(map_batches(rows, run, schema, _forget), shared, last)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_item = to_arrow_type(types[1])
    found = docs.sparkSession.createDataFrame([], schema)
    for n, (block, last) in enumerate(_blocks(items, share, block_bytes)):
        found = searched(block, last) if n == 0 else found.union(searched(block, last))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents into which no item leaks, all their columns."""

    def clean(frame: DataFrame, block: Items, last: bool) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([not shared.value.contained(t) for t in texts_of(batch, text)]))

        return _settled(map_batches(frame, run, docs.schema, _forget), shared, last)

    kept = docs
    for block, last in _blocks(picked(benchmark, item=item, text=item_text), share, block_bytes):
        kept = clean(kept, block, last)
    return kept
