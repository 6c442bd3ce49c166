"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary is dealt to shards by word length (and by hash, where a length has many words).
Each shard has a blocked Bloom filter. A task generates all words one deletion or one replacement
away from its own, as hashes only, and probes the filters of the lengths they would have.
Only positives become strings and move; an exact join with the vocabulary removes the false
ones. An insertion is the deletion seen from the longer word, so it is not probed again.

Broadcast are filters of ``ROUND_BYTES`` at most at a time; a larger vocabulary takes several
rounds, each over all words, so the bound holds at every size.

Null texts have no words; null ids count as the empty text in the hash. Repeated rows count each
time. Ties go to the smallest word in code-point order. An empty table gives an empty result.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import stage

LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
ODD_ONE = 97
"""Of so many hashes of (document, word) one deletes a code point."""

ALPHABET = np.frombuffer(string.ascii_lowercase.encode() + bytes(range(0xC0, 0x100)), np.uint8)
"""The characters of words; all of them are Latin-1, so one byte each."""
_LETTERS = bytes(ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if b >= 0xC0 else 0x20 for b in range(256))

COUNTED = 200_000
"""Distinct words a task counts before it passes the counts on."""
LONGEST = 64
"""Words of so many characters or more share one length class."""
CLASS_WORDS = 1 << 21
"""Words per shard at most, on average; a length with more is cut by hash."""
BITS_PER_WORD = 16
BLOCK_LANES = 8  # a block is eight lanes of 64 bits, with one bit per word in each
ROUND_BYTES = 64 << 20
PROBES = 1 << 20
"""Edits that a task holds at a time, as hashes."""
TASK_WORDS = 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)


# --- words ---


def counted(text: str, doc: str) -> Iterator[tuple[bytes, int]]:
    """``(word, n)`` of one document, Latin-1 bytes, after the deletions that the hash asks for."""
    start = zlib.crc32(f"{doc}:".encode())
    for word, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split(b" ")).items():
        if word:
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % ODD_ONE == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= LEAST_CHARS:
                yield word, n


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of the words of ``LEAST_CHARS`` code points with ``LEAST_COUNT`` occurrences or more."""
    rows = picked(docs, doc=key, text=text).select(F.coalesce(F.col("doc").cast("string"), F.lit("")).alias("doc"), "text")

    def flushed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.record_batch([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for doc, body in zip(batch.column("doc"), batch.column("text"), strict=True):
                for word, n in counted(body.as_py() or "", doc.as_py()):
                    counts[word] += n
                if len(counts) > COUNTED:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    found = rows.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- hashes of words and of their edits ---


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, _BASE))))


def hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, given as rows of character codes: a polynomial in the characters."""
    if not len(words):
        return np.zeros(0, np.uint64)
    length = words.shape[1]
    return _mixed((words.astype(np.uint64) * _powers(length)).sum(axis=1, dtype=np.uint64) + np.uint64(length))


def deletions(words: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hashes of the words without their character at ``low`` to ``high - 1``: (words, places).

    A run of equal characters gives the same word at each place; all but its last place repeat it.
    """
    length = words.shape[1]
    powers = _powers(length)
    codes = words.astype(np.uint64)
    before = np.cumsum(codes * powers, axis=1, dtype=np.uint64)
    moved = codes[:, 1:] * powers[:-1]
    after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    zero = np.zeros((len(words), 1), np.uint64)
    before, after = np.hstack((zero, before[:, :-1])), np.hstack((after, zero))
    return _mixed(before[:, low:high] + after[:, low:high] + np.uint64(length - 1))


def replacements(words: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hashes of the words with another character at ``low`` to ``high - 1``: (words, places, alphabet)."""
    length = words.shape[1]
    powers = _powers(length)
    codes = words.astype(np.uint64)
    own = (codes * powers).sum(axis=1, dtype=np.uint64)
    bare = own[:, None] - codes[:, low:high] * powers[low:high]
    put = ALPHABET.astype(np.uint64)[None, :] * powers[low:high, None]
    return _mixed(bare[:, :, None] + put[None, :, :] + np.uint64(length))


# --- filters ---


def _class(length: int) -> int:
    return min(length, LONGEST)


def _lanes(h: np.ndarray, blocks: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per lane of each hash's block: its place in the filter, and its bit. Blocks go by the high half."""
    block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)) * np.uint64(BLOCK_LANES)
    spread = _mixed(h + _BASE)
    for lane in range(BLOCK_LANES):
        yield (block + np.uint64(lane)).astype(np.int64), np.uint64(1) << (spread >> np.uint64(6 * lane) & np.uint64(63))


def built(h: np.ndarray) -> np.ndarray:
    """A blocked Bloom filter of these hashes."""
    blocks = -(-len(h) * BITS_PER_WORD // (64 * BLOCK_LANES)) or 1
    lanes = np.zeros(blocks * BLOCK_LANES, np.uint64)
    for place, bit in _lanes(h, blocks):
        np.bitwise_or.at(lanes, place, bit)
    return lanes


def positive(lanes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold. Each lane looks only at what the earlier ones passed."""
    left = np.arange(len(h))
    blocks = len(lanes) // BLOCK_LANES
    block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)) * np.uint64(BLOCK_LANES)
    spread = _mixed(h + _BASE)
    for lane in range(BLOCK_LANES):
        bit = spread >> np.uint64(6 * lane) & np.uint64(63)
        hit = (lanes[(block + np.uint64(lane)).astype(np.int64)] >> bit & np.uint64(1)).astype(bool)
        left, block, spread = left[hit], block[hit], spread[hit]
    return left


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of character codes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    lengths: dict[int, list[str]] = {}
    for word in words:
        lengths.setdefault(len(word), []).append(word)
    yield from lengths.items()


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    """Which of a class' shards a hash belongs to; ``segments`` is a power of two."""
    return (h & np.uint64(segments - 1)).astype(np.int64)


def filters(words: DataFrame, segments: dict[int, int]) -> DataFrame:
    """``(class, segment, lanes binary)``, one row per shard, stored."""

    def sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in _by_length(batch.column("word").to_pylist()):
                h = hashes(_codes(some))
                own = np.full(len(h), _class(length), np.int32)
                columns = [own, _segment(h, segments[_class(length)]).astype(np.int32), h.view(np.int64)]
                yield pa.record_batch([pa.array(c) for c in columns], ["class", "segment", "hash"])

    def build(key: tuple, part: pa.Table) -> pa.Table:
        lanes = built(part.column("hash").to_numpy().view(np.uint64))
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([lanes.tobytes()], pa.binary())]
        return pa.table(columns, ["class", "segment", "lanes"])

    dealt = words.select("word").mapInArrow(sorted_out, "class int, segment int, hash bigint")
    made = dealt.groupBy("class", "segment").applyInArrow(build, "class int, segment int, lanes binary")
    return stage(made, "bloom")


def _rounds(sizes: list[tuple[int, int, int]], most: int) -> Iterator[list[tuple[int, int]]]:
    """Shards in rounds of about ``most`` bytes: ``(class, segment)`` lists."""
    some, total = [], 0
    for class_, segment, size in sizes:
        if some and total + size > most:
            yield some
            some, total = [], 0
        some.append((class_, segment))
        total += size
    if some:
        yield some


# --- neighbours ---


class Prober:
    """The edits of words that the filters of one round may hold."""

    def __init__(self, lanes: dict[tuple[int, int], bytes], segments: dict[int, int]):
        self.lanes = {shard: np.frombuffer(bits, np.uint64) for shard, bits in lanes.items()}
        self.segments = segments

    def _hits(self, h: np.ndarray, class_: int) -> np.ndarray:
        """Places of the hashes that a filter of this round may hold."""
        count = self.segments.get(class_, 0)
        found = []
        own = _segment(h, count) if count > 1 else None
        for segment in range(count):
            if (class_, segment) in self.lanes:
                at = np.arange(len(h)) if own is None else np.flatnonzero(own == segment)
                found.append(at[positive(self.lanes[class_, segment], h[at])])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def edits(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """``(place of the word, edit)`` of words of one length; of a replacement the greater character only."""
        whole = _codes(words)
        length = whole.shape[1]
        shorter, same = (self.segments.get(_class(length - k)) for k in (1, 0))
        width = max(1, PROBES // (len(ALPHABET) * len(words)))
        for low in range(0, length, width):
            high = min(low + width, length)
            if shorter and length > LEAST_CHARS:
                for hit in self._hits(deletions(whole, low, high).ravel(), _class(length - 1)):
                    word, at = divmod(int(hit), high - low)
                    at += low
                    text = words[word]
                    if at == length - 1 or text[at] != text[at + 1]:
                        yield word, text[:at] + text[at + 1 :]
            if same:
                greater = (ALPHABET[None, None, :] > whole[:, low:high, None]).ravel()
                at_edit = np.flatnonzero(greater)
                for hit in at_edit[self._hits(replacements(whole, low, high).ravel()[at_edit], _class(length))]:
                    word, rest = divmod(int(hit), (high - low) * len(ALPHABET))
                    at, letter = divmod(rest, len(ALPHABET))
                    text = words[word]
                    yield word, text[: low + at] + chr(ALPHABET[letter]) + text[low + at + 1 :]


def _probed(words: DataFrame, shards: dict[tuple[int, int], bytes], segments: dict[int, int]) -> DataFrame:
    """``(word, n, other)``: edits that may be words, by filters that one broadcast takes to the tasks."""
    sent = words.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prober = Prober(sent.value, segments)
        for batch in batches:
            counts = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True))
            for length, some in _by_length(list(counts)):
                most = max(1, PROBES // (len(ALPHABET) * length))
                for at in range(0, len(some), most):
                    own = some[at : at + most]
                    found = [(own[i], counts[own[i]], other) for i, other in prober.edits(own)]
                    columns = list(zip(*found, strict=True)) or [[], [], []]
                    kinds = (pa.string(), pa.int64(), pa.string())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "other"])

    return stage(words.mapInArrow(run, "word string, n bigint, other string"), "positives")


def near_pairs(words: DataFrame, class_words: int = CLASS_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``(word, n, near, near_n)``: all ordered pairs of words ``(word, n)`` one edit apart.

    ``words`` is read several times and should be a stored table.
    """
    lengths = F.least(F.length("word"), F.lit(LONGEST))
    sizes = {r["class"]: r["n"] for r in words.groupBy(lengths.alias("class")).agg(F.count("*").alias("n")).collect()}
    segments = {c: 1 << max(0, (n - 1) // class_words).bit_length() for c, n in sizes.items()}
    shards = filters(words, segments)
    held = shards.select("class", "segment", F.octet_length("lanes").alias("size")).orderBy("class", "segment").collect()
    dealt = words.repartition(max(1, -(-sum(sizes.values()) // TASK_WORDS)), "word")
    pairs = None
    for some in _rounds([tuple(r) for r in held], round_bytes):
        wanted = shards.filter(F.struct("class", "segment").isin([F.struct(F.lit(c), F.lit(s)) for c, s in some]))
        lanes = {(r["class"], r["segment"]): bytes(r["lanes"]) for r in wanted.collect()}
        found = _probed(dealt, lanes, segments)
        pairs = found if pairs is None else pairs.union(found)
    if pairs is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    exact = stage(pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other"), "near")
    return exact.select("word", "n", F.col("other").alias("near"), F.col("other_n").alias("near_n")).union(
        exact.select("other", "other_n", "word", "n")
    )


def rooted(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words with a form ``(word, form)``: where following forms ends.

    Every form is at least twice as frequent as its word, so chains end. A round doubles the
    steps that each word has taken.
    """
    steps = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "steps")
    while not steps.filter("open").isEmpty():
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stage(
            steps.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")
            ),
            "steps",
        )
    return steps.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO, **bounds: int) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of the whole vocabulary.

    A word's form is its most frequent neighbour if that is ``ratio`` times as frequent or more.
    """
    words = stage(vocabulary(docs, key, text), "words")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    best = near_pairs(words, **bounds).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    known = words.join(best, "word", "left").withColumn("top", -F.col("best.less"))
    enough = F.col("top") >= ratio * F.col("n")
    known = stage(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, F.col("top")).alias("form_n"),
        ),
        "forms",
    )
    roots = rooted(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
