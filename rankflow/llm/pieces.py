"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding follows the byte-pair merges of a SentencePiece model: an agenda holds the candidate
merges of neighbouring symbols by score, then place, and the best is made until none is
left. With dropout, a candidate taken from the agenda is skipped if a hash of seed, variant,
stretch, place and merged piece falls below the rate; the hash alone decides, so a lost
task comes out the same again. Occurrences of a stretch, whatever its length, take turns
through ``variants`` segmentations, starting at a place drawn from the document's key.
Stretches that a worker does not remember are merged together, one candidate each per step.

Texts are cut into stretches of blanks with the characters after them, which no piece
spans. Characters outside the vocabulary, and the model's own mark for a blank where a text
holds it, become byte pieces, so every text decodes to itself.

Null texts are empty texts, with no pieces. Null keys draw like the empty key. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from rankflow.llm.common import map_batches, picked

BLANK = "▁"
RATE = 0.1
VARIANTS = 4
KNOWN = 400_000
"""Segmentations a worker remembers, about 200 bytes each; the older half is dropped when full."""
LONGEST_KNOWN = 48
"""Longer stretches are segmented afresh each time."""

SHORT = 48
"""Up to so many characters stretches are merged many at a time, longer ones one by one with a heap."""
ROWS = 4096
"""Stretches merged together."""
CHARS = 1 << 20
"""Characters of texts whose new stretches are segmented together; longer texts are taken in portions."""
PORTION = 1 << 16
"""Stretches of a long text taken at a time."""

_MARKED = "\0" + BLANK
_TOP = 1 << 64


class Model:
    """Pieces and scores of a byte-pair model with byte fallback, with the merges' memory."""

    def __init__(self, path: str, rate: float = RATE, seed: int = 0, variants: int = VARIANTS):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = processor.get_piece_size()
        special = [processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) for i in range(size)]
        pieces = [processor.id_to_piece(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.bytes = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.cost = {p: -processor.get_score(i) for p, i in self.ids.items()}
        # What a piece stands for: text, or one byte of a character outside the vocabulary.
        self.text = [None if i in byte_of else "" if special[i] else p.replace(BLANK, " ") for i, p in enumerate(pieces)]
        self.byte = [byte_of.get(i) for i in range(size)]
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("the model has pieces that span blanks")
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.stretch = re.compile(rf"[{alone}]| *[^ {alone}]+| +" if alone else " *[^ ]+| +")
        self.skip_below = int(rate * _TOP)
        self.seed, self.variants = seed, variants
        # Segmentations per variant, the ids as bytes.
        self.known: list[dict[str, bytes]] = [{} for _ in range(variants)]
        self.older: list[dict[str, bytes]] = [{} for _ in range(variants)]
        self._tabulate(pieces)

    def _tabulate(self, pieces: list[str]) -> None:
        """Symbols by number: pieces by their ids, then further characters of pieces; the last one is unknown."""
        numbers = dict(self.ids)
        for character in sorted(set("".join(self.ids))):
            numbers.setdefault(character, len(pieces) + len(numbers) - len(self.ids))
        self.pieces = len(pieces)
        self.unknown = self.pieces + len(numbers) - len(self.ids)
        self.words = [piece.encode() for piece in pieces]
        self.costs = np.full(self.unknown + 1, np.inf)
        pairs = []
        for piece, number in self.ids.items():
            self.costs[number] = self.cost[piece]
            for at in range(1, len(piece)):
                left, right = numbers.get(piece[:at]), numbers.get(piece[at:])
                if left is not None and right is not None:
                    pairs.append((left * (self.unknown + 1) + right, number))
        pairs.sort()
        self.pair_keys = np.array([*(key for key, _ in pairs), np.iinfo(np.int64).max], np.int64)
        self.pair_merged = np.array([*(merged for _, merged in pairs), self.unknown], np.int64)
        self.of_character = np.full(0x110000, self.unknown, np.int32)
        for symbol, number in numbers.items():
            if len(symbol) == 1 and symbol != BLANK:
                self.of_character[ord(symbol)] = number
        self.of_character[ord(" ")] = numbers.get(BLANK, self.unknown)

    def segment(self, stretch: str, variant: int) -> tuple[int, ...]:
        """Piece ids of one stretch."""
        return tuple(np.frombuffer(self.segments([stretch], [variant])[0], np.int32).tolist())

    def segments(self, stretches: list[str], variants: list[int]) -> list[bytes]:
        """Piece ids of stretches, each in one of its variants."""
        first, digest = self.seed * 1_000_003, xxhash.xxh64_intdigest
        keys = [digest(s, first + v) for s, v in zip(stretches, variants, strict=True)] if self.skip_below else [0] * len(stretches)
        found = [b""] * len(stretches)
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        for i in np.flatnonzero(sizes > SHORT).tolist():
            symbols = [BLANK if c == " " else _MARKED if c == BLANK else c for c in stretches[i]]
            found[i] = np.array(self._ids(self._merged_long(symbols, keys[i])), np.int32).tobytes()
        order = np.argsort(sizes, kind="stable")[: int((sizes <= SHORT).sum())].tolist()
        for at in range(0, len(order), ROWS):
            some = order[at : at + ROWS]
            merged = self._merged([stretches[i] for i in some], np.array([keys[i] for i in some], np.uint64))
            for i, ids in zip(some, merged, strict=True):
                found[i] = ids
        return found

    def _ids(self, symbols: list[str]) -> list[int]:
        ids: list[int] = []
        for symbol in symbols:
            piece = self.ids.get(symbol)
            if piece is not None:
                ids.append(piece)
            else:
                ids += [self.bytes[b] for b in symbol.removeprefix("\0").encode() or b"\0"]
        return ids

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbols that pairs of neighbours merge to, else the unknown one."""
        key = left * (self.unknown + 1) + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_merged[at], self.unknown)

    def _merged(self, stretches: list[str], keys: np.ndarray) -> Iterator[bytes]:
        """Piece ids of short stretches. Each has its agenda, a row of costs; each step takes the best of every row.

        A row has a place before the first symbol and one after the last, so all have neighbours. A
        merge leaves its left place with the new symbol and unlinks the right one.
        """
        n = len(stretches)
        sizes = np.fromiter(map(len, stretches), np.int64, n)
        width = int(sizes.max()) + 2
        inside = np.arange(1, width - 1) <= sizes[:, None]
        symbols = np.full((n, width), self.unknown, np.int64)
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols[:, 1:-1][inside] = self.of_character[codes]
        joined = np.full((n, width), self.unknown, np.int64)
        joined[:, 1:-1] = self._joined(symbols[:, 1:-1], symbols[:, 2:])
        agenda = self.costs[joined]
        linked = np.zeros((n, width), bool)
        linked[:, 1:-1] = inside
        after, before = (np.tile(np.arange(width) + step, (n, 1)) for step in (1, -1))
        # The same arrays as one row each, to be met at single places.
        symbol, merged, cost, link, next_, last = (a.reshape(-1) for a in (symbols, joined, agenda, linked, after, before))
        below, words, digest = self.skip_below, self.words, xxhash.xxh64_intdigest
        rows = np.arange(n)
        while True:
            place = agenda[rows].argmin(axis=1)
            at = rows * width + place
            open_ = cost[at] < np.inf
            rows, place, at = rows[open_], place[open_], at[open_]
            if not len(rows):
                break
            made = merged[at]
            cost[at] = np.inf
            if below:
                drawn = (keys[rows] ^ (place - 1).astype(np.uint64)).tolist()
                goes = np.array([digest(words[m], k) >= below for m, k in zip(made.tolist(), drawn, strict=True)], bool)
                at, made = at[goes], made[goes]
            start = at // width * width
            right = start + next_[at]
            beyond = next_[right]
            symbol[at], link[right], cost[right] = made, False, np.inf
            next_[at], last[start + beyond] = beyond, at - start
            left = start + last[at]
            merged[at] = self._joined(made, symbol[start + beyond])
            merged[left] = self._joined(symbol[left], made)
            cost[at], cost[left] = self.costs[merged[at]], self.costs[merged[left]]
        ids = symbols[linked].astype(np.int32).tobytes()
        ends = (np.cumsum(linked.sum(axis=1)) * 4).tolist()
        strange = ((symbols >= self.pieces) & linked).any(axis=1).tolist()
        for i, (start, end) in enumerate(zip([0, *ends], ends, strict=False)):
            yield self._with_bytes(stretches[i], symbols[i], linked[i]) if strange[i] else ids[start:end]

    def _with_bytes(self, stretch: str, symbols: np.ndarray, linked: np.ndarray) -> bytes:
        """Piece ids where some characters are no pieces."""
        ids: list[int] = []
        for place in np.flatnonzero(linked).tolist():
            own, character = int(symbols[place]), stretch[place - 1]
            ids += [own] if own < self.pieces else self._ids([_MARKED if character == BLANK else character])
        return np.array(ids, np.int32).tobytes()

    def _merged_long(self, symbols: list[str | None], key: int) -> list[str]:
        """The same with a heap as agenda, for stretches on which scanning would be slow."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        cost, below = self.cost, self.skip_below
        agenda = []
        for i in range(n - 1):
            merged = symbols[i] + symbols[i + 1]
            if merged in cost:
                agenda.append((cost[merged], i, merged))
        heapq.heapify(agenda)
        while agenda:
            _, left, merged = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] is None or right >= n or symbols[left] + symbols[right] != merged:
                continue  # one of its sides has merged otherwise meanwhile
            if below and xxhash.xxh64_intdigest(merged, key ^ left) < below:
                continue
            symbols[left], symbols[right] = merged, None
            after[left] = beyond = after[right]
            if beyond < n:
                before[beyond] = left
                longer = merged + symbols[beyond]
                if longer in cost:
                    heapq.heappush(agenda, (cost[longer], left, longer))
            if before[left] >= 0:
                longer = symbols[before[left]] + merged
                if longer in cost:
                    heapq.heappush(agenda, (cost[longer], before[left], longer))
        return [symbol for symbol in symbols if symbol is not None]

    def encode(self, text: str, key: str = "") -> list[int]:
        (ids,) = self.encode_all([text], [key])
        return ids.tolist()

    def encode_all(self, texts: Sequence[str], keys: Sequence[str]) -> Iterator[np.ndarray]:
        """Piece ids of each text; what is new in about ``CHARS`` characters of them is segmented together."""
        some: list[tuple[list[str], int]] = []
        chars = 0
        for text, key in zip(texts, keys, strict=True):
            first = xxhash.xxh64_intdigest(key, self.seed) % self.variants
            if len(text) > CHARS:
                yield from self._encoded(some)
                some, chars = [], 0
                yield self._long(text, first)
                continue
            some.append((self.stretch.findall(" " + text) if text else [], first))
            chars += len(text)
            if chars >= CHARS:
                yield from self._encoded(some)
                some, chars = [], 0
        yield from self._encoded(some)

    def _long(self, text: str, first: int) -> np.ndarray:
        """Piece ids of a long text, in portions, so that the memory of segmentations keeps its bound."""
        found = (match.group() for match in self.stretch.finditer(" " + text))
        ids = []
        for portion in itertools.batched(found, PORTION):
            ids += self._encoded([(list(portion), first)])
            first += len(portion)
        return np.concatenate(ids)

    def _encoded(self, texts: list[tuple[list[str], int]]) -> list[np.ndarray]:
        """Piece ids of texts given as stretches and the variant of the first one."""
        variants = self.variants
        passing = self._learn(texts)
        encoded = []
        for stretches, first in texts:
            parts = [b""] * len(stretches)
            for turn in range(min(variants, len(parts))):
                known = self.known[(first + turn) % variants]
                parts[turn::variants] = map(known.__getitem__, stretches[turn::variants])
            encoded.append(np.frombuffer(b"".join(parts), np.int32))
        for variant, known in enumerate(self.known):
            for stretch in passing[variant]:
                del known[stretch]
            if len(known) >= KNOWN // (2 * variants):
                self.older[variant], self.known[variant] = known, {}
        return encoded

    def _learn(self, texts: list[tuple[list[str], int]]) -> list[list[str]]:
        """Take into the newer memory all stretches of the texts; which ones are too long to stay, per variant."""
        asked: list[set[str]] = [set() for _ in range(self.variants)]
        for stretches, first in texts:
            for turn in range(self.variants):
                asked[(first + turn) % self.variants].update(stretches[turn :: self.variants])
        missing: list[str] = []
        counts = []
        for some, known, older in zip(asked, self.known, self.older, strict=True):
            some = some.difference(known)
            again = some.intersection(older)
            known.update((s, older[s]) for s in again)
            missing += some - again
            counts.append(len(some) - len(again))
        made = self.segments(missing, np.repeat(range(self.variants), counts).tolist())
        passing, start = [], 0
        for known, count in zip(self.known, counts, strict=True):
            own = missing[start : start + count]
            known.update(zip(own, made[start : start + count], strict=True))
            passing.append([s for s in own if len(s) > LONGEST_KNOWN])
            start += count
        return passing

    def decode(self, ids: Sequence[int]) -> str:
        """The text of piece ids; control pieces stand for nothing."""
        if not len(ids):
            return ""
        ids = np.asarray(ids).tolist()
        texts = list(map(self.text.__getitem__, ids))
        if None in texts:
            parts: list[str] = []
            run = bytearray()
            for i, piece in zip(ids, texts, strict=True):
                if piece is None:
                    run.append(self.byte[i])
                    continue
                if run:
                    parts.append(run.decode(errors="replace"))
                    run.clear()
                parts.append(piece)
            parts.append(run.decode(errors="replace"))
            texts = parts
        return "".join(texts)[1:]  # the blank put before every text


@functools.cache
def model(path: str, rate: float, seed: int, variants: int) -> Model:
    """One per worker process and setting."""
    return Model(path, rate, seed, variants)


def encode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    rate: float = RATE,
    seed: int = 0,
    variants: int = VARIANTS,
) -> DataFrame:
    """``(key, n_pieces, pieces, lossless)``: piece ids, and whether they decode to the text.

    ``path`` names the model file on every machine. Another ``seed`` gives other segmentations;
    a ``rate`` of 0 gives the model's own.
    """
    rows = picked(docs, key=key, text=text)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = model(path, rate, seed, variants)
        ends, values, lossless = [0], [], []
        names = ["" if name is None else str(name) for name in batch.column("key").to_pylist()]
        texts = [body or "" for body in batch.column("text").to_pylist()]
        for body, ids in zip(texts, coder.encode_all(texts, names), strict=True):
            lossless.append(coder.decode(ids) == body)
            values.append(ids)
            ends.append(ends[-1] + len(ids))
        offsets = np.array(ends, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))
        columns = [batch.column("key"), pa.array(np.diff(offsets).astype(np.int64)), ids, pa.array(lossless)]
        return pa.record_batch(columns, ["key", "n_pieces", "pieces", "lossless"])

    return map_batches(rows, run, f"key {kind}, n_pieces bigint, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, path: str, key: str = "key", pieces: str = "pieces") -> DataFrame:
    """``(key, text)`` from piece ids; null ids give the empty text."""
    rows = picked(encoded, key=key, pieces=pieces)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = model(path, 0.0, 0, 1)
        texts = pa.array([coder.decode(ids.as_py() or []) for ids in batch.column("pieces")], pa.string())
        return pa.record_batch([batch.column("key"), texts], ["key", "text"])

    return map_batches(rows, run, f"key {kind}, text string")
