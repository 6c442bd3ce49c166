"""Token counts by batch encoding in Arrow functions that return lengths only.

A text is cut at ASCII blanks, which no token of the supported tokenizers spans, so long
texts need no long encodings. Pieces that a worker has not met lately are encoded together
in batches of about equal bytes.

Null texts count as empty: no bytes, no tokens. Every row gets its own count, repeated rows
too. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import map_batches, picked, texts_of

LIMIT = 2048
BATCH_BYTES = 1 << 18
KNOWN_PIECES = 200_000


def byte_batches(pieces: Iterable[bytes], most: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The pieces in lists of about ``most`` bytes."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece) + 16
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class Counter:
    """Lengths of encodings, with a memory of pieces that is emptied when it is full."""

    def __init__(self, path: str, known: int = KNOWN_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known, self.most = {}, known

    def lengths(self, texts: list[bytes]) -> list[int]:
        cut = [text.split() for text in texts]
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        for batch in byte_batches({piece for pieces in cut for piece in pieces if piece not in known}):
            found = self.tokenizer.encode_batch([p.decode() for p in batch], add_special_tokens=False)
            known.update(zip(batch, map(len, found), strict=True))
        return [sum(map(known.__getitem__, pieces)) for pieces in cut]


@functools.cache
def counter(path: str) -> Counter:
    """One per worker process and tokenizer file."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` with the tokenizer of the .json file at ``path``.

    ``path`` names the file on every machine. No begin, end or other special tokens are
    added; special strings inside a text count as that library reads them by default. The
    tokenizer must not let a token span ASCII blanks.
    """
    rows = picked(docs, key=key, text=text)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(path)
        n_bytes, n_tokens = [], []
        group, size = [], 0
        for body in texts_of(batch):
            group.append(body.encode())
            size += len(group[-1])
            n_bytes.append(len(group[-1]))
            if size >= 16 * BATCH_BYTES:
                n_tokens += count.lengths(group)
                group, size = [], 0
        n_tokens += count.lengths(group)
        columns = [batch.column("key"), pa.array(np.array(n_bytes)), pa.array(np.array(n_tokens, np.int64))]
        return pa.record_batch(columns, ["key", "n_bytes", "n_tokens"])

    counted = map_batches(rows, run, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
