"""Quality rules: figures of each text, and line frequency across the documents of a host.

Lines are normalised (lower case, single blanks, digits as 0) and hashed. A line that stands
in more distinct documents of its host than the limit allows is boilerplate and is removed.
A document that fails the base rules, or of whose words less than a share is left, is
rejected.

*Distinct documents.* Copies must not make their own lines look like boilerplate, so documents of
one host with equal sets of lines count once, by a digest of that set. Every other document counts,
however alike: a cluster of near copies of one host above the limits is boilerplate by this rule.

Null texts are empty texts: no words, rejected. Null hosts form one host. Repeated rows get
equal verdicts. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import map_batches, one_of_each, picked
from rankflow.session import stage

LEAST_WORDS = 50
REPEATED_SHARE = 0.5
LINE_DOCS = 20
LINE_SHARE = 0.05
SHARE_LEFT = 0.5
LONG_WORDS = 20
"""Lines of so many words do not recur by nature: for them ``LINE_DOCS`` is the limit at every host size."""
MOST_BROADCAST = 1_000_000
"""Up to so many frequent lines (8 bytes each) go to the tasks as a set, beyond that by a join."""

SYMBOLS = "#*$%&|<>"
_DIGITS = re.compile(r"[0-9]+")

FIGURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
VERDICT = "base_failed boolean, n_lines_removed bigint, n_words_left bigint, kept boolean"


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a three-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 21:  # three numbers no longer fit 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(window)] |= twice
    return int(covered.sum())


def figures(text: str) -> tuple[int, int, int, int, int]:
    """The five base figures of one text, in the order of ``FIGURES``."""
    raw = text.encode()
    words = raw.split()
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(raw.count(c) for c in SYMBOLS.encode())
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or n_repeat_words > REPEATED_SHARE * n_words


def line_keys(text: str, host: str | None) -> list[tuple[int, int, str]]:
    """``(key of host and normalised line, words, line)`` of each line of a text, blank lines left out."""
    seed = 0 if host is None else xxhash.xxh64_intdigest(host, 1)
    keys = []
    for line in text.split("\n"):
        words = line.encode().lower().split()
        if words:
            key = xxhash.xxh64_intdigest(_DIGITS.sub("0", b" ".join(words).decode().lower()), seed)
            keys.append((key - (1 << 64) if key >> 63 else key, len(words), line))
    return keys


def _marked(batch: pa.RecordBatch):
    """``(host, line keys, mark of the line set, words by line key)`` of each document."""
    for text, host in zip(batch.column("text"), batch.column("host"), strict=True):
        host = host.as_py()
        words = {key: n for key, n, _ in line_keys(text.as_py() or "", host)}
        keys = sorted(words)
        mark = xxhash.xxh64_intdigest(np.array(keys, np.int64).tobytes(), 0 if host is None else xxhash.xxh64_intdigest(host, 1))
        yield host, keys, mark - (1 << 64) if mark >> 63 else mark, words


def _occurrences(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per document: its lines with its mark, and the mark with no line."""
    hosts, lines, marks, long = [], [], [], []
    for host, keys, mark, words in _marked(batch):
        hosts += [host] * (len(keys) + 1)
        lines += [*keys, None]
        marks += [mark] * (len(keys) + 1)
        long += [*(words[key] >= LONG_WORDS for key in keys), False]
    columns = [pa.array(hosts, pa.string()), pa.array(lines, pa.int64()), pa.array(marks, pa.int64()), pa.array(long, pa.bool_())]
    return pa.record_batch(columns, ["host", "line", "mark", "long"])


def frequent_lines(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    line_share: float = LINE_SHARE,
) -> DataFrame:
    """``(line, n)``: keys of the lines above their host's limit, with their distinct documents.

    The limit is ``line_docs`` documents or ``line_share`` of the host's, whichever is more; for
    lines of ``LONG_WORDS`` words it is ``line_docs`` alone.
    """
    distinct = map_batches(picked(docs, text=text, host=host), _occurrences, "host string, line bigint, mark bigint, long boolean").distinct()
    counted = distinct.groupBy("host", "line").agg(F.count("*").alias("n"), F.max("long").alias("long"))
    counts = stage(counted.filter(F.col("line").isNull() | (F.col("n") > line_docs)), "line-counts")
    totals = counts.filter("line IS NULL").select(F.col("host").alias("h"), F.col("n").alias("docs"))
    lines = counts.filter("line IS NOT NULL").join(totals, F.col("host").eqNullSafe(F.col("h")))
    return lines.filter(F.col("long") | (F.col("n") > line_share * F.col("docs"))).select("line", "n")


def _with_frequent(docs: DataFrame, key: str, text: str, host: str, limits: dict) -> tuple[DataFrame, frozenset[int]]:
    """The documents with the frequent lines to drop: as one set if that is small, else in a column."""
    frequent = stage(frequent_lines(docs, text, host, **limits), "frequent-lines")
    if frequent.count() <= MOST_BROADCAST:
        return docs.withColumn("_drop", F.lit(None).cast("array<bigint>")), frozenset(r.line for r in frequent.collect())

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for row, body, source in zip(*(batch.column(c) for c in ("row", "text", "host")), strict=True):
            row = row.as_py()
            found += [(row, k) for k in {k for k, _, _ in line_keys(body.as_py() or "", source.as_py())}]
        columns = [pa.array([r for r, _ in found], pa.string()), pa.array([k for _, k in found], pa.int64())]
        return pa.record_batch(columns, ["row", "line"])

    marked = docs.withColumn("_row", one_of_each([key, host, text]))
    held = map_batches(picked(marked, row="_row", text=text, host=host), lines, "row string, line bigint").distinct()
    dropped = held.join(frequent, "line").groupBy(F.col("row").alias("_row")).agg(F.collect_list("line").alias("_drop"))
    return marked.join(dropped, "_row", "left").drop("_row"), frozenset()


def _judge(text: str, host: str | None, drop: frozenset[int] | set[int], share_left: float) -> tuple:
    """Figures, verdict and cleaned text of one document."""
    own = figures(text)
    failed = base_fails(own[0], own[4])
    keys = line_keys(text, host) if drop else []
    removed = [words for key, words, _ in keys if key in drop]
    left = own[0] - sum(removed)
    kept = not failed and left >= share_left * own[0]
    cleaned = "\n".join(line for key, _, line in keys if key not in drop) if removed else text
    return (*own, failed, len(removed), left, kept), cleaned


def quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    share_left: float = SHARE_LEFT,
    **limits: float,
) -> DataFrame:
    """``key`` with the columns of ``FIGURES`` and ``VERDICT``, one row per document."""
    rows, everywhere = _with_frequent(picked(docs, key=key, text=text, host=host), "key", "text", "host", limits)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [_judge(t or "", h, drop, share_left)[0] for t, h, drop in _dropping(batch, everywhere)]
        columns = [pa.array(c, pa.bool_() if i in (5, 8) else pa.int64()) for i, c in enumerate(zip(*judged, strict=True))]
        names = [part.split()[0] for part in f"{FIGURES}, {VERDICT}".split(", ")]
        return pa.record_batch([batch.column("key"), *columns], ["key", *names])

    return map_batches(rows.select("key", "text", "host", "_drop"), run, f"key {kind}, {FIGURES}, {VERDICT}")


def _dropping(batch: pa.RecordBatch, everywhere: frozenset[int], text: str = "text", host: str = "host"):
    for t, h, own in zip(batch.column(text), batch.column(host), batch.column("_drop"), strict=True):
        yield t.as_py(), h.as_py(), set(own.as_py()) if own.is_valid else everywhere


def filtered(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    share_left: float = SHARE_LEFT,
    **limits: float,
) -> DataFrame:
    """The kept documents, all their columns, frequent lines and blank lines beside them cut out of the text."""
    rows, everywhere = _with_frequent(docs, key, text, host, limits)
    schema, names = docs.schema, docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [_judge(t or "", h, drop, share_left) for t, h, drop in _dropping(batch, everywhere, text, host)]
        keep = np.flatnonzero([figures_[-1] for figures_, _ in judged])
        cleaned = pa.array([judged[i][1] for i in keep], pa.string())
        part = batch.take(pa.array(keep))
        return pa.record_batch([cleaned if n == text else part.column(n) for n in names], names)

    return map_batches(rows.select(*names, "_drop"), run, schema)
