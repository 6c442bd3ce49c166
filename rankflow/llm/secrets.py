"""Secret scans: fixed patterns, and character Markov models for strings no pattern knows.

Two first-order models over the characters of identifiers are trained from labelled
samples, one on random strings and one on ordinary identifiers. A long run of such
characters is a secret if the log-likelihood ratio of the two is high, in all and per
character.

Samples come from several sources. The transitions of each source are turned into shares, the
sources of a label are mixed evenly, and the mixture is smoothed by a fixed share, so a verdict
depends on what the sources look like and not on how much of each there is.

Null texts are empty texts: no spans. Equal rows get equal spans. An empty table gives an
empty result; models trained without samples know nothing and find nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.common import map_batches, picked, texts_of

# Fixed values.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "random")

STEMS = ("passw", "secret", "token", "apikey", "api_key")  # one of them is in every assignment
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RATIO, RATIO_PER_CHARACTER = 10.0, 0.3
SMOOTHING, SPREAD = 1e-7, 0.1
"""Added to the share that each transition has of all; the part of the shares that goes by kinds of characters."""
DRAWN = 10
"""Sources of drawn strings are numbered from here, those of a corpus from 0."""
COUNTS = "secret boolean, source int, pair int, n bigint"
MASK = "[secret]"

Span = tuple[int, int, int]  # start, number of the kind, end

_LETTERS = bytes(b if chr(b).isascii() and chr(b).isalpha() else 0x20 for b in range(256))
_CODE = np.zeros(256, np.int64)
for _n, _c in enumerate(CHARACTERS, 1):
    _CODE[ord(_c)] = _n
STATES = len(CHARACTERS) + 1
"""State 0 stands before and after a string."""
_KIND = np.eye(5)[[0, *(1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else 4 for c in CHARACTERS)]]


def base_spans(text: str) -> list[Span]:
    """The spans of the three patterns in code points, by start, then kind."""
    spans = []
    low = text.lower()
    if any(stem in low for stem in STEMS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def pair_counts(strings: list[str]) -> np.ndarray:
    """Transition counts, ``STATES`` by ``STATES``, over strings of ``CHARACTERS``."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode(), np.uint8)]
    return np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES * STATES).reshape(STATES, STATES)


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of random over ordinary for each transition."""

    ratio: np.ndarray

    def score(self, run: str) -> float:
        codes = _CODE[np.frombuffer(run.encode(), np.uint8)]
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def is_secret(self, run: str) -> bool:
        score = self.score(run)
        return score >= RATIO and score >= RATIO_PER_CHARACTER * len(run)


def fit(random: list[np.ndarray], ordinary: list[np.ndarray]) -> Models:
    """Models of transition counts, one table per source; sources without counts are passed over.

    A part of each share is spread over all transitions between the same kinds of characters, so
    that letters which never met in the samples are still likelier than letters and digits mixed.
    """

    def log_share(sources: list[np.ndarray]) -> np.ndarray:
        shares = [counts / counts.sum() for counts in sources if counts.sum()]
        mixed = sum(shares, np.zeros((STATES, STATES))) / max(len(shares), 1)
        by_kind = _KIND.T @ mixed @ _KIND / np.outer(_KIND.sum(axis=0), _KIND.sum(axis=0))
        mixed = (1 - SPREAD) * mixed + SPREAD * (_KIND @ by_kind @ _KIND.T) + SMOOTHING
        return np.log(mixed / mixed.sum(axis=1, keepdims=True))

    return Models(log_share(random) - log_share(ordinary))


def train(samples: DataFrame, value: str = "value", secret: str = "is_secret", source: str | None = None) -> Models:
    """Models from labelled strings: true for random ones. Only transition counts leave the tasks.

    ``source`` may name a column of whole numbers, a handful, by which samples count as evenly
    mixed. Strings with other characters and rows without a value or label teach nothing.
    """
    rows = samples.select(
        F.col(value).alias("value"), F.col(secret).alias("secret"), (F.col(source) if source else F.lit(0)).cast("int").alias("source")
    )
    known = rows.filter(F.col("value").rlike(r"^[A-Za-z0-9+/_=-]+$") & F.col("secret").isNotNull())
    return _fit_counts(_counted(known.withColumn("source", F.coalesce("source", F.lit(-1)))))


def _counted(rows: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[bool, int], list[str]] = {}
        for value, secret, source in zip(*(batch.column(c).to_pylist() for c in ("value", "secret", "source")), strict=True):
            found.setdefault((secret, source), []).append(value)
        return _as_rows(found)

    return map_batches(rows, run, COUNTS)


def _as_rows(found: dict[tuple[bool, int], list[str]]) -> pa.RecordBatch:
    """Transition counts of strings by label and source."""
    labels, sources, pairs, counts = [], [], [], []
    for (label, source), strings in found.items():
        flat = pair_counts(strings).ravel()
        at = np.flatnonzero(flat)
        labels += [label] * len(at)
        sources += [source] * len(at)
        pairs.append(at.astype(np.int32))
        counts.append(flat[at])
    columns = [pa.array(labels, pa.bool_()), pa.array(sources, pa.int32())]
    columns += [pa.array(np.concatenate([np.zeros(0, kind), *x]), pa.from_numpy_dtype(kind)) for x, kind in ((pairs, np.int32), (counts, np.int64))]
    return pa.record_batch(columns, ["secret", "source", "pair", "n"])


def _fit_counts(counts: DataFrame) -> Models:
    """``counts`` sums to one table of ``STATES`` squared per label and source, which come to the driver."""
    tables: dict[tuple[bool, int], np.ndarray] = {}
    for row in counts.groupBy("secret", "source", "pair").agg(F.sum("n").alias("n")).collect():
        table = tables.setdefault((row.secret, row.source), np.zeros(STATES * STATES))
        table[row.pair] = row.n
    by_label = lambda label: [t.reshape(STATES, STATES) for (own, _), t in sorted(tables.items()) if own == label]
    return fit(by_label(True), by_label(False))


def random_strings(spark: SparkSession, n: int = 4000) -> DataFrame:
    """Labelled random strings in four usual encodings, one source each, from digests of 0 to ``n``."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    mixed = F.base64(F.unhex(digest))
    letters = F.regexp_replace(mixed, "[+/=]", "")
    kinds = [mixed, F.substring(digest, 1, 40), F.lower(letters), F.upper(letters)]
    which = F.pmod(F.col("id"), F.lit(len(kinds))).cast("int")
    return spark.range(n).select(F.get(F.array(*kinds), which).alias("value"), F.lit(True).alias("secret"), (which + DRAWN).alias("source"))


def composed(text: str) -> list[str]:
    """Ordinary identifiers: the words of a text three at a time, joined in the usual ways."""
    plain = text.encode("ascii", "replace").translate(_LETTERS).decode().split()
    low, title = iter(map(str.lower, plain)), iter(map(str.title, plain))
    made = []
    for a, b, c in zip(low, low, low, strict=False):
        made += [f"{a}_{b}_{c}", f"{a}-{b}-{c}", f"{a}/{b}/{c}", f"{a}{b}{c}"]
    for a, b, c in zip(title, title, title, strict=False):
        made += [f"{a}{b}{c}", f"{a.lower()}{b}{c}", f"{a}_{b}_{c}".upper()]
    return made


def train_on(docs: DataFrame, text: str = "text") -> Models:
    """Models of a corpus. Random are its pattern matches, by kind, and drawn strings, by encoding;
    ordinary are all its other identifiers, and its words as identifiers of code."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[bool, int], list[str]] = {}
        ordinary = found.setdefault((False, 0), [])
        made = found.setdefault((False, 1), [])
        for body in texts_of(batch):
            spans = base_spans(body)
            for start, kind, end in spans:
                if kind:
                    found.setdefault((True, kind), []).append(body[start:end])
            at = 0
            for start, _, end in [*spans, (len(body), 0, len(body))]:
                if start > at:
                    ordinary += IDENTIFIER.findall(body, at, start)
                    made += composed(body[at:start])
                at = max(at, end)
        return _as_rows(found)

    return _fit_counts(map_batches(picked(docs, text=text), run, COUNTS).union(_counted(random_strings(docs.sparkSession))))


def all_spans(text: str, models: Models) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those of the models, which overlap no base span."""
    base = base_spans(text)
    found, at = [], 0
    for m in RUN.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        beside = itertools.takewhile(lambda span: span[0] < m.end(), base[at:])
        if all(end <= m.start() for _, _, end in beside) and models.is_secret(m[0]):
            found.append((m.start(), 3, m.end()))
    return base, sorted(base + found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, n_random, base_sha256, spans)`` per document."""
    rows = picked(docs, key=key, text=text)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [], [], []
        for body in texts_of(batch):
            base, every = all_spans(body, models)
            counts.append([sum(k == kind_ for _, k, _ in every) for kind_ in range(4)])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(every))
        numbers = [pa.array(column) for column in np.array(counts, np.int64).T]
        columns = [batch.column("key"), *numbers, pa.array(digests), pa.array(spans)]
        return pa.record_batch(columns, ["key", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    numbers = "n_assign bigint, n_access bigint, n_hex bigint, n_random bigint"
    return map_batches(rows, run, f"key {kind}, {numbers}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with each stretch of overlapping spans replaced by ``mask``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """All rows and columns, secrets in ``text`` replaced by ``MASK``; null texts stay null."""
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = (v.as_py() for v in batch.column(text))
        clean = pa.array([b and masked(b, all_spans(b, models)[1]) for b in bodies], pa.string())
        return pa.record_batch([clean if n == text else batch.column(n) for n in names], names)

    return map_batches(docs, run, docs.schema)
