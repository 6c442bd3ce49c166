"""Queries against postings, cell by cell of the collection.

Passages are dealt to cells of about ``CELL_TERMS`` terms by a hash of their id, so there are as many
cells as the collection needs. Postings go to their own cell, a row per query goes to every cell, and a
cell passes on the best k passages of each query. Sorting puts a cell's postings before the queries, which
then stream past: a task holds the postings of one cell and one batch of queries, however many there are,
and no row is made per query and posting. Where the number of cells is known beforehand, each is a task of its
own, so that what a task sorts does not depend on the number of shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.scores import LEXICAL_PLACES

CELL_TERMS = 1 << 23
LEAST_TERMS, SMALL_CELLS = 1 << 18, 8
"""Small collections are cut into up to ``SMALL_CELLS`` cells of at least ``LEAST_TERMS`` terms, for the cores."""
COMMON_SHARE, COMMON_FIGURES = 16, 1 << 23
"""A term is common if at least one passage in so many has it; a cell keeps so many figures of common terms at most."""
MET_FIGURES, MET_POSTINGS = 1 << 18, 1 << 20
"""Queries of a batch times passages of the cell, and postings that are added at a time."""
STRIPS = 8
"""Strips of passages per wanted one."""
SLACK = 1e-6
"""Bounds are sums of doubles; a passage is left out only if it falls short by more than this."""


def cell_count(total: int) -> int:
    """Cells for a collection of ``total`` terms."""
    return max(1, min(SMALL_CELLS, math.ceil(total / LEAST_TERMS)), math.ceil(total / CELL_TERMS))


def cell_count_later(size: Column, mean_length: Column) -> Column:
    """``cell_count`` of a collection that is counted when the query runs."""
    total = F.coalesce(size * mean_length, F.lit(0.0))
    small = F.least(F.lit(SMALL_CELLS), F.ceil(total / LEAST_TERMS))
    return F.greatest(F.lit(1), small, F.ceil(total / CELL_TERMS)).cast("int")


class _Cell:
    """A cell's postings by term; passages are numbered in the order of their ids.

    A batch of queries is answered at once, on a table of a row per query and a column per passage. Terms that few
    passages hold bring their postings; a common one is kept as a row of figures, one per passage, as far as
    ``COMMON_FIGURES`` reach, and is added as a whole or met at a few passages.
    """

    def __init__(self, held: pa.Table) -> None:
        named, terms = held.column("pid").combine_chunks(), held.column("term").combine_chunks().dictionary_encode()
        self.terms, self.pids = terms.dictionary, pc.unique(named)
        self.pids = self.pids.take(pc.sort_indices(self.pids))
        at = pc.index_in(named, value_set=self.pids).to_numpy(zero_copy_only=False).astype(np.int64)
        key = terms.indices.to_numpy().astype(np.int64) * len(self.pids) + at
        order = np.argsort(key, kind="stable")
        key, part = key[order], held.column("part").to_numpy()[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        # A passage that comes twice adds up.
        key, part = key[first], np.add.reduceat(part, first) if len(part) else part
        self.docs, self.parts = (key % max(len(self.pids), 1)).astype(np.int32), part
        self.starts = np.searchsorted(key, np.arange(len(self.terms) + 1) * len(self.pids))
        self.most = np.maximum.reduceat(part, self.starts[:-1]) if len(part) else part
        self.common, self.place = None, None

    def _lay_out_common(self) -> None:
        """``common`` has a row of parts for each of the most common terms, ``place`` a term's row or -1."""
        sizes, width = np.diff(self.starts), len(self.pids)
        most = np.argsort(-sizes, kind="stable")[: COMMON_FIGURES // max(width, 1)]
        most = most[sizes[most] * COMMON_SHARE >= width]
        self.place = np.full(len(sizes), -1)
        self.place[most] = np.arange(len(most))
        self.common = np.zeros((len(most), width))
        for row, t in zip(self.common, most, strict=True):
            lo, hi = self.starts[t], self.starts[t + 1]
            row[self.docs[lo:hi]] = self.parts[lo:hi]

    def _add_postings(self, total: np.ndarray, row: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Adds the postings of the terms to their rows of ``total``, about ``MET_POSTINGS`` at a time."""
        sizes, flat = self.starts[terms + 1] - self.starts[terms], total.reshape(-1)
        turn = np.cumsum(sizes) // MET_POSTINGS
        for lo, hi in _stretches(turn):
            n = sizes[lo:hi]
            at = np.arange(n.sum()) + np.repeat(self.starts[terms[lo:hi]] - (np.cumsum(n) - n), n)
            to = np.repeat(row[lo:hi] * total.shape[1], n) + self.docs[at]
            flat += np.bincount(to, np.repeat(weights[lo:hi], n) * self.parts[at], minlength=len(flat))

    def best_of_many(
        self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, spare: int | None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries' numbers, and numbers and rounded scores of the best ``k`` passages of each, best by (score, id).

        The terms and weights of ``n`` queries lie one after another; ``row`` has each term's query.
        """
        batch = max(1, MET_FIGURES // max(len(self.pids), 1))
        cuts = np.searchsorted(row, np.arange(0, n + batch, batch))
        for at, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if lo < hi:
                own = row[lo:hi] - at * batch
                found, docs, score = self._best(own, terms[lo:hi], weights[lo:hi], int(own[-1]) + 1, k, spare)
                yield found + at * batch, docs, score

    def _best(
        self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, spare: int | None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best_of_many`` of one batch.

        With ``spare``, a query whose rarer terms hold that many times k postings takes the k-th best sum of those
        as a floor; where its common terms cannot reach it, they meet only passages that they may lift over it.
        """
        if self.common is None:
            self._lay_out_common()
        width, place = len(self.pids), self.place[terms]
        total, rare, common = np.zeros((n, width)), place < 0, np.flatnonzero(place >= 0)
        self._add_postings(total, row[rare], terms[rare], weights[rare])
        left, found = np.zeros(n, bool), []
        if spare is not None and len(common):
            after = np.bincount(row[common], weights[common] * self.most[terms[common]], minlength=n)
            held = np.bincount(row[rare], (self.starts[terms + 1] - self.starts[terms])[rare], minlength=n)
            tried = np.flatnonzero((after > 0) & (held >= spare * k))
            bound = _least(total[tried], k) - after[tried] - SLACK
            left[tried[bound > 0]] = True
            if left.any():
                met, docs, score = _reaching(total, np.flatnonzero(left), bound[bound > 0])
                # The first common term of each query, then the second: no passage comes twice in a turn.
                mine = common[left[row[common]]]
                turn = np.arange(len(mine)) - np.searchsorted(row[mine], row[mine])
                for t in range(turn.max() + 1):
                    entry = np.full(n, -1)
                    entry[row[mine[turn == t]]] = mine[turn == t]
                    to = np.flatnonzero(entry[met] >= 0)
                    e = entry[met[to]]
                    score[to] += weights[e] * self.common[place[e], docs[to]]
                found.append((met, docs, score))
        added, whole = np.empty(width), np.flatnonzero(~left)
        for e in common[~left[row[common]]]:
            np.multiply(self.common[place[e]], weights[e], out=added)
            total[row[e]] += added
        if len(whole):
            floor = _least(total if len(whole) == n else total[whole], k)
            found.append(_reaching(total, whole, np.where(floor > SLACK, floor - SLACK, np.nextafter(0.0, 1.0))))
        return _first(*map(np.concatenate, zip(*found, strict=True)), n, k)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, spare: int | None) -> tuple[np.ndarray, np.ndarray]:
        """``best_of_many`` of one query."""
        found = list(self.best_of_many(np.zeros(len(terms), np.int64), terms, weights, 1, k, spare))
        return found[0][1:] if found else (np.zeros(0, np.int64), np.zeros(0))


def _least(total: np.ndarray, k: int) -> np.ndarray:
    """A bound under each row's k-th greatest figure, or just that; 0 where there is none.

    Of long rows the k-th greatest of the maxima of strips: k strips hold a figure that is no smaller.
    """
    width = total.shape[1]
    strips = STRIPS * k
    if width >= 4 * strips:
        deep = width // strips
        total = np.maximum(total[:, : strips * deep].reshape(len(total), deep, strips).max(axis=1), 0.0)
        width = strips
    return np.partition(total, width - k, axis=1)[:, width - k] if width >= k else np.zeros(len(total))


def _reaching(total: np.ndarray, rows: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and figures of what reaches its row's bound."""
    own = total if len(rows) == len(total) else total[rows]
    at, docs = np.divmod(np.flatnonzero((own >= bound[:, None]).reshape(-1)), total.shape[1])
    return rows[at], docs, own[at, docs]


def _first(row: np.ndarray, docs: np.ndarray, score: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` of each of ``n`` rows by (rounded score, id), the scores rounded."""
    score = np.floor(score * 10**LEXICAL_PLACES + 0.5)
    kept = (np.bincount(row, minlength=n) <= k)[row]
    many = np.flatnonzero(~kept)
    many = many[np.lexsort((docs[many], -score[many], row[many]))]
    many = many[np.arange(len(many)) - np.searchsorted(row[many], row[many]) < k]
    kept = np.append(np.flatnonzero(kept), many)
    return row[kept], docs[kept], score[kept] / 10**LEXICAL_PLACES


def _stretches(turn: np.ndarray) -> Iterator[tuple[int, int]]:
    """First places of the runs of equal numbers, and the places behind them."""
    cuts = np.append(np.flatnonzero(np.diff(turn, prepend=-1)), len(turn))
    return zip(cuts[:-1], cuts[1:], strict=True)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The batch in pieces of one cell and one kind."""
    cell, kind = batch.column("_cell").to_numpy(), batch.column("_kind").to_numpy()
    for lo, hi in _stretches(cell * 2 + kind):
        yield int(cell[lo]), int(kind[lo]), batch.slice(lo, hi - lo)


def _answers(cell: _Cell, asked: pa.RecordBatch, keys: Sequence[str], k: int, spare: int | None) -> Iterator[pa.RecordBatch]:
    lists = asked.column("terms")
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    at = pc.fill_null(pc.index_in(lists.flatten(), value_set=cell.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    weights = asked.column("weights").flatten().to_numpy()
    row = np.repeat(np.arange(asked.num_rows), np.diff(offsets))
    known = at >= 0
    rows, docs, scores, n = [], [], [], 0

    def made() -> pa.RecordBatch:
        of = pa.array(np.concatenate(rows))
        columns = [asked.column(c).take(of) for c in keys]
        return pa.record_batch([*columns, cell.pids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))], [*keys, "pid", "score"])

    for of, found, score in cell.best_of_many(row[known], at[known], weights[known], asked.num_rows, k, spare):
        rows.append(of)
        docs.append(found)
        scores.append(score)
        n += len(found)
        if n >= 1 << 18:
            yield made()
            rows, docs, scores, n = [], [], [], 0
    if n:
        yield made()


def best_by_cell(
    postings: DataFrame, weights: DataFrame, cells: int | Column, keys: Sequence[str], k: int, spare: int | None = None
) -> DataFrame:
    """``(keys, pid, score)``: of each query the best ``k`` passages of every cell, by rounded score and id.

    ``postings`` has ``(pid, term, part)``, ``weights`` has ``(keys, term, weight)`` with weights above 0;
    the score is the sum of weight times part, all of it positive. ``cells`` as a number makes a task of each;
    as a column, several may share one.
    """
    count = F.lit(cells) if isinstance(cells, int) else cells
    fields = {f.name: f.dataType.simpleString() for f in (*weights.schema.fields, *postings.select("pid", "term", "part").schema.fields)}
    fields |= {"terms": f"array<{fields['term']}>", "weights": "array<double>"}

    def blank(name: str) -> Column:
        """Stands where a kind of row has no value: Spark's Arrow writer goes over a batch's null texts and lists again for each row."""
        empty = F.array() if fields[name].startswith("array") else F.lit("" if fields[name] == "string" else None)
        return empty.cast(fields[name]).alias(name)

    cell = F.pmod(F.xxhash64("pid"), count).cast("int").alias("_cell")
    held = postings.select(cell, F.lit(0).alias("_kind"), "pid", "term", "part", *map(blank, (*keys, "terms", "weights")))
    listed = weights.groupBy(*keys).agg(F.collect_list(F.struct("term", "weight")).alias("w"))
    every = F.explode(F.sequence(F.lit(0), count - 1)).alias("_cell")
    lists = [F.col("w.term").alias("terms"), F.col("w.weight").alias("weights")]
    asked = listed.select(every, F.lit(1).alias("_kind"), *map(blank, ("pid", "term", "part")), *keys, *lists)
    rows = held.unionByName(asked)
    rows = rows.repartitionById(cells, "_cell") if isinstance(cells, int) else rows.repartition("_cell")
    rows = rows.sortWithinPartitions("_cell", "_kind")
    out = ", ".join([*(f"`{c}` {fields[c]}" for c in (*keys, "pid")), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, cell = None, [], None
        for batch in batches:
            for number, kind, piece in _runs(batch):
                if number != at:
                    at, pieces, cell = number, [], None
                if kind == 0:
                    pieces.append(piece.select(["pid", "term", "part"]))
                elif pieces or cell:
                    if cell is None:
                        cell, pieces = _Cell(pa.Table.from_batches(pieces)), []
                    yield from _answers(cell, piece, keys, k, spare)

    return rows.mapInArrow(run, out)
