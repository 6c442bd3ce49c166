"""Rank fusion over the union of each query's passages.

Input runs are ``(run, qid, pid, rank, score)``. Per-(run, query) figures come from plain
aggregates joined back, not from windows, so a query holding much of the data is combined
map-side and stays spread over (query, passage) hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.scores import FUSED_PLACES
from rankflow.operators.ranking import rank_run
from rankflow.operators.reporting import leaderboard
from rankflow.session import released, stage

METHODS = ("sum", "mnz", "anz", "borda", "rrf")
RRF_K = 60


def canonical_method(name: str) -> str:
    """``comb_sum``, ``combSUM``, ``bordafuse``, ... to one of ``METHODS``."""
    plain = name.lower().replace("_", "").replace("comb", "").replace("fuse", "")
    if plain not in METHODS:
        raise ValueError(f"unknown fusion method {name!r}")
    return plain


def run_figures(runs: DataFrame) -> DataFrame:
    """Per (run, query): score range and length."""
    return runs.groupBy("run", "qid").agg(
        F.min("score").alias("_lo"), F.max("score").alias("_hi"), F.count("*").alias("_len")
    )


def _with_norm(runs: DataFrame, figures: DataFrame) -> DataFrame:
    span = F.col("_hi") - F.col("_lo")
    norm = F.when(span > 0, (F.col("score") - F.col("_lo")) / span).otherwise(0.0)
    return runs.join(figures, ["run", "qid"]).withColumn("norm", norm)


@dataclass(frozen=True)
class Normed:
    """Runs with their normalised scores, and the figures of each (run, query)."""

    rows: DataFrame
    figures: DataFrame

    @staticmethod
    def of(runs: DataFrame | Normed) -> Normed:
        if isinstance(runs, Normed):
            return runs
        figures = run_figures(runs)
        return Normed(_with_norm(runs, figures), figures)

    @staticmethod
    def staged(runs: DataFrame) -> Normed:
        """Both written once, for several fusions of the same runs."""
        rows = stage(Normed.of(runs).rows, "normed")
        figures = rows.groupBy("run", "qid").agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_len").alias("_len"))
        return Normed(rows, stage(figures, "figures"))


def minmax(runs: DataFrame) -> DataFrame:
    """Scores scaled to [0, 1] per (run, query); 0 when all scores are equal."""
    return _with_norm(runs, run_figures(runs)).select("run", "qid", "pid", "rank", F.col("norm").alias("score"))


def _fused_scores(
    normed: DataFrame, figures: DataFrame, keys: Sequence[str], methods: Sequence[str], k: int
) -> DataFrame:
    """``(keys, pid, <one score column per method>)`` from a single aggregate.

    Borda with n passages in the union gives a ranked passage n - rank + 1 and shares the
    rest evenly among the passages a run of length L leaves out, (n - L + 1) / 2 each.
    Adding that share for every run and correcting it where the passage is ranked avoids
    the run x passage grid.
    """
    held = F.col("_held")
    formulas: dict[str, Column] = {
        "sum": F.col("_sum"),
        "mnz": F.col("_sum") * held,
        "anz": F.col("_sum") / held,
        "rrf": F.col("_rrf"),
        "borda": (held + F.col("_runs")) * (F.col("_size") + 1) / 2
        - F.col("_ranks")
        + (F.col("_own") - F.col("_all")) / 2,
    }
    fused = normed.groupBy(*keys, "pid").agg(
        F.count("*").alias("_held"),
        F.sum("norm").alias("_sum"),
        F.sum(1 / (F.lit(float(k)) + F.col("rank"))).alias("_rrf"),
        F.sum("rank").alias("_ranks"),
        F.sum("_len").alias("_own"),
    )
    if "borda" in methods:
        union = fused.groupBy(*keys).agg(F.count("*").alias("_size"))
        lengths = figures.groupBy(*keys).agg(F.count("*").alias("_runs"), F.sum("_len").alias("_all"))
        fused = fused.join(union.join(lengths, list(keys)), list(keys))
    return fused.select(*keys, "pid", *[F.round(formulas[m], FUSED_PLACES).alias(m) for m in methods])


def fuse_scores(runs: DataFrame | Normed, methods: Sequence[str] = METHODS, k: int = RRF_K) -> DataFrame:
    """``(qid, pid, sum, mnz, anz, borda, rrf)``: all methods from one shuffle."""
    methods = [canonical_method(m) for m in methods]
    normed = Normed.of(runs)
    return _fused_scores(normed.rows, normed.figures, ["qid"], methods, k)


def fuse(runs: DataFrame, method: str, k: int = RRF_K, depth: int | None = None) -> DataFrame:
    """One fused run ``(qid, pid, rank, score)``; equal scores in order of pid."""
    method = canonical_method(method)
    scores = fuse_scores(runs, [method], k).withColumnRenamed(method, "score")
    return rank_run(scores, ties="pid", depth=depth, unique=True)


def fuse_all(runs: DataFrame | Normed, methods: Sequence[str] = METHODS, k: int = RRF_K) -> DataFrame:
    """Every method as a run ``(run, qid, pid, score)`` named ``fuse:<method>``."""
    methods = [canonical_method(m) for m in methods]
    return _as_runs(fuse_scores(runs, methods, k), ["qid"], methods, lambda m: F.lit(f"fuse:{m}"))


def _as_runs(scores: DataFrame, keys: Sequence[str], methods: Sequence[str], name) -> DataFrame:
    entries = F.array(*[F.struct(name(m).alias("run"), F.col(m).alias("score")) for m in methods])
    return scores.select("qid", "pid", F.explode(entries).alias("e")).select("e.run", "qid", "pid", "e.score")


def run_pairs(runs: DataFrame) -> DataFrame:
    """All two-run combinations as ``(pair, run)``, two rows each, names in order.

    Each name is paired with the later ones of the sorted list of names.
    """
    listed = runs.select("run").distinct().agg(F.array_sort(F.collect_list("run")).alias("names"))
    firsts = listed.select("names", F.posexplode("names").alias("i", "a"))
    pairs = firsts.select("a", F.explode(F.slice("names", F.col("i") + 2, F.size("names"))).alias("b"))
    return pairs.select(F.concat("a", F.lit("+"), "b").alias("pair"), F.explode(F.array("a", "b")).alias("run"))


def _wanted_pairs(runs: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    rows = [(f"{a}+{b}", run) for a, b in sorted({tuple(sorted(p)) for p in wanted}) for run in (a, b)]
    return runs.sparkSession.createDataFrame(rows, "pair string, run string")


def fuse_pairs(
    runs: DataFrame | Normed, method: str, k: int = RRF_K, wanted: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """Two-run combinations fused, as runs named ``pair:<a>+<b> (<method>)``: the ``wanted`` or all.

    One job for all pairs: each row joins the pairs its run is in. Normalised scores and
    run lengths do not depend on the partner and are worked out once.
    """
    method = canonical_method(method)
    normed = Normed.of(runs)
    pairs = run_pairs(normed.figures) if wanted is None else _wanted_pairs(normed.figures, wanted)
    rows, own = (df.join(pairs, "run") for df in (normed.rows, normed.figures))
    scores = _fused_scores(rows, own, ["pair", "qid"], [method], k)
    return _as_runs(scores, ["pair", "qid"], [method], lambda m: F.concat(F.lit("pair:"), "pair", F.lit(f" ({m})")))


def best_method(results: DataFrame, override: str | None = None, metric: str = "ndcg@10") -> str:
    """The method of the leading ``fuse:<method>`` row; equal leaders in order of name."""
    if override is not None:
        return canonical_method(override)
    fused = results.filter(F.col("system").startswith("fuse:"))
    with released(results.sparkSession):
        leader = leaderboard(fused, metric, n=1).select(F.substring_index("system", ":", -1).alias("method")).first()
    if leader is None:
        raise ValueError("no fused results to pick from")
    return canonical_method(leader["method"])
