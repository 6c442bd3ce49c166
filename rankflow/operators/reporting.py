"""Result tables: order, comparison, and metrics read from log text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.metrics import DEFAULT_METRICS

# How evaluation logs print each metric.
LOG_LABELS = {"ndcg@10": "NDCG@10", "recall@100": "Recall@100", "map@1000": "MAP@1000"}


def standing(metric: str) -> Column:
    """A metric as it counts for order: means that differ by summation order only are equal."""
    return F.round(F.col(f"`{metric}`"), 12)


def leaderboard(results: DataFrame, sort: str | None = None, n: int | None = None) -> DataFrame:
    """Results by a metric, best first, if there is such a column; at most ``n`` rows."""
    if sort is not None and sort in results.columns:
        ties = [c for c in ("source", "system", "model") if c in results.columns]
        results = results.orderBy(standing(sort).desc(), *ties)
    return results if n is None else results.limit(n)


def compare(results: DataFrame, baseline: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """``(system, metric, before, after, change)`` against a baseline table of exactly one row."""

    def tall(table: DataFrame, value: str) -> DataFrame:
        return table.unpivot(["system"], [f"`{m}`" for m in metrics], "metric", value)

    before = tall(baseline, "before").groupBy("metric").agg(F.max("before").alias("before"), F.count("*").alias("_n"))
    one = F.coalesce("_n", F.lit(0)) == 1
    message = F.concat(F.lit("the baseline must be one row, not "), F.coalesce("_n", F.lit(0)).cast("string"))
    return (
        tall(results, "after")
        .join(before, "metric", "left")
        .withColumn("before", F.when(one, F.col("before")).otherwise(F.raise_error(message)))
        .select("system", "metric", "before", "after", (F.col("after") - F.col("before")).alias("change"))
    )


# The distribution function of a Poisson variable of mean 1, at 0 to 6.
POISSON = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406, 0.999917)


def significance(
    scores: DataFrame,
    baseline: str,
    metrics: Sequence[str] = DEFAULT_METRICS,
    rounds: int = 1000,
    seed: int = 0,
    confidence: float = 0.95,
) -> DataFrame:
    """``(system, metric, queries, change, p_value, low, high)`` of per-query ``scores`` ``(run, qid, <metrics>)``.

    Changes are paired by query against the run named ``baseline``. ``p_value`` is the share of
    rounds, the observed one among them, in which flipping signs at random gives a mean change
    as large. ``low`` and ``high`` enclose the mean under resampled queries, each drawn a Poisson
    number of times. Signs and draws come from digests of (seed, round, query), so all systems
    and metrics see the same ones, and rerunning changes nothing. Sums are made round by round
    where the rows are; what moves is one row per system, metric and round.
    """
    tall = scores.unpivot(["run", "qid"], [f"`{m}`" for m in metrics], "metric", "value")
    before = tall.filter(F.col("run") == baseline).select("qid", "metric", F.col("value").alias("before"))
    changes = tall.filter(F.col("run") != baseline).join(before, ["qid", "metric"])
    changes = changes.select(F.col("run").alias("system"), "metric", "qid", (F.col("value") - F.col("before")).alias("d"))
    drawn = changes.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("round").cast("string"), F.col("qid").cast("string")))
    drawn = drawn.withColumn("digest", digest)
    sign = F.when(F.substring("digest", 1, 1) < "8", 1).otherwise(-1)
    u = F.conv(F.substring("digest", 9, 8), 16, 10).cast("double") / float(1 << 32)
    times = sum((F.when(u >= p, 1).otherwise(0) for p in POISSON), F.lit(0))
    drawn = drawn.withColumns({"sign": sign, "times": times})
    by_round = drawn.groupBy("system", "metric", "round").agg(
        F.count("*").alias("n"),
        F.sum("d").alias("sum"),
        F.sum(F.col("sign") * F.col("d")).alias("flipped"),
        (F.sum(F.col("times") * F.col("d")) / F.nullif(F.sum("times"), F.lit(0))).alias("mean"),
    )
    tail = (1 - confidence) / 2
    as_large = F.count_if(F.abs("flipped") >= F.abs("sum") - 1e-9)
    return by_round.groupBy("system", "metric").agg(
        F.max("n").alias("queries"),
        F.avg(F.col("sum") / F.col("n")).alias("change"),
        ((as_large + 1) / (rounds + 1)).alias("p_value"),
        F.percentile("mean", F.lit(tail)).alias("low"),
        F.percentile("mean", F.lit(1 - tail)).alias("high"),
    )


def log_lines(percents: DataFrame) -> DataFrame:
    """A percent table as log text ``(log, ord, line)``, one line per figure."""
    entries = [F.concat(F.lit("Queries: "), F.col("queries").cast("string"))] + [
        F.concat(F.lit(f"{label}: "), F.format_string("%.2f", F.col(f"`{metric}`"))) for metric, label in LOG_LABELS.items()
    ]
    return percents.select(F.col("system").alias("log"), F.posexplode(F.array(*entries)).alias("ord", "line"))


def parse_metrics(lines: DataFrame) -> DataFrame:
    """``(system, <metrics>)`` from log text; the first figure counts, a missing one fails."""

    def first_figure(metric: str):
        figure = F.nullif(F.regexp_extract("line", rf"{LOG_LABELS[metric]}:\s*([0-9.]+)", 1), F.lit(""))
        return F.min_by(figure, F.when(figure.isNotNull(), F.col("ord"))).cast("double").alias(metric)

    found = lines.groupBy(F.col("log").alias("system")).agg(*[first_figure(m) for m in LOG_LABELS])

    def required(metric: str):
        message = F.concat(F.lit(f"no {metric} in log "), F.col("system"))
        value = F.col(f"`{metric}`")
        return F.when(value.isNotNull(), value).otherwise(F.raise_error(message)).alias(metric)

    return found.select("system", *[required(m) for m in LOG_LABELS])
