"""Query expansion: feedback context, prompts, generator answers, feedback terms."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.scores import LEXICAL_PLACES
from rankflow.functions.text import decode_response, normalize_line, terms, truncate_words
from rankflow.operators.metrics import DEFAULT_METRICS, evaluate
from rankflow.operators.numbering import top_within
from rankflow.operators.reporting import leaderboard
from rankflow.operators.scoring import Collection, inverse_frequency, query_terms, score_bm25
from rankflow.session import exists, stage

Generator = Callable[[list[str]], Sequence[str]]


def feedback_rows(candidates: DataFrame, k: int = 3, order: str = "ord") -> DataFrame:
    """The first ``k`` candidates per query with their ``place``, by ``ord`` or ``rank``."""
    return top_within(candidates.withColumn("_by", F.col(order)), ["qid"], [("_by", True), ("pid", True)], k, "place").drop("_by")


def prf_context(candidates: DataFrame, k: int = 3, order: str = "ord") -> DataFrame:
    """``(qid, passages)``: the first ``k`` passages of each query in order."""
    listed = F.array_sort(F.collect_list(F.struct("place", "passage")))
    return (
        feedback_rows(candidates, k, order)
        .groupBy("qid")
        .agg(F.transform(listed, lambda row: row.getField("passage")).alias("passages"))
    )


def _fill(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{name}`` replaced; text from the data is not re-read."""
    pieces: list[Column] = []
    rest = template
    while rest:
        at, name = min(((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest), default=(-1, ""))
        if at < 0:
            pieces.append(F.lit(rest))
            break
        pieces += [F.lit(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*pieces)


def build_prompts(queries: DataFrame, template: str, context: DataFrame | None = None) -> DataFrame:
    """``(qid, prompt)`` from a template with ``{query}`` and, with context, ``{passages}``.

    Passages come numbered from 1 with a blank line between; a query without context gets
    an empty list.
    """
    if context is None:
        return queries.select("qid", _fill(template, {"query": F.col("text")}).alias("prompt"))
    found = F.coalesce("passages", F.array().cast("array<string>"))
    numbered = F.transform(found, lambda p, i: F.concat(F.lit("Passage "), (i + 1).cast("string"), F.lit(": "), p))
    values = {"query": F.col("text"), "passages": F.array_join(numbered, "\n\n")}
    return queries.join(context, "qid", "left").select("qid", _fill(template, values).alias("prompt"))


def expand(prompts: DataFrame, load_generator: Callable[[], Generator], batch_size: int = 16) -> DataFrame:
    """``(qid, response)`` from a caller's generator, loaded once per task."""
    schema = prompts.select("qid", F.col("prompt").alias("response")).schema

    def generate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = load_generator()
        for frame in frames:
            answers: list[str] = []
            for at in range(0, len(frame), batch_size):
                answers.extend(generator(frame["prompt"].iloc[at : at + batch_size].tolist()))
            yield frame[["qid"]].assign(response=answers)

    return prompts.select("qid", "prompt").mapInPandas(generate, schema)


def _tried(generator: Generator, prompts: list[str], tries: int) -> list[tuple[str | None, str | None]]:
    """Answers with the reason where there is none: all at once, then those of a failed call one by one."""

    def call(some: list[str]) -> list[str | None]:
        answers = list(generator(some))
        if len(answers) != len(some):
            raise ValueError(f"{len(answers)} answers to {len(some)} prompts")
        return answers

    def alone(prompt: str) -> tuple[str | None, str | None]:
        reason = None
        for _ in range(tries):
            try:
                answer = call([prompt])[0]
                return answer, "no answer" if answer is None else None
            except Exception as error:  # the caller's model may fail in any way
                reason = f"{type(error).__name__}: {error}"
        return None, reason

    try:
        return [(answer, "no answer" if answer is None else None) for answer in call(prompts)]
    except Exception:  # as above; the prompts are tried one by one
        return [alone(prompt) for prompt in prompts]


ANSWERS = "digest binary, response string, reason string"


def expand_kept(
    prompts: DataFrame,
    load_generator: Callable[[], Generator],
    store: str,
    model: str,
    batch_size: int = 16,
    rounds: int = 8,
    tries: int = 3,
    most_failed: float = 0.0,
) -> DataFrame:
    """``(qid, response, reason)``: ``expand`` that keeps all answers in the table ``store``.

    Answers are kept by a digest of the model's name and the prompt; equal prompts are asked once,
    and a later run asks only those without an answer. Missing ones are asked in ``rounds``, each
    added to the table when it is done. The prompts of a failed call are tried one by one, ``tries``
    times each; one that still fails has a null response and the ``reason``. When more than the share
    ``most_failed`` of the prompts fails, that is an error, raised after all answers are kept. A null
    prompt is not asked and does not count as failed.
    """
    spark = prompts.sparkSession
    named = F.to_json(F.struct(F.lit(model).alias("m"), F.col("prompt").alias("p")))
    marked = stage(prompts.select("qid", "prompt", F.unhex(F.sha2(named, 256)).alias("digest")), "prompts")
    asked = marked.filter("prompt IS NOT NULL").select("digest", "prompt").dropDuplicates(["digest"])
    known = exists(spark, store)
    if known:
        answered = spark.read.schema(ANSWERS).parquet(store).filter("response IS NOT NULL").select("digest")
        asked = asked.join(answered, "digest", "left_anti")
    asked = stage(asked, "unanswered")

    def generate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = load_generator()
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                found = _tried(generator, part["prompt"].tolist(), tries)
                yield part[["digest"]].assign(response=[a for a, _ in found], reason=[r for _, r in found])

    if not known or not asked.isEmpty():
        turn = F.pmod(F.xxhash64("digest"), F.lit(rounds))
        for n in range(rounds):
            asked.filter(turn == n).mapInPandas(generate, ANSWERS).write.mode("append").parquet(store)
    held = spark.read.schema(ANSWERS).parquet(store).groupBy("digest").agg(F.max("response").alias("response"), F.max("reason").alias("reason"))
    met = marked.join(held, "digest", "left")
    why = F.when(F.col("prompt").isNull(), F.lit("no prompt")).when(F.col("response").isNull(), F.col("reason"))
    answers = stage(met.select("qid", "response", why.alias("reason")), "answers")
    n, failed = answers.agg(F.count("*"), F.count_if(F.col("reason") != "no prompt")).first()
    if failed > most_failed * n:
        raise ValueError(f"{failed} of {n} prompts got no answer, more than {most_failed:.2%}; the others are kept in {store}")
    return answers


def clean_expansion(payload: Column | str, max_words: int = 32) -> Column:
    """A generator's JSON answer as one line of at most ``max_words`` words."""
    return truncate_words(normalize_line(decode_response(payload)), max_words)


def apply_expansion(queries: DataFrame, responses: DataFrame, max_words: int = 32, mode: str = "replace") -> DataFrame:
    """``(qid, text)`` with expanded text; an absent or empty answer keeps the original.

    ``append`` puts the expansion behind the original instead of in its place. Of several
    answers to a query the last by ``ord`` counts, or the greatest where there is no ``ord``.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown expansion mode {mode!r}")
    last = F.max_by("response", "ord") if "ord" in responses.columns else F.max("response")
    answers = responses.groupBy("qid").agg(last.alias("response"))
    answers = answers.select("qid", F.nullif(clean_expansion("response", max_words), F.lit("")).alias("_new"))
    new = F.col("_new") if mode == "replace" else F.concat_ws(" ", "text", "_new")
    return queries.join(answers, "qid", "left").select("qid", F.coalesce(new, "text").alias("text"))


def feedback_terms(
    queries: DataFrame, feedback: DataFrame, passages: DataFrame | Collection, m: int = 10
) -> DataFrame:
    """``(qid, term, weight, place)``: the ``m`` best feedback terms not in the query.

    The weight is the term's count in the query's feedback passages times its inverse
    document frequency in the collection.
    """
    collection = Collection.of(passages)
    counts = (
        feedback.select("qid", F.explode(terms("passage")).alias("term"))
        .groupBy("qid", "term")
        .agg(F.count("*").alias("tf"))
        .join(query_terms(queries), ["qid", "term"], "left_anti")
    )
    frequencies = collection.frequencies(counts.select("term").distinct())
    weighted = counts.join(frequencies, "term").withColumn(
        "weight", F.round(F.col("tf") * inverse_frequency(F.col("df"), collection.size), LEXICAL_PLACES)
    )
    best = top_within(weighted, ["qid"], [("weight", False), ("term", True)], m, "place")
    return best.select("qid", "term", "weight", "place")


def expand_terms(
    queries: DataFrame,
    feedback: DataFrame,
    passages: DataFrame | Collection,
    m: int = 10,
    max_words: int | None = None,
) -> DataFrame:
    """``(qid, text)`` with the best feedback terms appended.

    ``max_words`` caps the words that are added; the query keeps all of its own.
    """
    best = feedback_terms(queries, feedback, passages, m)
    listed = F.array_sort(F.collect_list(F.struct("place", "term")))
    added = best.groupBy("qid").agg(F.array_join(F.transform(listed, lambda t: t.getField("term")), " ").alias("_added"))
    new = truncate_words("_added", max_words) if max_words else F.col("_added")
    return queries.join(added, "qid", "left").select("qid", normalize_line(F.concat_ws(" ", "text", new)).alias("text"))


def relevance_model(feedback: DataFrame, m: int = 10) -> DataFrame:
    """``(qid, term, weight)``: the ``m`` likeliest terms of feedback passages ``(qid, pid, score, passage)``.

    A term's likelihood is its share of each passage's terms, passages weighted by their scores.
    Weights of a query add up to 1.
    """
    split = feedback.select("qid", "pid", "score", terms("passage").alias("all"))
    shares = F.col("score") / F.col("total") / F.size("all")
    total = feedback.groupBy("qid").agg(F.sum("score").alias("total"))
    each = split.join(total, "qid").select("qid", shares.alias("share"), F.explode("all").alias("term"))
    likely = each.groupBy("qid", "term").agg(F.round(F.sum("share"), LEXICAL_PLACES).alias("p"))
    best = top_within(likely, ["qid"], [("p", False), ("term", True)], m, "place")
    sums = best.groupBy("qid").agg(F.sum("p").alias("all"))
    return best.join(sums, "qid").select("qid", "term", (F.col("p") / F.col("all")).alias("weight"))


def mix_terms(queries: DataFrame, model: DataFrame, share: float = 0.5) -> DataFrame:
    """``(qid, term, weight)``: each query's own terms mixed with a model's, ``share`` to its own.

    Own terms weigh 1 where the share is 1, so that is the plain query; the model's weights add up
    to as many terms as the query has.
    """
    own = query_terms(queries)
    size = own.groupBy("qid").agg(F.count("*").alias("size"))
    told = model.join(size, "qid").select("qid", "term", ((1 - share) * F.col("size") * F.col("weight")).alias("weight"))
    both = own.withColumn("weight", F.lit(float(share))).unionByName(told)
    mixed = both.groupBy("qid", "term").agg(F.round(F.sum("weight"), LEXICAL_PLACES).alias("weight"))
    return mixed.filter("weight > 0")


def label_variants(variants: dict[str, DataFrame]) -> DataFrame:
    """Query sets stacked under their name: ``(run, qid, text)``."""
    stacked = None
    for name, queries in variants.items():
        part = queries.select(F.lit(name).alias("run"), "qid", "text")
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        raise ValueError("no query variants")
    return stacked


def score_variants(
    variants: DataFrame,
    candidates: DataFrame,
    passages: DataFrame | Collection,
    score: Callable[..., DataFrame] = score_bm25,
) -> DataFrame:
    """Runs ``(run, qid, pid, score)`` of query variants over one candidate set, scored in one job."""
    keys = ["run", "qid"]
    pairs = variants.select(*keys).join(candidates.select("qid", "pid"), "qid")
    return score(pairs, variants, passages, keys=keys)


def run_expansion_experiment(
    variants: DataFrame,
    candidates: DataFrame,
    passages: DataFrame | Collection,
    qrels: DataFrame,
    metrics: Sequence[str] = DEFAULT_METRICS,
    score: Callable[..., DataFrame] = score_bm25,
) -> DataFrame:
    """Result table of query variants ``(run, qid, text)`` over one fixed candidate set.

    All variants are scored, ranked and evaluated in one job, keyed by (run, qid).
    """
    scored = score_variants(variants, candidates, passages, score)
    return leaderboard(evaluate(scored, qrels, metrics), sort=metrics[0])
