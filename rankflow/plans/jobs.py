"""File-to-file jobs, one per step of a ranking experiment.

Each reads the line formats of ``rankflow.sources.files``, chains operators and writes its
results. Inputs that a job reads more than once are staged as tables first, so a gzip file
is unpacked once and later steps have splits to spread over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankflow.functions.scores import as_percent
from rankflow.functions.text import truncate_words
from rankflow.operators import expansion, fusion, metrics, ranker, reporting, samples, scoring, text_ranker
from rankflow.operators.numbering import number_blocks
from rankflow.operators.ranking import judged_queries, rank_run
from rankflow.session import exists, shared_folder, stage
from rankflow.sources import files, sinks


def prepare_training(
    spark: SparkSession,
    dev_triples: str,
    train_triples: str,
    queries: str,
    passages: str,
    out: str,
    dev_count: int = 200,
    max_negatives: int = 200,
    ratio: int = 4,
    max_samples: int | None = None,
    batch_size: int = 32,
    seed: int = 0,
    min_passages: int | None = None,
    full_corpus: bool = False,
) -> DataFrame:
    """Write ``out/train`` and ``out/dev``; return the one-row sample summary.

    Texts come from the needed part of the collection, or from all of it if ``full_corpus``.
    """
    asked = files.read_queries(spark, queries)
    for_dev = stage(files.read_triples(spark, dev_triples), "dev-triples")
    for_training = stage(files.read_triples(spark, train_triples), "train-triples")
    collection = files.read_passages(spark, passages)
    if min_passages is not None:
        samples.require_min_rows(collection, min_passages)

    dev = samples.dev_samples(for_dev, dev_count, max_negatives)
    chosen = stage(
        samples.training_samples(for_training, samples.select_dev_queries(for_dev, dev_count), ratio, max_samples), "samples"
    )
    held = collection
    if not full_corpus:
        held = stage(samples.subset_passages(collection, samples.needed_passages(dev, chosen)), "passages")
    texts, summary = samples.materialize_counted(chosen, asked, held)
    batches = samples.assign_batches(texts, "n", batch_size, seed, rows=summary.first()["loaded"])
    batches.write.parquet(f"{out}/train")
    samples.materialize_dev(dev, asked, held).write.parquet(f"{out}/dev")
    return summary


def _collection(candidates: DataFrame, passages: DataFrame | None) -> scoring.Collection:
    """Term statistics of the whole collection, or of the candidates where it is not given."""
    if passages is None:
        last = candidates.groupBy("pid").agg(F.max("ord").alias("ord"))
        passages = candidates.join(last, ["pid", "ord"]).select("pid", F.col("passage").alias("text"))
    return scoring.Collection.staged(passages.select("pid", "text"))


def _whole(spark: SparkSession, passages: str | None) -> DataFrame | None:
    return None if passages is None else files.read_passages(spark, passages)


def rerank(
    queries: DataFrame,
    candidates: DataFrame,
    passages: DataFrame | None = None,
    load_scorer: Callable[[], scoring.Scorer] | None = None,
    batch_size: int = 64,
    depth: int | None = None,
    max_words: int | None = None,
    keep_scores: str | None = None,
    model: str = "",
) -> DataFrame:
    """Score candidates with a model, or BM25 without one, and rank them per query.

    ``max_words`` caps the words of each text that the model is given. ``keep_scores`` names a table
    that keeps the scores of the ``model`` of that name, for later runs and after a loss.
    """
    if load_scorer is not None:
        pairs = scoring.build_pairs(queries, candidates)
        if max_words is not None:
            pairs = pairs.withColumns({c: truncate_words(c, max_words) for c in ("query", "passage")})
        if keep_scores is not None:
            return rank_run(scoring.score_kept(pairs, load_scorer, keep_scores, model, batch_size), "ord", depth)
        return rank_run(stage(scoring.score_pairs(pairs, load_scorer, batch_size, even=True), "scores"), "ord", depth)
    pairs = candidates.join(queries.select("qid"), "qid", "left_semi")
    scores = scoring.score_bm25(pairs, queries, _collection(candidates, passages))
    first = pairs.groupBy("qid", "pid").agg(F.min("ord").alias("ord"))
    return rank_run(scores.join(first, ["qid", "pid"]), "ord", depth, unique=True)


def evaluate_candidates(
    spark: SparkSession,
    queries: str,
    candidates: str,
    qrels: str,
    out_run: str,
    passages: str | None = None,
    judged_only: bool = False,
    rank_base: int = 1,
    tag: str = "STANDARD",
    load_scorer: Callable[[], scoring.Scorer] | None = None,
    batch_size: int = 64,
    max_words: int | None = None,
    min_grade: int | None = None,
    keep_scores: str | None = None,
    model: str = "",
) -> DataFrame:
    """Rank a candidate file, write the run, return its metrics in percent."""
    asked = files.read_queries(spark, queries, strict=True)
    judged = files.read_qrels(spark, qrels, min_grade)
    if judged_only:
        asked = judged_queries(asked, judged)
    offered = stage(files.read_candidates(spark, candidates), "candidates")
    kept = {"max_words": max_words, "keep_scores": keep_scores, "model": model}
    run = stage(rerank(asked, offered, _whole(spark, passages), load_scorer, batch_size, **kept), "run")
    sinks.write_run(run, out_run, tag, rank_base)
    named = run.withColumn("run", F.lit(files.run_name(out_run)))
    return as_percent(metrics.evaluate(named, judged))


def train_ranker(spark: SparkSession, prepared: str, queries: str, passages: str, out: str) -> DataFrame:
    """Fit the feature ranker on what ``prepare_training`` wrote, save it in ``out``, return its
    reciprocal rank on the dev samples."""
    asked = stage(files.read_queries(spark, queries), "queries")
    collection = scoring.Collection.staged(files.read_passages(spark, passages))
    train, dev = (spark.read.parquet(f"{prepared}/{part}") for part in ("train", "dev"))
    labelled = train.groupBy("qid", "pid").agg(F.max("label").cast("double").alias("label"))
    features = scoring.rank_features(labelled.select("qid", "pid"), asked, collection).join(labelled, ["qid", "pid"])
    model = ranker.fit_ranker(stage(features, "features"))
    model.write().overwrite().save(out)
    tried = scoring.rank_features(dev.select("qid", "pid").distinct(), asked, collection)
    scored = dev.select("qid", "pid", "is_pos").join(ranker.score_with_ranker(model, tried), ["qid", "pid"])
    return metrics.reranking_mrr(scored)


def _text_features(rows: DataFrame, asked: DataFrame, collection: scoring.Collection) -> DataFrame:
    """Rows of ``qid``, ``pid``, ``query`` and ``passage`` with slots and lexical figures in place of the texts."""
    figures = scoring.rank_features(rows.select("qid", "pid").distinct(), asked, collection)
    return text_ranker.with_slots(rows).join(figures, ["qid", "pid"])


def train_text_ranker(
    spark: SparkSession,
    prepared: str,
    queries: str,
    passages: str,
    out: str,
    steps: int,
    batches_per_step: int = 4,
    every: int = 1,
    rate: float = 1.0,
    epochs: int = 1,
    batch_size: int = 32,
    seed: int = 0,
) -> DataFrame:
    """Train the text ranker in steps on what ``prepare_training`` wrote; return ``(step, mrr)`` of the steps tried.

    Batches are drawn anew in each of ``epochs`` and taken one after another. Steps are stored in
    ``out``: called again, the job goes on after the last one, to the same weights.
    """
    asked = stage(files.read_queries(spark, queries), "queries")
    collection = scoring.Collection.staged(files.read_passages(spark, passages))
    train, dev = (spark.read.parquet(f"{prepared}/{part}") for part in ("train", "dev"))
    made = stage(_text_features(train.select("n", "qid", "pid", "query", "passage", "label"), asked, collection), "train-features")
    tried = stage(_text_features(dev, asked, collection), "dev-features")
    means, deviations = text_ranker.kept_scaling(made, out)
    rows = made.count()
    blocked = text_ranker.with_figures(made, means, deviations).withColumn("block", F.floor(F.col("n") / 4096))
    numbered = number_blocks(blocked, [], "block", [("n", True)], "at").withColumn("at", F.col("at") - 1)
    drawn = samples.epoch_batches(numbered, rows, epochs, key="at", size=batch_size, seed=seed)
    batch = F.col("epoch") * F.lit(-(-rows // batch_size)) + F.col("batch")
    batches = stage(drawn.select(batch.alias("batch"), "slots", "figures", "label"), "batches")
    dev_rows = text_ranker.with_figures(tried, means, deviations)
    return text_ranker.train(batches, stage(dev_rows, "dev-scaled"), out, steps, batches_per_step, rate, every=every).orderBy("step")


def rerank_candidates(
    spark: SparkSession,
    model: str,
    queries: str,
    candidates: str,
    out_run: str,
    passages: str | None = None,
    rank_base: int = 1,
    tag: str = "RANKER",
) -> DataFrame:
    """Rank a candidate file with a saved ranker of either kind, write the run and return it.

    Of a text ranker the weights of the best step count.
    """
    asked = stage(files.read_queries(spark, queries), "queries")
    offered = stage(files.read_candidates(spark, candidates), "candidates")
    collection = _collection(offered, _whole(spark, passages))
    if exists(spark, f"{model}/tried"):
        features = _text_features(scoring.build_pairs(asked, offered), asked, collection)
        features = text_ranker.with_figures(features, *text_ranker.kept_scaling(features, model))
        scores = text_ranker.scored(features, text_ranker.best_weights(spark, model)[1])
        run = stage(rank_run(scores.select("ord", "qid", "pid", "score"), "ord"), "run")
    else:
        first = offered.join(asked.select("qid"), "qid", "left_semi").groupBy("qid", "pid").agg(F.min("ord").alias("ord"))
        features = scoring.rank_features(first.select("qid", "pid"), asked, collection)
        scores = ranker.score_with_ranker(ranker.load_ranker(model), features)
        run = stage(rank_run(scores.join(first, ["qid", "pid"]), "ord", unique=True), "run")
    sinks.write_run(run, out_run, tag, rank_base)
    return run


def fuse_runs(
    spark: SparkSession,
    qrels: str,
    runs: Sequence[str],
    out: str,
    methods: Sequence[str] = fusion.METHODS,
    best: str | None = None,
) -> dict[str, DataFrame]:
    """Write and return the tables of single runs, of all fusions, and of all pairs.

    Runs are ranked anew by score: files may count ranks from 0 or out of step with scores.
    """
    judged = stage(files.read_qrels(spark, qrels), "qrels")
    read = files.read_runs(spark, runs)
    held = stage(rank_run(read, ties="pid", keys=["run", "qid"], unique=True), "runs")
    normed = fusion.Normed.staged(held)

    def table(name: str, systems: DataFrame) -> DataFrame:
        results = stage(metrics.evaluate(systems, judged), name).select("system", *metrics.DEFAULT_METRICS)
        ordered = reporting.leaderboard(results, "ndcg@10")
        sinks.write_results(ordered, f"{out}/{name}")
        return ordered

    single = table("base_models", held)
    fused = table("all_runs_fused", fusion.fuse_all(normed, methods))
    paired = table("pairs_fused", fusion.fuse_pairs(normed, fusion.best_method(fused, best)))
    return {"single": single, "fused": fused, "paired": paired}


def _answered(
    asked: DataFrame,
    template: str,
    offered: DataFrame | None,
    load_generator: Callable[[], expansion.Generator],
    feedback: int,
    max_words: int,
    keep_answers: str | None,
    model: str,
    most_failed: float,
) -> DataFrame:
    """Queries expanded by a generator; those without an answer stay as they are."""
    context = None if offered is None or "{passages}" not in template else expansion.prf_context(offered, feedback)
    prompts = expansion.build_prompts(asked, template, context)
    store = keep_answers or shared_folder(asked.sparkSession, "kept-answers")
    answers = expansion.expand_kept(prompts, load_generator, store, model, most_failed=most_failed)
    return expansion.apply_expansion(asked, answers.filter("response IS NOT NULL"), max_words)


def expand_queries(
    spark: SparkSession,
    queries: str,
    out: str,
    candidates: str | None = None,
    feedback: int = 3,
    max_words: int = 32,
    template: str | None = None,
    load_generator: Callable[[], expansion.Generator] | None = None,
    terms: int = 10,
    passages: str | None = None,
    keep_answers: str | None = None,
    model: str = "",
    most_failed: float = 0.0,
) -> DataFrame:
    """Write ``qid<TAB>text`` with expanded queries and return them.

    With a generator, prompts come from ``template`` and its answers replace the queries;
    without one, feedback terms from the candidates are appended. ``max_words`` caps what
    is added, never the query. Term statistics are those of ``passages``, or of the candidates.
    ``keep_answers`` names a table that keeps the answers of the ``model`` of that name, for later
    runs and after a loss; up to the share ``most_failed`` of the queries may stay without one.
    """
    asked = files.read_queries(spark, queries)
    offered = None if candidates is None else stage(files.read_candidates(spark, candidates), "candidates")
    if load_generator is not None:
        if template is None:
            raise ValueError("a generator needs a prompt template")
        expanded = _answered(asked, template, offered, load_generator, feedback, max_words, keep_answers, model, most_failed)
    elif offered is not None:
        rows = expansion.feedback_rows(offered, feedback)
        expanded = expansion.expand_terms(asked, rows, _collection(offered, _whole(spark, passages)), terms, max_words)
    else:
        raise ValueError("expansion needs a generator or candidates")
    expanded = stage(expanded, "expanded")
    sinks.write_queries(expanded, out)
    return expanded


def compare_expansions(
    spark: SparkSession,
    queries: dict[str, str],
    candidates: str,
    qrels: str,
    out: str,
    baseline: str | None = None,
    passages: str | None = None,
) -> DataFrame:
    """Evaluate query files over one candidate set and write the result table.

    With ``baseline`` naming one of them, the changes against it are written as well.
    """
    sets = {name: files.read_queries(spark, path) for name, path in queries.items()}
    offered = stage(files.read_candidates(spark, candidates), "candidates")
    judged = files.read_qrels(spark, qrels)
    return _compared(sets, offered, _collection(offered, _whole(spark, passages)), judged, out, baseline)


def _compared(
    sets: dict[str, DataFrame],
    offered: DataFrame,
    collection: scoring.Collection,
    judged: DataFrame,
    out: str,
    baseline: str | None,
) -> DataFrame:
    """The result table of query sets over one candidate set, written with the changes against ``baseline``."""
    variants = stage(expansion.label_variants(sets), "variants")
    results = stage(expansion.run_expansion_experiment(variants, offered, collection, judged), "results")
    results = reporting.leaderboard(results.select("system", *metrics.DEFAULT_METRICS), "ndcg@10")
    sinks.write_results(results, f"{out}/expansions")
    if baseline is not None:
        changes = reporting.compare(results, results.filter(F.col("system") == baseline))
        sinks.write_results(changes, f"{out}/changes")
    return results


PLAIN, FED = "plain", "feedback"
"""Names of the query sets that every experiment has."""


def expansion_experiment(
    spark: SparkSession,
    queries: str,
    candidates: str,
    qrels: str,
    out: str,
    templates: dict[str, str] | None = None,
    load_generator: Callable[[], expansion.Generator] | None = None,
    feedback: int = 3,
    max_words: int = 32,
    terms: int = 10,
    passages: str | None = None,
    keep_answers: str | None = None,
    model: str = "",
    most_failed: float = 0.0,
) -> DataFrame:
    """From queries to the table of all their expansions, in one job.

    The plain queries, those with feedback terms, and with a generator one set per prompt template
    are written to ``out/queries``, scored over one candidate set and compared with the plain ones.
    A template with ``{passages}`` gets the first ``feedback`` candidates.
    """
    templates = templates or {}
    if templates and load_generator is None:
        raise ValueError("prompt templates need a generator")
    if {PLAIN, FED} & set(templates):
        raise ValueError(f"templates may not be called {PLAIN} or {FED}")
    asked = stage(files.read_queries(spark, queries), "queries")
    offered = stage(files.read_candidates(spark, candidates), "candidates")
    collection = _collection(offered, _whole(spark, passages))
    sets = {PLAIN: asked, FED: expansion.expand_terms(asked, expansion.feedback_rows(offered, feedback), collection, terms, max_words)}
    for name, template in templates.items():
        sets[name] = _answered(asked, template, offered, load_generator, feedback, max_words, keep_answers, model, most_failed)
    for name, made in sets.items():
        sets[name] = made if name == PLAIN else stage(made, "expanded")
        sinks.write_queries(sets[name], f"{out}/queries/{name}")
    return _compared(sets, offered, collection, files.read_qrels(spark, qrels), out, PLAIN)


def summarize(spark: SparkSession, tables: Sequence[str], sort: str | None = None, head: int | None = None) -> DataFrame:
    """Rows of several result CSVs of any columns, best first by ``sort``, at most ``head`` of each."""
    whole = files.union_results(spark, tables)
    if head is not None:
        order = [reporting.standing(sort).desc()] if sort in whole.columns else []
        place = F.row_number().over(W.partitionBy("source").orderBy(*order, F.monotonically_increasing_id()))
        whole = whole.withColumn("_place", place).filter(F.col("_place") <= head).drop("_place")
    return reporting.leaderboard(whole, sort)
