"""Every registered query by name, each over the whole input tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.scores import as_percent, positive_softmax
from rankflow.functions.text import normalize_line, terms, truncate_words
from rankflow.operators import expansion, fusion, metrics, ranker, reporting, samples, scoring, text_ranker
from rankflow.operators.index import retrieve_indexed
from rankflow.operators.numbering import number_blocks
from rankflow.operators.ranking import judged_queries, rank_run
from rankflow.plans.fixtures import CANDIDATES, DEV_NEGATIVES, DEV_QUERIES, FEEDBACK, HELD_OUT, Inputs
from rankflow.session import shared_folder, stage
from rankflow.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METRICS = metrics.DEFAULT_METRICS
PROMPT = "Rewrite this search query.\nQuery: {query}\nAnswer:"
FEEDBACK_PROMPT = "Rewrite this search query.\nQuery: {query}\n\n{passages}\n\nAnswer:"
SAMPLE_CAP = 5000
ANSWER_WORDS = 32
PAIRS_PER_FILE = 4096


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Columns at six places, by arithmetic that every engine does alike."""
    return df.withColumns({c: F.floor(F.col(f"`{c}`") * 1e6 + 0.5) / 1e6 for c in columns})


# --- ranking and metrics ---


@query
def ranked_candidates(i: Inputs) -> DataFrame:
    return rank_run(i.scored, ties="ord")


@query
def ranked_runs(i: Inputs) -> DataFrame:
    return i.ranked_runs()


@query
def query_metrics(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate_queries(i.unranked_runs, i.qrels), *METRICS)


@query
def run_metrics(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate(i.unranked_runs, i.qrels), *METRICS)


@query
def run_metrics_short(i: Inputs) -> DataFrame:
    names = ["ndcg@50", "recall@50", "map@50", "mrr@50"]
    return _rounded(metrics.evaluate(i.unranked_runs, i.qrels, names), *names)


@query
def run_metrics_all_judged(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate(i.unranked_runs, i.qrels, queries="qrels"), *METRICS)


@query
def run_metrics_trec_ties(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate(i.unranked_runs, i.qrels, ties="trec"), *METRICS)


@query
def run_metrics_strict_grades(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate(i.unranked_runs, i.qrels, min_rel=2), *METRICS)


@query
def run_metrics_unjudged_run(i: Inputs) -> DataFrame:
    """A run of other queries than the judged ones is listed with zeros."""
    elsewhere = i.unranked_runs.filter("run = 'open'").withColumns({"run": F.lit("elsewhere"), "qid": F.col("qid") + 10_000_000})
    return _rounded(metrics.evaluate(i.unranked_runs.unionByName(elsewhere), i.qrels, queries="qrels"), *METRICS)


@query
def run_metrics_strict(i: Inputs) -> DataFrame:
    """Runs cut to the queries that all of them and the judgements hold."""
    runs = i.unranked_runs
    in_all = runs.groupBy("qid").agg(F.count_distinct("run").alias("n")).filter("n = 3").select("qid")
    judged = i.qrels.join(in_all, "qid", "left_semi")
    kept = runs.join(judged.select("qid").distinct(), "qid", "left_semi")
    return _rounded(metrics.evaluate(kept, judged, queries="strict"), *METRICS)


@query
def run_metrics_percent(i: Inputs) -> DataFrame:
    return as_percent(metrics.evaluate(i.unranked_runs, i.qrels))


@query
def queries_with_relevant(i: Inputs) -> DataFrame:
    asked = i.table("supplier").select(F.col("s_suppkey").alias("qid"), F.col("s_name").alias("text"))
    return judged_queries(asked, i.qrels)


# --- fusion ---


@query
def normalized_runs(i: Inputs) -> DataFrame:
    return _rounded(fusion.minmax(i.runs), "score")


def _fused(method: str) -> None:
    def build(i: Inputs) -> DataFrame:
        return _rounded(fusion.fuse(i.runs, method), "score")

    build.__name__ = f"fused_{method}"
    query(build)


for _method in fusion.METHODS:
    _fused(_method)


@query
def fused_scores(i: Inputs) -> DataFrame:
    return _rounded(fusion.fuse_scores(i.runs), *fusion.METHODS)


@query
def fusion_metrics(i: Inputs) -> DataFrame:
    return _rounded(metrics.evaluate(fusion.fuse_all(i.runs), i.qrels), *METRICS)


@query
def fusion_leader(i: Inputs) -> DataFrame:
    table = reporting.leaderboard(metrics.evaluate(fusion.fuse_all(i.runs), i.qrels), sort="ndcg@10", n=1)
    return table.select("system")


@query
def pair_metrics(i: Inputs) -> DataFrame:
    normed = fusion.Normed.staged(i.ranked_runs())
    best = fusion.best_method(metrics.evaluate(fusion.fuse_all(normed), i.qrels))
    return _rounded(metrics.evaluate(fusion.fuse_pairs(normed, best), i.qrels), *METRICS)


@query
def all_systems(i: Inputs) -> DataFrame:
    runs = i.runs
    every = runs.select("run", "qid", "pid", "score").unionByName(fusion.fuse_all(runs))
    table = metrics.evaluate(every, i.qrels)
    return _rounded(reporting.leaderboard(table, sort="ndcg@10", n=50), *METRICS)


# --- samples ---


def _labelled(i: Inputs, m: int | None = None) -> DataFrame:
    held_out = samples.select_dev_queries(i.triples, HELD_OUT)
    return samples.training_samples(i.triples, held_out, ratio=4, m=m, block_rows=4096)


def _text_dev(i: Inputs, n: int = DEV_QUERIES) -> DataFrame:
    return samples.dev_samples(i.text_triples, n, DEV_NEGATIVES)


def _text_samples(i: Inputs) -> DataFrame:
    held_out = samples.select_dev_queries(i.text_triples, HELD_OUT)
    return samples.training_samples(i.triples, held_out, ratio=4, block_rows=4096)


@query
def dev_queries(i: Inputs) -> DataFrame:
    return samples.select_dev_queries(i.triples, DEV_QUERIES)


@query
def dev_sample_ids(i: Inputs) -> DataFrame:
    return samples.dev_samples(i.triples, DEV_QUERIES, DEV_NEGATIVES)


@query
def training_triples(i: Inputs) -> DataFrame:
    return samples.exclude_dev(i.triples, samples.select_dev_queries(i.triples, HELD_OUT)).select("ord", "qid", "pos_id", "neg_id")


@query
def training_sample_ids(i: Inputs) -> DataFrame:
    return _labelled(i).withColumn("label", F.col("label").cast("bigint"))


@query
def capped_sample_ids(i: Inputs) -> DataFrame:
    return _labelled(i, SAMPLE_CAP).withColumn("label", F.col("label").cast("bigint"))


@query
def needed_passage_ids(i: Inputs) -> DataFrame:
    dev = samples.dev_samples(i.triples, DEV_QUERIES, DEV_NEGATIVES)
    return samples.needed_passages(dev, _labelled(i))


@query
def needed_collection(i: Inputs) -> DataFrame:
    return samples.subset_passages(i.passages, needed_passage_ids(i))


@query
def missing_passage_ids(i: Inputs) -> DataFrame:
    held = samples.require_min_rows(i.labelled_passages, 1)
    return samples.missing_passages(needed_passage_ids(i), held)


@query
def missing_document_ids(i: Inputs) -> DataFrame:
    return samples.missing_passages(needed_passage_ids(i), i.passages)


@query
def all_training_texts(i: Inputs) -> DataFrame:
    """Training texts over the whole collection, as with a full corpus."""
    made = samples.materialize_samples(_text_samples(i), i.openings, i.passages)
    return made.withColumn("label", F.col("label").cast("bigint"))


@query
def training_texts(i: Inputs) -> DataFrame:
    made = samples.materialize_samples(_text_samples(i), i.openings, i.labelled_passages)
    return made.withColumn("label", F.col("label").cast("bigint"))


@query
def dev_texts(i: Inputs) -> DataFrame:
    return samples.materialize_dev(_text_dev(i), i.openings, i.labelled_passages)


@query
def dev_lists(i: Inputs) -> DataFrame:
    nested = samples.nest_dev(samples.materialize_dev(_text_dev(i), i.openings, i.labelled_passages))
    joined = [F.array_join(c, "\n").alias(c) for c in ("positive", "negative")]
    return nested.select("qid", "part", "query", *joined)


@query
def training_batches(i: Inputs) -> DataFrame:
    batches = samples.assign_batches(_labelled(i).select("n", "qid", "pid", "label"), key="n", size=32, seed=7)
    return batches.withColumn("label", F.col("label").cast("bigint"))


@query
def epoch_batches(i: Inputs) -> DataFrame:
    """Two epochs over the training samples, each in an order of its own."""
    labelled = stage(_labelled(i).select("n", "qid", "pid", F.col("label").cast("bigint").alias("label")), "labelled")
    placed = samples.epoch_batches(labelled, labelled.count(), epochs=2, size=32, seed=7)
    return placed.withColumns({c: F.col(c).cast("bigint") for c in ("epoch", "batch", "place")})


@query
def training_summary(i: Inputs) -> DataFrame:
    """Counted while the training texts are written."""
    return samples.materialize_counted(stage(_text_samples(i), "labelled"), i.openings, i.labelled_passages)[1]


# --- scoring ---


@query
def bm25_top(i: Inputs) -> DataFrame:
    """Whole-collection retrieval at the usual run depth."""
    return _rounded(scoring.retrieve(i.queries, i.counted, k=1000), "score")


@query
def bm25_bounded_top(i: Inputs) -> DataFrame:
    """Shallow retrieval in which common terms meet only passages that can still be listed."""
    return _rounded(scoring.retrieve(i.queries, i.collection, k=10, spare=8), "score")


@query
def bm25_indexed_top(i: Inputs) -> DataFrame:
    """The same depth from an inverted index whose blocks are skipped where they cannot matter."""
    return _rounded(retrieve_indexed(i.queries, i.index, k=1000), "score")


@query
def bm25_indexed_again(i: Inputs) -> DataFrame:
    """Another query set on the same index: document openings, shallow."""
    return _rounded(retrieve_indexed(i.openings, i.index, k=10), "score")


@query
def bm25_merged_top(i: Inputs) -> DataFrame:
    return _rounded(scoring.retrieve(i.queries, i.counted, k=CANDIDATES, fanout=4), "score")


@query
def bm25_reranked(i: Inputs) -> DataFrame:
    """Retrieved candidates scored again under other length settings."""
    scored = scoring.score_bm25(i.pairs.select("qid", "pid"), i.queries, i.collection, k1=1.2, b=0.75)
    return _rounded(rank_run(scored, ties="pid", unique=True), "score")


@query
def retrieval_metrics(i: Inputs) -> DataFrame:
    run = scoring.retrieve(i.queries, i.counted, k=1000).withColumn("run", F.lit("bm25"))
    return _rounded(metrics.evaluate(run, i.text_qrels), *METRICS)


@query
def holding_documents(i: Inputs) -> DataFrame:
    return i.text_qrels.withColumn("rel", F.col("rel").cast("bigint"))


@query
def candidate_pairs(i: Inputs) -> DataFrame:
    return scoring.build_pairs(i.queries, i.candidates)


def shared_word_scorer() -> scoring.Scorer:
    """Share of the query's distinct words found in the passage, as a stand-in model."""

    def score(asked: list[str], held: list[str]) -> list[float]:
        pairs = [(set(q.split()), set(p.split())) for q, p in zip(asked, held, strict=True)]
        return [len(q & p) / len(q) if q else 0.0 for q, p in pairs]

    return score


@query
def model_scored_pairs(i: Inputs) -> DataFrame:
    pairs = scoring.build_pairs(i.queries, i.candidates)
    staged = stage(scoring.score_pairs(pairs, lambda: shared_word_scorer()), "scores")
    return _rounded(rank_run(staged, ties="ord"), "score")


@query
def even_scored_pairs(i: Inputs) -> DataFrame:
    """The same pairs in batches of like length."""
    pairs = scoring.build_pairs(i.queries, i.candidates)
    staged = stage(scoring.score_pairs(pairs, lambda: shared_word_scorer(), even=True), "scores")
    return _rounded(rank_run(staged, ties="ord"), "score")


def no_scorer() -> scoring.Scorer:
    """Stands for a model that must not be called any more."""

    def score(asked: list[str], held: list[str]) -> list[float]:
        raise RuntimeError(f"{len(asked)} pairs are scored again")

    return score


@query
def kept_pair_scores(i: Inputs) -> DataFrame:
    """Scored once and kept; the second run finds every score and calls no model."""
    pairs = scoring.build_pairs(i.queries, i.candidates)
    store = shared_folder(i.spark, "kept-scores")
    scoring.score_kept(pairs, lambda: shared_word_scorer(), store, "shared words", rounds=2)
    again = scoring.score_kept(pairs, lambda: no_scorer(), store, "shared words")
    return _rounded(rank_run(again, ties="ord"), "score")


@query
def softmax_scores(i: Inputs) -> DataFrame:
    logits = F.array(F.col("l_discount") * 10, F.col("l_quantity") / 10, F.col("l_tax") * 10)
    rows = i.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", positive_softmax(logits).alias("score")
    )
    return _rounded(rows.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")), "score")


@query
def truncated_texts(i: Inputs) -> DataFrame:
    return i.passages.select("pid", truncate_words("text", 512).alias("text"))


@query
def dev_reciprocal_rank(i: Inputs) -> DataFrame:
    dev = stage(_text_dev(i).join(i.passages.select("pid"), "pid", "left_semi"), "dev")
    scored = scoring.score_bm25(dev.select("qid", "pid"), i.openings, i.collection)
    return _rounded(metrics.reranking_mrr(dev.join(scored, ["qid", "pid"])), "mrr@10")


@query
def pair_features(i: Inputs) -> DataFrame:
    return _rounded(scoring.rank_features(i.pairs.select("qid", "pid"), i.queries, i.collection), "bm25")


def _training_features(i: Inputs) -> DataFrame:
    """Labels and lexical features of the training samples that have both texts.

    A pair drawn both as positive and as negative counts as positive.
    """
    kept = samples.materialize_samples(_text_samples(i), i.openings, i.passages)
    pairs = kept.groupBy("qid", "pid").agg(F.max("label").cast("double").alias("label"))
    return scoring.rank_features(pairs.select("qid", "pid"), i.openings, i.collection).join(pairs, ["qid", "pid"])


@query
def ranker_training_table(i: Inputs) -> DataFrame:
    return _rounded(_training_features(i), "bm25")


@query
def fitted_ranker_facts(i: Inputs) -> DataFrame:
    """A ranker fitted on the training samples and tried on the dev samples: whether its
    weights and its reciprocal rank are numbers in range, and how many dev queries it ranks.

    A table whose queries are all dev queries has nothing to train on; all weights are zero then.
    """
    training = stage(_training_features(i), "features")
    model = None if training.isEmpty() else ranker.fit_ranker(training)
    dev = stage(_text_dev(i, HELD_OUT).join(i.passages.select("pid"), "pid", "left_semi"), "dev")
    features = scoring.rank_features(dev.select("qid", "pid").distinct(), i.openings, i.collection)
    scores = ranker.score_with_ranker(model, features) if model else features.select("qid", "pid", F.lit(0.5).alias("score"))
    scored = dev.join(scores, ["qid", "pid"])
    weights = [float(w) for w in model.stages[-1].coefficients] if model else []
    return metrics.reranking_mrr(scored).select(
        F.lit(all(math.isfinite(w) for w in weights)).alias("finite_weights"),
        F.col("`mrr@10`").between(0, 1).alias("rank_in_range"),
        "queries",
    )


def _with_slots(i: Inputs, labelled: DataFrame) -> DataFrame:
    """Slots beside rows with ``qid`` and ``pid``; made when they are read, as they take far more room than the texts."""
    texts = i.openings.select("qid", F.col("text").alias("query"))
    held = i.passages.select("pid", F.col("text").alias("passage"))
    return text_ranker.with_slots(labelled.join(texts, "qid").join(held, "pid"))


def _ranker_tables(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Training rows with ``n`` from 0 and scaled figures, stored, and dev rows with slots as well, stored."""
    made = _text_samples(i).join(i.passages.select("pid"), "pid", "left_semi").join(i.openings.select("qid"), "qid", "left_semi")
    labels = made.groupBy("qid", "pid").agg(F.max("label").alias("label"), F.min("n").alias("first"))
    numbered = labels.withColumn("block", F.floor(F.col("first") / 4096))
    numbered = number_blocks(numbered, [], "block", [("first", True)], "at").select("qid", "pid", "label", (F.col("at") - 1).alias("n"))
    train = stage(numbered, "train")
    dev = stage(_text_dev(i, HELD_OUT).join(i.passages.select("pid"), "pid", "left_semi"), "dev")
    # One pass over the collection for both.
    pairs = train.select("qid", "pid").union(dev.select("qid", "pid"))
    lexical = stage(scoring.rank_features(pairs, i.openings, i.collection), "lexical")
    train, dev = (t.join(lexical, ["qid", "pid"]) for t in (train, dev))
    means, deviations = text_ranker.scaling(train)
    train, dev = (text_ranker.with_figures(f, means, deviations) for f in (train, dev))
    return stage(train, "scaled"), stage(_with_slots(i, dev), "scaled")


@query
def text_ranker_metrics(i: Inputs) -> DataFrame:
    """Reciprocal rank over all dev queries of the ranker on figures and of the one on texts."""
    train, dev = _ranker_tables(i)
    labelled = train.withColumn("label", F.col("label").cast("double"))
    plain = ranker.score_with_ranker(ranker.fit_ranker(labelled), dev.select("qid", "pid", *ranker.FEATURES).distinct())
    sides = dev.select("qid", "pid", "is_pos").join(plain, ["qid", "pid"])
    texts = text_ranker.scored(dev, text_ranker.fit(_with_slots(i, labelled)))
    tables = [metrics.reranking_mrr(t).select(F.lit(n).alias("ranker"), "*") for n, t in (("figures", sides), ("texts", texts))]
    return tables[0].union(tables[1])


@query
def stepwise_ranker(i: Inputs) -> DataFrame:
    """Reciprocal rank after every second of six gradient steps over shuffled batches."""
    train, dev = _ranker_tables(i)
    batches = stage(samples.epoch_batches(train, train.count(), epochs=1, size=32, seed=7), "batches")
    return text_ranker.train(_with_slots(i, batches), dev, shared_folder(i.spark, "steps"), steps=6, every=2)


# --- expansion ---


@query
def feedback_context(i: Inputs) -> DataFrame:
    context = expansion.prf_context(i.first_candidates, FEEDBACK)
    return context.select("qid", F.array_join("passages", "\n\n").alias("passages"))


@query
def plain_prompts(i: Inputs) -> DataFrame:
    return expansion.build_prompts(i.queries, PROMPT)


@query
def feedback_prompts(i: Inputs) -> DataFrame:
    return expansion.build_prompts(i.queries, FEEDBACK_PROMPT, expansion.prf_context(i.first_candidates, FEEDBACK))


@query
def answered_queries(i: Inputs) -> DataFrame:
    return expansion.apply_expansion(i.queries, i.responses, ANSWER_WORDS)


@query
def appended_queries(i: Inputs) -> DataFrame:
    return expansion.apply_expansion(i.queries, i.responses, ANSWER_WORDS, mode="append")


def measuring_generator() -> expansion.Generator:
    """Repeats each prompt with its length, as a stand-in model."""
    return lambda prompts: [f"{prompt} ({len(prompt)} characters)" for prompt in prompts]


@query
def generated_responses(i: Inputs) -> DataFrame:
    return expansion.expand(expansion.build_prompts(i.queries, PROMPT), lambda: measuring_generator())


def failing_generator() -> expansion.Generator:
    """``measuring_generator`` that cannot answer prompts of some lengths."""

    def generate(prompts: list[str]) -> list[str]:
        if any(len(prompt) % 3 == 0 for prompt in prompts):
            raise ValueError("too hard")
        return measuring_generator()(prompts)

    return generate


@query
def kept_responses(i: Inputs) -> DataFrame:
    """Two runs over one table of answers: the second one, by a generator that says so, is asked only what
    the first one failed to answer."""
    prompts, store = expansion.build_prompts(i.queries, PROMPT), shared_folder(i.spark, "kept-answers")
    failed = expansion.expand_kept(prompts, lambda: failing_generator(), store, "model", most_failed=1.0)
    again = expansion.expand_kept(prompts, lambda: lambda some: [f"again {p}" for p in some], store, "model")
    reasons = failed.select("qid", F.col("reason").alias("first_reason"))
    return again.select("qid", "response").join(reasons, "qid")


@query
def best_feedback_terms(i: Inputs) -> DataFrame:
    feedback = expansion.feedback_rows(i.first_candidates, FEEDBACK)
    found = expansion.feedback_terms(i.queries, feedback, i.collection)
    return _rounded(found, "weight")


def _feedback_expanded(i: Inputs) -> DataFrame:
    feedback = expansion.feedback_rows(i.first_candidates, FEEDBACK)
    return expansion.expand_terms(i.queries, feedback, i.collection)


@query
def feedback_expanded_queries(i: Inputs) -> DataFrame:
    return _feedback_expanded(i)


def _variants(i: Inputs) -> DataFrame:
    answered = expansion.apply_expansion(i.queries, i.responses, ANSWER_WORDS)
    named = {"original": i.queries, "answer": answered, "feedback": _feedback_expanded(i)}
    # Query sets are small; written once, they are not expanded again by every reader.
    return stage(expansion.label_variants(named), "variants")


def _experiment(i: Inputs) -> DataFrame:
    return expansion.run_expansion_experiment(_variants(i), i.pairs, i.collection, i.text_qrels)


@query
def feedback_mixed_top(i: Inputs) -> DataFrame:
    """Retrieval with half of each query's weight on terms of a relevance model."""
    text = i.passages.select("pid", F.col("text").alias("passage"))
    feedback = i.pairs.filter(F.col("rank") <= FEEDBACK).join(text, "pid")
    mixed = stage(expansion.mix_terms(i.queries, expansion.relevance_model(feedback, m=20), share=0.5), "mixed")
    return _rounded(scoring.retrieve_weighted(mixed, i.collection, k=100), "score")


@query
def expansion_significance(i: Inputs) -> DataFrame:
    """Whether the changes by expansion are more than chance, and how far resampled queries move them."""
    scored = expansion.score_variants(_variants(i), i.pairs, i.collection)
    scores = stage(metrics.evaluate_queries(scored, i.text_qrels), "per-query")
    return _rounded(reporting.significance(scores, "original", rounds=200, seed=5), "change", "p_value", "low", "high")


@query
def expansion_metrics(i: Inputs) -> DataFrame:
    return _rounded(_experiment(i), *METRICS)


@query
def expansion_changes(i: Inputs) -> DataFrame:
    results = stage(_experiment(i), "results")
    changes = reporting.compare(results, results.filter("system = 'original'"))
    return _rounded(changes, "before", "after", "change")


@query
def parsed_log_metrics(i: Inputs) -> DataFrame:
    return reporting.parse_metrics(reporting.log_lines(as_percent(metrics.evaluate(i.unranked_runs, i.qrels))))


# --- files: written to the shared folder and read back ---


@query
def reread_runs(i: Inputs) -> DataFrame:
    folder = shared_folder(i.spark, "runs")
    paths = [f"{folder}/{name}.run" for name in ("open", "revenue", "discount")]
    for path in paths:
        sinks.write_run(i.runs.filter(F.col("run") == files.run_name(path)), path)
    return files.read_runs(i.spark, paths)


def _repeated_zero_based(i: Inputs) -> list[str]:
    """The runs as files that count ranks from 0 and start with each row's first writing,
    which a later one of another score corrects."""
    folder = shared_folder(i.spark, "repeated")
    paths = [f"{folder}/{name}.run" for name in ("open", "revenue", "discount")]
    for path in paths:
        run = i.runs.filter(F.col("run") == files.run_name(path))
        first = run.withColumns({"score": -F.col("score"), "again": F.lit(0)})
        both = first.unionByName(run.withColumn("again", F.lit(1)))
        line = F.concat_ws(" ", "qid", F.lit("Q0"), "pid", F.col("rank") - 1, F.col("score").cast("string"), F.lit("t"))
        ordered = both.repartitionByRange("again", "qid", "rank").sortWithinPartitions("again", "qid", "rank")
        ordered.select(line.alias("value")).write.text(path, compression="gzip")
    return paths


@query
def reread_repeated_runs(i: Inputs) -> DataFrame:
    return files.read_runs(i.spark, _repeated_zero_based(i))


def _dirty_runs(i: Inputs) -> list[str]:
    """The runs as files in which some lines are none: short, long, or without a number."""
    folder = shared_folder(i.spark, "dirty")
    paths = [f"{folder}/{name}.run" for name in ("open", "revenue", "discount")]
    for path in paths:
        run = i.runs.filter(F.col("run") == files.run_name(path))
        line = F.concat_ws(" ", "qid", F.lit("Q0"), "pid", "rank", F.col("score").cast("string"), F.lit("t"))
        spoilt = F.when(F.col("pid") % 97 == 0, F.concat_ws(" ", "qid", F.lit("Q0"), "pid", "rank"))
        spoilt = spoilt.when(F.col("pid") % 97 == 1, F.concat_ws(" ", "qid", F.lit("Q0"), "pid", F.lit("first"), F.lit("1.5"), F.lit("t")))
        spoilt = spoilt.when(F.col("pid") % 97 == 2, F.concat_ws(" ", "qid", F.lit("Q0"), "pid", "rank", F.lit("NaN"), F.lit("t"))).otherwise(line)
        ordered = run.repartitionByRange("qid", "rank").sortWithinPartitions("qid", "rank")
        ordered.select(spoilt.alias("value")).write.text(path)
    return paths


@query
def reread_dirty_runs(i: Inputs) -> DataFrame:
    return files.read_checked(i.spark, _dirty_runs(i), "run", most_bad=0.1)[0]


@query
def bad_run_lines(i: Inputs) -> DataFrame:
    """What was set aside: file, position over all files, reason and line."""
    return files.read_checked(i.spark, _dirty_runs(i), "run", most_bad=0.1)[1].select("file", "reason", "line")


@query
def fused_zero_based_runs(i: Inputs) -> DataFrame:
    """Fusion of those files after ranking by score, evaluated."""
    read = files.read_runs(i.spark, _repeated_zero_based(i))
    ranked = stage(rank_run(read.withColumn("pid", F.col("pid").cast("bigint")), ties="pid", keys=["run", "qid"], unique=True))
    return _rounded(metrics.evaluate(fusion.fuse_all(ranked.withColumn("qid", F.col("qid").cast("bigint"))), i.qrels), *METRICS)


@query
def reread_passages(i: Inputs) -> DataFrame:
    """Id-text lines with later tabs in the text, the odd ids written once more at the end."""
    path = shared_folder(i.spark, "passages")
    text = F.concat_ws("\t", normalize_line("text"), F.lit("end"))
    rows = i.passages.select("pid", text.alias("text"), F.lit(0).alias("again"))
    repeated = rows.filter("pid % 2 = 1").withColumns({"text": F.concat(F.lit("again "), "text"), "again": F.lit(1)})
    ordered = rows.union(repeated).repartitionByRange("again", "pid").sortWithinPartitions("again", "pid")
    ordered.select(F.concat_ws("\t", "pid", "text").alias("value")).write.text(path)
    return files.read_passages(i.spark, path)


@query
def reread_any_results(i: Inputs) -> DataFrame:
    """Result tables of other columns than the usual, read by their headers."""
    folder = shared_folder(i.spark, "any-results")
    priced = i.table("part").groupBy(F.col("p_brand").alias("model")).agg(F.count("*").alias("steps"), F.max("p_size").alias("size"))
    sinks.write_results(priced, f"{folder}/brands")
    sinks.write_results(i.table("nation").select(F.col("n_name").alias("model"), F.col("n_nationkey").alias("key")), f"{folder}/nations")
    whole = files.union_results(i.spark, [f"{folder}/brands", f"{folder}/nations"])
    figures = [F.coalesce(F.col(c).cast("bigint"), F.lit(-1)).alias(c) for c in ("steps", "size", "key")]
    return whole.select("source", "model", *figures)


@query
def reread_qrels(i: Inputs) -> DataFrame:
    path = shared_folder(i.spark, "qrels")
    line = F.concat_ws(" ", "qid", F.lit("0"), "pid", "rel")
    i.qrels.select(line.alias("value")).write.text(path)
    return files.read_qrels(i.spark, path, min_grade=1).withColumn("rel", F.col("rel").cast("bigint"))


@query
def reread_triples(i: Inputs) -> DataFrame:
    path = shared_folder(i.spark, "triples")
    line = F.concat_ws("\t", "qid", "pos_id", "neg_id")
    ordered = i.triples.repartitionByRange("ord").sortWithinPartitions("ord")
    ordered.select(line.alias("value")).write.text(path, compression="gzip")
    return files.read_triples(i.spark, path)


@query
def reread_queries(i: Inputs) -> DataFrame:
    path = shared_folder(i.spark, "queries")
    sinks.write_queries(i.queries.select("qid", normalize_line("text").alias("text")), path)
    return files.read_queries(i.spark, path, strict=True).select("qid", "text")


@query
def reread_candidates(i: Inputs) -> DataFrame:
    path = shared_folder(i.spark, "candidates")
    text = i.passages.select("pid", normalize_line("text").alias("passage"))
    rows = i.pairs.join(text, "pid").join(i.queries.select("qid", normalize_line("text").alias("query")), "qid")
    parts = max(1, math.ceil(i.pairs.count() / PAIRS_PER_FILE))
    ordered = rows.repartitionByRange(parts, "qid", "rank").sortWithinPartitions("qid", "rank")
    ordered.select(F.concat_ws("\t", "qid", "pid", "query", "passage").alias("value")).write.text(path)
    return files.read_candidates(i.spark, path)


@query
def reread_results(i: Inputs) -> DataFrame:
    folder = shared_folder(i.spark, "results")
    runs = i.runs
    tables = {
        "base": metrics.evaluate(runs, i.qrels),
        "fused": metrics.evaluate(fusion.fuse_all(runs), i.qrels),
    }
    for name, table in tables.items():
        sinks.write_results(_rounded(table, *METRICS).select("system", *METRICS), f"{folder}/{name}")
    whole = files.union_results(i.spark, [f"{folder}/{name}" for name in tables])
    return reporting.leaderboard(whole, sort="ndcg@10")


@query
def passage_terms(i: Inputs) -> DataFrame:
    counted = scoring.term_counts(i.passages)
    return counted.select("pid", F.col("dl").cast("bigint"), "term", F.col("tf").cast("bigint"))


@query
def collection_statistics(i: Inputs) -> DataFrame:
    lengths = i.passages.select(F.size(terms("text")).alias("dl"))
    return _rounded(lengths.agg(F.count("*").alias("passages"), F.avg("dl").alias("mean_length")), "mean_length")
