"""Command line: ``spark-submit`` or ``python -m rankflow <job> ...``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankflow.operators.fusion import METHODS
from rankflow.plans import jobs
from rankflow.session import scratch


def _expansion_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--passages")
    p.add_argument("--feedback", type=int, default=3)
    p.add_argument("--max-words", type=int, default=32)
    p.add_argument("--terms", type=int, default=10)
    p.add_argument("--generator", metavar="MODULE:FUNCTION", help="returns a batch generator; feedback terms without")
    p.add_argument("--keep-answers", metavar="FOLDER", help="table of the generator's answers, used again by later runs")
    p.add_argument("--most-failed", type=float, default=0.0, help="share of queries that may stay without an answer")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rankflow")
    commands = parser.add_subparsers(dest="job", required=True)

    p = commands.add_parser("prepare", help="training and dev samples from id triples")
    for name in ("dev-triples", "train-triples", "queries", "passages", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--dev-count", type=int, default=200)
    p.add_argument("--max-negatives", type=int, default=200)
    p.add_argument("--ratio", type=int, default=4)
    p.add_argument("--max-samples", type=int)
    p.add_argument("--batch-size", type=int, default=32)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--min-passages", type=int)
    p.add_argument("--full-corpus", action="store_true")

    p = commands.add_parser("evaluate", help="rank candidates by BM25, write the run, print metrics")
    for name in ("queries", "candidates", "qrels", "out-run"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--passages")
    p.add_argument("--judged-only", action="store_true")
    p.add_argument("--rank-base", type=int, default=1, choices=(0, 1))
    p.add_argument("--tag", default="STANDARD")
    p.add_argument("--min-grade", type=int)
    p.add_argument("--scorer", metavar="MODULE:FUNCTION", help="returns a batch scorer; BM25 without")
    p.add_argument("--batch-size", type=int, default=64)
    p.add_argument("--max-words", type=int)
    p.add_argument("--keep-scores", metavar="FOLDER", help="table of the model's scores, used again by later runs")

    p = commands.add_parser("train", help="fit the feature ranker on prepared samples, or train the text ranker in steps; print dev MRR")
    for name in ("prepared", "queries", "passages", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--steps", type=int, help="train the text ranker for so many steps, after those stored in OUT")
    p.add_argument("--batches-per-step", type=int, default=4)
    p.add_argument("--batch-size", type=int, default=32)
    p.add_argument("--every", type=int, default=1, help="steps between trials on the dev samples")
    p.add_argument("--rate", type=float, default=1.0)
    p.add_argument("--epochs", type=int, default=1)
    p.add_argument("--seed", type=int, default=0)

    p = commands.add_parser("rerank", help="rank candidates with a fitted ranker and write the run")
    for name in ("model", "queries", "candidates", "out-run"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--passages")
    p.add_argument("--rank-base", type=int, default=1, choices=(0, 1))
    p.add_argument("--tag", default="RANKER")

    p = commands.add_parser("fuse", help="single runs, all fusions, all pairs")
    p.add_argument("--qrels", required=True)
    p.add_argument("--runs", nargs="+", required=True)
    p.add_argument("--methods", nargs="+", default=list(METHODS))
    p.add_argument("--best")
    p.add_argument("--out", required=True)

    p = commands.add_parser("expand", help="append feedback terms to queries, or expand them by a generator")
    for name in ("queries", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--candidates")
    p.add_argument("--template", help="file with the prompt, {query} and {passages} in it")
    _expansion_options(p)

    p = commands.add_parser("experiment", help="expand queries in every way and compare the results")
    for name in ("queries", "candidates", "qrels", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--templates", nargs="+", default=[], metavar="NAME=FILE", help="prompts, {query} and {passages} in them")
    _expansion_options(p)

    p = commands.add_parser("compare", help="evaluate query files over one candidate set")
    p.add_argument("--queries", nargs="+", required=True, metavar="NAME=PATH")
    for name in ("candidates", "qrels", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--baseline")
    p.add_argument("--passages")

    p = commands.add_parser("summarize", help="result CSVs as one ordered table")
    p.add_argument("tables", nargs="+")
    p.add_argument("--sort")
    p.add_argument("--head", type=int)
    return parser


def _named(name: str | None) -> Callable | None:
    """The function that ``module:function`` names; tasks import it by that name."""
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _whole_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _print(table: DataFrame) -> None:
    """All rows; result tables have one per system."""
    table.show(max(1, table.count()), truncate=False)


def main(arguments: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(arguments))
    job = options.pop("job")
    spark = SparkSession.builder.appName(f"rankflow-{job}").getOrCreate()
    with scratch(spark):
        if job == "prepare":
            _print(jobs.prepare_training(spark, **options))
        elif job == "evaluate":
            options["model"] = options["scorer"] or ""
            options["load_scorer"] = _named(options.pop("scorer"))
            _print(jobs.evaluate_candidates(spark, **options))
        elif job == "train":
            if options["steps"] is not None:
                _print(jobs.train_text_ranker(spark, **options))
            else:
                _print(jobs.train_ranker(spark, *[options[n] for n in ("prepared", "queries", "passages", "out")]))
        elif job == "rerank":
            jobs.rerank_candidates(spark, **options)
        elif job == "fuse":
            for table in jobs.fuse_runs(spark, **options).values():
                _print(table)
        elif job in ("expand", "experiment"):
            options["model"] = options["generator"] or ""
            options["load_generator"] = _named(options.pop("generator"))
            if job == "expand":
                if options["template"]:
                    options["template"] = _whole_text(spark, options["template"])
                jobs.expand_queries(spark, **options)
            else:
                files = dict(entry.split("=", 1) for entry in options["templates"])
                options["templates"] = {name: _whole_text(spark, path) for name, path in files.items()}
                _print(jobs.expansion_experiment(spark, **options))
        elif job == "compare":
            options["queries"] = dict(entry.split("=", 1) for entry in options["queries"])
            _print(jobs.compare_expansions(spark, **options))
        else:
            _print(jobs.summarize(spark, **options))


if __name__ == "__main__":
    main()
