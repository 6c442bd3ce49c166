"""File-to-file jobs on a small experiment, and the command line."""

import gzip

import pytest

from rankflow import __main__ as command
from rankflow.plans import jobs
from rankflow.sources import files

PASSAGES = {
    "p1": "solar panels turn light into power",
    "p2": "wind turbines turn wind into power",
    "p3": "rain falls on the plain",
    "p4": "light rain and wind",
    "p5": "panels of judges",
}
QUERIES = {"q1": "solar panels", "q2": "wind power", "q3": "rain"}
QRELS = {("q1", "p1"): 3, ("q1", "p5"): 0, ("q2", "p2"): 2, ("q3", "p3"): 1, ("q3", "p4"): 1}


@pytest.fixture
def folder(tmp_path):
    def write(name, lines):
        opener = gzip.open if name.endswith(".gz") else open
        with opener(tmp_path / name, "wt") as handle:
            handle.write("\n".join(lines) + "\n")

    write("queries.tsv", [f"{q}\t{t}" for q, t in QUERIES.items()])
    write("collection.tsv", [f"{p}\t{t}" for p, t in PASSAGES.items()])
    write("candidates.tsv.gz", [f"{q}\t{p}\t{QUERIES[q]}\t{t}" for q in QUERIES for p, t in PASSAGES.items()])
    write("qrels.txt", [f"{q} 0 {p} {g}" for (q, p), g in QRELS.items()])
    write("dev.tsv.gz", ["q1 p1 p3", "q1 p1 p4", "q2 p2 p5"])
    write("train.tsv.gz", ["q1 p1 p2", *["q2 p2 p3", "q3 p3 p1", "q3 p4 p9"] * 4])
    for name, order in {"up": "12345", "down": "54321", "mixed": "31524"}.items():
        write(f"{name}.run", [f"{q} Q0 p{p} {at} {6 - at}.5 {name}" for q in QUERIES for at, p in enumerate(order, 1)])
    return tmp_path


def test_prepare(spark, folder):
    summary = jobs.prepare_training(
        spark, *(str(folder / n) for n in ("dev.tsv.gz", "train.tsv.gz", "queries.tsv", "collection.tsv", "made")),
        dev_count=1, ratio=1, min_passages=5,
    ).first()
    train = spark.read.parquet(str(folder / "made/train")).collect()
    assert summary["loaded"] == len(train) and summary["loaded"] + summary["dropped"] == 12
    assert {r.qid for r in train} == {"q2", "q3"}
    assert {(r.pid, r.label) for r in train if r.qid == "q2"} == {("p2", 1), ("p3", 0)}
    dev = spark.read.parquet(str(folder / "made/dev")).collect()
    assert {(r.qid, r.pid, r.is_pos) for r in dev} == {("q1", "p1", True), ("q1", "p3", False), ("q1", "p4", False)}


def test_train_and_rerank(spark, folder):
    names = ("dev.tsv.gz", "train.tsv.gz", "queries.tsv", "collection.tsv", "made")
    jobs.prepare_training(spark, *(str(folder / n) for n in names), dev_count=1, ratio=1)
    asked, held = str(folder / "queries.tsv"), str(folder / "collection.tsv")
    rank = jobs.train_ranker(spark, str(folder / "made"), asked, held, str(folder / "model")).first()
    assert rank["queries"] == 1 and 0 < rank["mrr@10"] <= 1
    offered = str(folder / "candidates.tsv.gz")
    run = jobs.rerank_candidates(spark, str(folder / "model"), asked, offered, str(folder / "ranked.run"), held, rank_base=0)
    assert run.count() == 15
    back = files.read_runs(spark, str(folder / "ranked.run"))
    assert back.count() == 15 and {r["rank"] for r in back.collect()} == set(range(5))


def test_train_in_steps_resumes_and_reranks(spark, folder):
    names = ("dev.tsv.gz", "train.tsv.gz", "queries.tsv", "collection.tsv", "made")
    jobs.prepare_training(spark, *(str(folder / n) for n in names), dev_count=1, ratio=1)
    given = [str(folder / n) for n in ("made", "queries.tsv", "collection.tsv")]
    options = {"batches_per_step": 1, "batch_size": 3, "epochs": 2, "every": 2, "seed": 3}
    whole = jobs.train_text_ranker(spark, *given, str(folder / "whole"), steps=4, **options).collect()
    assert [r.step for r in whole] == [2, 4] and all(0 <= r.mrr <= 1 for r in whole)
    jobs.train_text_ranker(spark, *given, str(folder / "cut"), steps=3, **options)
    resumed = jobs.train_text_ranker(spark, *given, str(folder / "cut"), steps=4, **options).collect()
    assert [tuple(r) for r in resumed if r.step % 2 == 0] == [tuple(r) for r in whole]
    ends = [spark.read.parquet(str(folder / n / "weights")).filter("step = 4").first().weights for n in ("whole", "cut")]
    assert ends[0] == pytest.approx(ends[1], abs=1e-12) and any(ends[0])
    offered = str(folder / "candidates.tsv.gz")
    run = jobs.rerank_candidates(spark, str(folder / "whole"), given[1], offered, str(folder / "steps.run"), given[2])
    assert run.count() == 15 and files.read_runs(spark, str(folder / "steps.run")).count() == 15


def test_evaluate_with_bm25_and_with_a_model(spark, folder):
    given = [str(folder / n) for n in ("queries.tsv", "candidates.tsv.gz", "qrels.txt")]
    lexical = jobs.evaluate_candidates(spark, *given, str(folder / "bm25.run"), passages=str(folder / "collection.tsv"))
    assert tuple(lexical.first())[:3] == ("bm25", 3, 100.0)
    run = files.read_runs(spark, str(folder / "bm25.run"))
    assert run.count() == 15 and run.filter("qid = 'q1' and rank = 1").first().pid == "p1"

    def load():
        return lambda asked, held: [float(len(set(q.split()) & set(p.split()))) for q, p in zip(asked, held)]

    model = jobs.evaluate_candidates(
        spark, *given, str(folder / "model.run"), judged_only=True, rank_base=0, tag="mine", load_scorer=load
    )
    assert model.first()["queries"] == 3
    assert files.read_runs(spark, str(folder / "model.run")).agg({"rank": "min"}).first()[0] == 0


def test_fuse_summarize(spark, folder):
    runs = [str(folder / f"{n}.run") for n in ("up", "down", "mixed")]
    tables = jobs.fuse_runs(spark, str(folder / "qrels.txt"), runs, str(folder / "fused"), methods=["combSUM", "rrf"])
    assert {r.system for r in tables["single"].collect()} == {"up", "down", "mixed"}
    assert {r.system for r in tables["fused"].collect()} == {"fuse:sum", "fuse:rrf"}
    assert all(r.system.startswith("pair:") for r in tables["paired"].collect()) and tables["paired"].count() == 3
    written = [str(folder / "fused" / n) for n in ("base_models", "all_runs_fused", "pairs_fused")]
    board = jobs.summarize(spark, written, sort="ndcg@10").collect()
    assert len(board) == 8 and board[0]["ndcg@10"] == max(r["ndcg@10"] for r in board)
    heads = jobs.summarize(spark, written, sort="ndcg@10", head=2).collect()
    assert len(heads) == 6 and heads[0] == board[0]


def test_fusion_ranks_by_score_whatever_the_file_counts_from(spark, folder):
    for name in ("up", "down"):
        lines = (folder / f"{name}.run").read_text().split("\n")[:-1]
        moved = [" ".join([*(f := line.split())[:3], str(int(f[3]) - 1), *f[4:]]) for line in lines]
        (folder / f"{name}0.run").write_text("\n".join(moved) + "\n")
    found = []
    for end in ("", "0"):
        runs = [str(folder / f"{n}{end}.run") for n in ("up", "down")]
        tables = jobs.fuse_runs(spark, str(folder / "qrels.txt"), runs, str(folder / f"fused{end}"))
        found.append(sorted(map(str, tables["fused"].collect())))
    assert found[0] == found[1]


def test_long_queries_survive_expansion(spark, folder):
    own = " ".join(f"word{i}" for i in range(37))
    (folder / "long.tsv").write_text(f"q1\t{own}\n")
    offered, whole = str(folder / "candidates.tsv.gz"), str(folder / "collection.tsv")
    got = jobs.expand_queries(spark, str(folder / "long.tsv"), str(folder / "longer"), offered, passages=whole).first()
    assert got.text.startswith(own + " ") and len(got.text.split()) > 40


def test_expand_and_compare(spark, folder):
    asked, offered = str(folder / "queries.tsv"), str(folder / "candidates.tsv.gz")
    jobs.expand_queries(spark, asked, str(folder / "fed"), offered, feedback=1, terms=2)
    assert all(r.text.startswith(QUERIES[r.qid] + " ") for r in files.read_queries(spark, str(folder / "fed")).collect())

    def load():
        return lambda prompts: ['{"response": "' + p.upper() + '"}' for p in prompts]

    jobs.expand_queries(spark, asked, str(folder / "told"), template="{query} now", load_generator=load)
    told = {r.qid: r.text for r in files.read_queries(spark, str(folder / "told")).collect()}
    assert told["q1"] == "SOLAR PANELS NOW"
    with pytest.raises(ValueError):
        jobs.expand_queries(spark, asked, str(folder / "none"))

    sets = {"plain": asked, "fed": str(folder / "fed"), "told": str(folder / "told")}
    results = jobs.compare_expansions(spark, sets, offered, str(folder / "qrels.txt"), str(folder / "out"), baseline="plain")
    assert {r.system for r in results.collect()} == set(sets)
    changes = spark.read.csv(str(folder / "out/changes"), header=True, inferSchema=True)
    assert {r.change for r in changes.filter("system = 'plain'").collect()} == {0.0}


def test_one_experiment_from_queries_to_table(spark, folder):
    def load():
        return lambda prompts: ['{"response": "' + " ".join(p.split()).upper() + '"}' for p in prompts]

    given = [str(folder / n) for n in ("queries.tsv", "candidates.tsv.gz", "qrels.txt", "all")]
    templates = {"told": "{query} now", "shown": "{query} as in {passages}"}
    options = {"templates": templates, "load_generator": load, "keep_answers": str(folder / "kept"), "feedback": 1}
    results = {r.system: r for r in jobs.expansion_experiment(spark, *given, **options).collect()}
    assert set(results) == {"plain", "feedback", "told", "shown"}
    kept = spark.read.parquet(str(folder / "kept"))
    assert kept.count() == 6 and kept.filter("response is null").count() == 0
    told = {r.qid: r.text for r in files.read_queries(spark, str(folder / "all/queries/told")).collect()}
    assert told == {q: t.upper() + " NOW" for q, t in QUERIES.items()}
    sets = {name: str(folder / "all/queries" / name) for name in results}
    chained = jobs.compare_expansions(spark, sets, *given[1:3], str(folder / "chained"))
    assert sorted(map(tuple, chained.collect())) == sorted(map(tuple, results.values()))
    with pytest.raises(ValueError):
        jobs.expansion_experiment(spark, *given, templates=templates)


def test_command_line(spark, folder, capsys):
    runs = [str(folder / f"{n}.run") for n in ("up", "down")]
    command.main(["fuse", "--qrels", str(folder / "qrels.txt"), "--runs", *runs, "--best", "rrf", "--out", str(folder / "cli")])
    command.main(["summarize", str(folder / "cli/pairs_fused"), "--sort", "ndcg@10"])
    assert "pair:down+up (rrf)" in capsys.readouterr().out
    (folder / "prompt.txt").write_text("{query} now")
    named = [f"--{n}" for n in ("queries", "candidates", "qrels", "out")]
    paths = [str(folder / n) for n in ("queries.tsv", "candidates.tsv.gz", "qrels.txt", "cli-out")]
    chosen = [x for pair in zip(named, paths) for x in pair]
    prompts = ["--templates", f"told={folder / 'prompt.txt'}", "--generator", "rankflow.plans.catalog:measuring_generator"]
    command.main(["experiment", *chosen, *prompts])
    assert "told" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        command.main(["unknown"])
