import corpus_pipeline
from test_decontamination import slow_leaks
from test_pieces import PATH
from test_secrets import slow_base
from test_simhash import slow_components, slow_fingerprint

from rankflow.llm import pieces
from rankflow.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage on its own input: decisions checked against brute force, columns kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(function(spark, docs, FOLDER), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        seen[name] = before, after
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after.values())

    before, after = seen["near_duplicates"]
    prints = {d: slow_fingerprint(r.text) for d, r in before.items()}
    classes = slow_components(set(prints.values()))
    firsts = {}
    for d in sorted(prints):
        firsts.setdefault(classes[prints[d]], d)
    assert set(after) == set(firsts.values())

    before, after = seen["benchmark_leaks"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(before) - set(after) == {d for d, *_ in slow_leaks([(d, r.text) for d, r in before.items()], items)}

    before, after = seen["secret_spans"]
    assert set(before) == set(after) and not any(slow_base(r.text) for r in after.values())

    before, after = seen["dropout_pieces"]
    model = pieces.Model(PATH, rate=0)
    assert all(model.decode(after[d].pieces) == r.text for d, r in before.items()) and set(before) == set(after)


def test_run_equals_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER))
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, docs.collect()))


def test_empty_and_odd_rows(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a", "en", "s", 1), (2, "a", "en", "s", 1), (3, "w x " * 30_000, "en", "s", 9)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, FOLDER))
        assert docs.count() == 0


def test_each_stage_on_odd_rows(spark):
    """Stages behind the first one see such rows too, when they are called by themselves."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a", "en", "s", 1), (2, "a", "en", "s", 1)]
    odd += [(3, "w x " * 30_000, "en", "s", 120_000), (None, None, "en", None, None)]
    ids = {"near_duplicates": [1, 2, 3, None, None]}
    for name, function in corpus_pipeline.STAGES[1:]:
        got = function(spark, spark.createDataFrame(odd, schema), FOLDER).collect()
        expected = ids.get(name, [r[0] for r in odd])
        assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, expected))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert {tuple(r) for r in got} <= set(odd)
        assert function(spark, spark.createDataFrame([], schema), FOLDER).count() == 0


def test_repeated_and_missing_keys_of_near_duplicates(spark):
    from rankflow.llm import simhash

    text = " ".join(f"w{i}" for i in range(200))
    rows = [(4, text), (4, text), (7, text), (None, text), (9, "other words entirely here"), (9, "still other words stand here now")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.representatives(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "9", "None"]
