import itertools

import pytest
from pyspark.sql import functions as F

from rankflow.operators import fusion

SCHEMA = "run string, qid string, pid string, rank long, score double"


def make_runs(rng, names=("a", "b", "c"), queries=5):
    runs = {}
    for name in names:
        for q in range(queries):
            if (name, q) == ("c", 1):
                continue  # a run without the query
            pids = rng.sample(range(25), 1 if (name, q) == ("b", 2) else rng.randint(2, 15))
            scores = {f"p{p}": float(rng.randint(0, 5)) for p in pids}
            order = sorted(sorted(scores), key=lambda p: -scores[p])
            runs[name, f"q{q}"] = {p: (at, scores[p]) for at, p in enumerate(order, 1)}
    return runs


def frame(spark, runs):
    return spark.createDataFrame([(n, q, p, r, s) for (n, q), d in runs.items() for p, (r, s) in d.items()], SCHEMA)


def fuse_by_hand(runs, k=60):
    out = {}
    for qid in {q for _, q in runs}:
        lists = [d for (_, q), d in runs.items() if q == qid]
        union = sorted(set(itertools.chain(*lists)))
        for pid in union:
            norms, rrf, borda = [], 0.0, 0.0
            for d in lists:
                values = [s for _, s in d.values()]
                if pid in d:
                    rank, score = d[pid]
                    norms.append((score - min(values)) / (max(values) - min(values)) if max(values) > min(values) else 0.0)
                    rrf += 1 / (k + rank)
                    borda += len(union) - rank + 1
                else:
                    borda += (len(union) - len(d) + 1) / 2
            total = sum(norms)
            out[qid, pid] = (total, total * len(norms), total / len(norms), borda, rrf)
    return out


def test_all_methods_equal_their_definitions(spark, rng):
    runs = make_runs(rng)
    got = fusion.fuse_scores(frame(spark, runs)).collect()
    want = fuse_by_hand(runs)
    assert {(r.qid, r.pid) for r in got} == set(want)
    for r in got:
        assert [r[m] for m in fusion.METHODS] == pytest.approx(want[r.qid, r.pid], abs=1e-11)


def test_fused_run_is_ranked_by_score_then_pid(spark, rng):
    runs = make_runs(rng)
    want = fuse_by_hand(runs)
    got = fusion.fuse(frame(spark, runs), "comb_MNZ").collect()
    for qid in {r.qid for r in got}:
        order = [r.pid for r in sorted((r for r in got if r.qid == qid), key=lambda r: r["rank"])]
        scores = {p: round(v[1], 12) for (q, p), v in want.items() if q == qid}
        assert order == sorted(sorted(scores), key=lambda p: -scores[p])
    assert fusion.fuse(frame(spark, runs), "rrf", depth=2).filter("rank > 2").count() == 0


def test_rank_methods_ignore_rescaled_scores(spark, rng):
    runs = frame(spark, make_runs(rng))
    scaled = runs.withColumn("score", F.col("score") * 3 + 10)
    first, second = (fusion.fuse_scores(r, ["rrf", "borda", "sum"]).orderBy("qid", "pid").collect() for r in (runs, scaled))
    for a, b in zip(first, second, strict=True):
        assert (a.rrf, a.borda) == (b.rrf, b.borda) and a["sum"] == pytest.approx(b["sum"])


def test_mnz_is_sum_times_count(spark, rng):
    runs = frame(spark, make_runs(rng))
    held = runs.groupBy("qid", "pid").count()
    for r in fusion.fuse_scores(runs).join(held, ["qid", "pid"]).collect():
        assert r.mnz == pytest.approx(r["sum"] * r["count"])
        assert r.anz == pytest.approx(r["sum"] / r["count"])


def test_minmax_range_and_flat_list(spark, rng):
    got = fusion.minmax(frame(spark, make_runs(rng)))
    bounds = got.groupBy("run", "qid").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).collect()
    assert all(b.lo == 0.0 and b.hi in (0.0, 1.0) for b in bounds)
    assert [r.score for r in got.filter("run = 'b' and qid = 'q2'").collect()] == [0.0]


def test_method_names(spark):
    spellings = {"comb_sum": "sum", "combSUM": "sum", "CombMNZ": "mnz", "comb_anz": "anz", "bordafuse": "borda", "RRF": "rrf"}
    assert {name: fusion.canonical_method(name) for name in spellings} == spellings
    with pytest.raises(ValueError):
        fusion.canonical_method("condorcet")


@pytest.mark.parametrize("method", ["borda", "sum"])
def test_pairs_equal_fusing_each_pair_alone(spark, rng, method):
    runs = make_runs(rng, names=("c", "a", "b", "d"))
    got = {(r.run, r.qid, r.pid): r.score for r in fusion.fuse_pairs(frame(spark, runs), method).collect()}
    want = {}
    for a, b in itertools.combinations("abcd", 2):
        part = {key: d for key, d in runs.items() if key[0] in (a, b)}
        for (qid, pid), values in fuse_by_hand(part).items():
            want[f"pair:{a}+{b} ({method})", qid, pid] = values[fusion.METHODS.index(method)]
    assert got == pytest.approx(want, abs=1e-11)


def test_fuse_all_names_and_best_method(spark, rng):
    names = {r.run for r in fusion.fuse_all(frame(spark, make_runs(rng)), ["combSUM", "rrf"]).select("run").distinct().collect()}
    assert names == {"fuse:sum", "fuse:rrf"}
    results = spark.createDataFrame([("fuse:sum", 0.5), ("fuse:anz", 0.5), ("fuse:rrf", 0.1)], "system string, `ndcg@10` double")
    assert fusion.best_method(results) == "anz"
    assert fusion.best_method(results, "comb_mnz") == "mnz"
    with pytest.raises(ValueError):
        fusion.best_method(results.filter("false"))
