"""The same results as SQL over the given tables, one statement per registered query.

Statements share common table expressions; each names the ones it needs, in order. Scores
that are rounded already are shown at six places by plain arithmetic, because the engines'
``round`` differ on the halves that a second rounding meets.
"""

from __future__ import annotations

from rankflow.operators.reporting import POISSON
from rankflow.plans.fixtures import CANDIDATES, DEV_NEGATIVES, DEV_QUERIES, HELD_OUT, OPENING_WORDS, OPENINGS, STRETCHES, VALUE_STEPS

CTE: dict[str, str] = {}

# --- derived inputs ---

CTE["evidence"] = """
SELECT l_suppkey AS qid, l_partkey AS pid,
       sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS open,
       CAST(sum(CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS DOUBLE) AS revenue,
       CAST(sum(CASE WHEN l_returnflag <> 'A' THEN CAST(round(l_discount * 100) AS BIGINT) END) AS DOUBLE) AS discount,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned,
       count(*) FILTER (WHERE l_linestatus = 'F') AS filled,
       any_value(s_acctbal) AS balance
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey, l_partkey"""

CTE["unranked"] = """
SELECT 'open' AS run, qid, pid, open AS score FROM evidence WHERE open IS NOT NULL
UNION ALL SELECT 'revenue', qid, pid, revenue FROM evidence WHERE revenue IS NOT NULL
UNION ALL SELECT 'discount', qid, pid, discount FROM evidence WHERE discount IS NOT NULL AND balance >= 0"""

CTE["runs"] = """
SELECT run, qid, pid, score, row_number() OVER (PARTITION BY run, qid ORDER BY score DESC, pid) AS rank FROM unranked"""

CTE["qrels"] = """
SELECT qid, pid, least(3, CAST(floor(returned / 15) AS BIGINT)) AS rel
FROM evidence WHERE filled > 0 AND balance <= 9000"""

CTE["triples"] = f"""
SELECT event_id AS ord, user_id * {STRETCHES} + event_id % {STRETCHES} AS qid, CAST(floor(value * {VALUE_STEPS}) AS BIGINT) AS pos_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS neg_id
FROM events"""

CTE["queries"] = "SELECT item_id AS qid, text FROM benchmark"
CTE["passages"] = "SELECT doc_id AS pid, text FROM documents"
CTE["held"] = "SELECT doc_id AS pid, text FROM documents SEMI JOIN labels USING (doc_id)"
CTE["text_triples"] = "SELECT * FROM triples SEMI JOIN queries USING (qid)"

# --- metrics over the CTE `systems` (system, qid, pid, score) and `judged` (qid, pid, rel) ---


def evaluation(
    ndcg: int = 10, recall: int = 100, ap: int = 1000, rr: int = 10, ties: str = "s.pid", min_rel: int = 1
) -> dict[str, str]:
    return {
        "placed": f"""
SELECT s.system, s.qid, s.pid, coalesce(j.rel, 0) AS rel,
       row_number() OVER (PARTITION BY s.system, s.qid ORDER BY s.score DESC, {ties}) AS rank
FROM systems s LEFT JOIN judged j ON j.qid = s.qid AND j.pid = s.pid""",
        "counted": f"""
SELECT *, sum(CASE WHEN rel >= {min_rel} THEN 1 ELSE 0 END) OVER (PARTITION BY system, qid ORDER BY rank
       ROWS UNBOUNDED PRECEDING) AS seen
FROM placed""",
        "ideal": f"""
SELECT qid, sum(CASE WHEN rel >= {min_rel} THEN 1 ELSE 0 END) AS n_rel,
       sum(CASE WHEN place <= {ndcg} AND rel > 0 THEN rel / log2(place + 1) ELSE 0 END) AS idcg
FROM (SELECT qid, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC, pid) AS place FROM judged)
GROUP BY qid""",
        "gains": f"""
SELECT system, qid,
       sum(CASE WHEN rank <= {ndcg} THEN rel / log2(rank + 1) ELSE 0 END) AS dcg,
       sum(CASE WHEN rank <= {recall} AND rel >= {min_rel} THEN 1 ELSE 0 END) AS found,
       sum(CASE WHEN rank <= {ap} AND rel >= {min_rel} THEN CAST(seen AS DOUBLE) / rank ELSE 0 END) AS precisions,
       min(CASE WHEN rank <= {rr} AND rel >= {min_rel} THEN rank END) AS best
FROM counted GROUP BY system, qid""",
        "per_query": """
SELECT system, qid,
       CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS m_ndcg,
       CASE WHEN n_rel > 0 THEN CAST(found AS DOUBLE) / n_rel ELSE 0 END AS m_recall,
       CASE WHEN n_rel > 0 THEN precisions / n_rel ELSE 0 END AS m_map,
       CASE WHEN best IS NOT NULL THEN 1 / CAST(best AS DOUBLE) ELSE 0 END AS m_mrr
FROM gains JOIN ideal USING (qid)""",
    }


METRIC_COLUMNS = """round(avg(m_ndcg), 6) AS "ndcg@10", round(avg(m_recall), 6) AS "recall@100", round(avg(m_map), 6) AS "map@1000\""""
MEANS = f"SELECT system, count(*) AS queries, {METRIC_COLUMNS} FROM per_query GROUP BY system"

RUN_SYSTEMS = "SELECT run AS system, qid, pid, score FROM unranked"
EVAL_RUNS = {"systems": RUN_SYSTEMS, "judged": "SELECT * FROM qrels"}

# --- fusion over `parts` (grp, run, qid, pid, rank, score); grp is one value or a pair ---

FUSION = {
    "figures": """
SELECT grp, run, qid, min(score) AS lo, max(score) AS hi, count(*) AS len FROM parts GROUP BY grp, run, qid""",
    "normed": """
SELECT p.*, f.len, CASE WHEN f.hi > f.lo THEN (p.score - f.lo) / (f.hi - f.lo) ELSE 0 END AS norm
FROM parts p JOIN figures f USING (grp, run, qid)""",
    "members": "SELECT DISTINCT grp, qid, pid FROM parts",
    "sizes": "SELECT grp, qid, count(*) AS size FROM members GROUP BY grp, qid",
    # Borda over the full run x passage grid: ranked rows earn size - rank + 1, others the even share.
    "borda": """
SELECT m.grp, m.qid, m.pid, sum(CASE WHEN p.rank IS NOT NULL THEN s.size - p.rank + 1 ELSE (s.size - f.len + 1) / 2.0 END) AS borda
FROM members m JOIN sizes s USING (grp, qid) JOIN figures f USING (grp, qid)
LEFT JOIN parts p ON p.grp = m.grp AND p.run = f.run AND p.qid = m.qid AND p.pid = m.pid
GROUP BY m.grp, m.qid, m.pid""",
    "basic": """
SELECT grp, qid, pid, sum(norm) AS "sum", sum(norm) * count(*) AS mnz, sum(norm) / count(*) AS anz,
       sum(1 / CAST(60 + rank AS DOUBLE)) AS rrf
FROM normed GROUP BY grp, qid, pid""",
    "fused": """
SELECT grp, qid, pid, round("sum", 12) AS "sum", round(mnz, 12) AS mnz, round(anz, 12) AS anz,
       round(CAST(borda AS DOUBLE), 12) AS borda, round(rrf, 12) AS rrf
FROM basic JOIN borda USING (grp, qid, pid)""",
}
ONE_GROUP = "SELECT 'all' AS grp, * FROM runs"
METHODS = ("sum", "mnz", "anz", "borda", "rrf")
FUSE_SYSTEMS = "\nUNION ALL ".join(f"""SELECT 'fuse:{m}' AS system, qid, pid, "{m}" AS score FROM fused""" for m in METHODS)

# --- samples ---


def dev(source: str, n: int = DEV_QUERIES) -> str:
    return f"SELECT qid FROM {source} GROUP BY qid ORDER BY min(ord) LIMIT {n}"


def dev_samples(source: str) -> str:
    return f"""
SELECT DISTINCT qid, pos_id AS pid, true AS is_pos FROM {source} SEMI JOIN dev USING (qid)
UNION ALL
SELECT qid, pid, false FROM (
  SELECT qid, neg_id AS pid, row_number() OVER (PARTITION BY qid ORDER BY min(ord)) AS place
  FROM {source} SEMI JOIN dev USING (qid) GROUP BY qid, neg_id) WHERE place <= {DEV_NEGATIVES}"""


LABELLED = """
SELECT n, ord, qid, CASE WHEN n % 5 = 0 THEN pos_id ELSE neg_id END AS pid, CAST(n % 5 = 0 AS BIGINT) AS label
FROM (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS n FROM triples ANTI JOIN held_out USING (qid))"""
NEEDED = "SELECT DISTINCT pid FROM (SELECT pid FROM dev_samples UNION ALL SELECT pid FROM labelled)"
SAMPLES = {"dev": dev("triples"), "held_out": dev("triples", HELD_OUT), "dev_samples": dev_samples("triples"), "labelled": LABELLED, "needed": NEEDED}
TEXT_SAMPLES = {
    "dev": dev("text_triples"),
    "held_out": dev("text_triples", HELD_OUT),
    "dev_samples": dev_samples("text_triples"),
    "labelled": LABELLED,
    "dev_texts": """
SELECT d.qid, d.pid, q.text AS query, h.text AS passage, d.is_pos
FROM dev_samples d JOIN queries q USING (qid) JOIN held h USING (pid)""",
}

# --- lexical scoring ---


def terms(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '\p{{L}}+')"


LEXICAL = {
    "listed": f"SELECT pid, {terms('text')} AS words FROM passages",
    "collection": "SELECT count(*) AS n, avg(len(words)) AS mean_length FROM listed",
    "tf": """
SELECT pid, dl, term, count(*) AS tf FROM (SELECT pid, len(words) AS dl, unnest(words) AS term FROM listed)
GROUP BY pid, dl, term""",
    "df": "SELECT term, count(*) AS df FROM tf GROUP BY term",
    "idf": "SELECT term, ln(1 + (n - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) AS idf FROM df, collection",
    "asked": f"SELECT DISTINCT qid, unnest({terms('text')}) AS term FROM queries",
}


def bm25(asked: str = "asked", keys: str = "qid", k1: float = 0.9, b: float = 0.4) -> str:
    k1_, b_ = f"CAST({k1} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"""
SELECT {keys}, pid, round(sum(idf * tf * ({k1_} + 1) / (tf + {k1_} * (1 - {b_} + {b_} * dl / mean_length))), 9) AS score,
       count(*) AS shared
FROM {asked} JOIN idf USING (term) JOIN tf USING (term), collection GROUP BY {keys}, pid"""


def top(source: str, k: int) -> str:
    return f"""
SELECT qid, pid, rank, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank FROM {source}) WHERE rank <= {k}"""


BM25 = {**LEXICAL, "bm25": bm25(), "pairs": top("bm25", CANDIDATES)}
CANDIDATE_TEXT = {**BM25, "candidates": "SELECT rank AS ord, qid, pid, text AS passage FROM pairs JOIN passages USING (pid)"}
GOLD = {"gold": "SELECT q.qid, p.pid, 3 AS rel FROM queries q JOIN passages p ON contains(p.text, q.text)"}

# --- expansion ---


def line(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


def first_words(text: str, n: int) -> str:
    return f"array_to_string(string_split({line(text)}, ' ')[1:{n}], ' ')"


OPENINGS_SQL = f"""
SELECT qid, text FROM (
  SELECT doc_id * {OPENINGS} + part AS qid, array_to_string(w[part * {OPENING_WORDS} + 1 : (part + 1) * {OPENING_WORDS}], ' ') AS text
  FROM (SELECT doc_id, string_split({line("text")}, ' ') AS w, unnest(range({OPENINGS})) AS part FROM documents))
WHERE text <> ''"""

ANSWERS = {
    "answers": f"""
SELECT conv_id AS qid, nullif({first_words("coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '')", 32)}, '') AS answer
FROM conversations GROUP BY conv_id""",
    "answered": "SELECT qid, coalesce(answer, text) AS text FROM queries LEFT JOIN answers USING (qid)",
}
FEEDBACK = {
    **CANDIDATE_TEXT,
    "feedback": "SELECT * FROM candidates WHERE ord <= 3",
    "feedback_tf": f"""
SELECT qid, term, count(*) AS tf FROM (SELECT qid, unnest({terms('passage')}) AS term FROM feedback)
ANTI JOIN asked USING (qid, term) GROUP BY qid, term""",
    "weighted": "SELECT qid, term, round(tf * idf, 9) AS weight FROM feedback_tf JOIN idf USING (term)",
    "best": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY weight DESC, term) AS place FROM weighted)
WHERE place <= 10""",
    "added": "SELECT qid, string_agg(term, ' ' ORDER BY place) AS added FROM best GROUP BY qid",
    "expanded": f"""
SELECT qid, {line("concat_ws(' ', text, added)")} AS text FROM queries LEFT JOIN added USING (qid)""",
}
EXPERIMENT = {
    **FEEDBACK,
    **GOLD,
    **ANSWERS,
    "variants": """
SELECT 'original' AS run, qid, text FROM queries UNION ALL SELECT 'answer', qid, text FROM answered
UNION ALL SELECT 'feedback', qid, text FROM expanded""",
    "variant_terms": f"SELECT DISTINCT run, qid, unnest({terms('text')}) AS term FROM variants",
    "variant_bm25": bm25("variant_terms", "run, qid"),
    "systems": """
SELECT v.run AS system, v.qid, p.pid, coalesce(s.score, 0) AS score
FROM variants v JOIN pairs p USING (qid) LEFT JOIN variant_bm25 s ON s.run = v.run AND s.qid = v.qid AND s.pid = p.pid""",
    "judged": "SELECT * FROM gold",
    **evaluation(),
}


POISSON_TIMES = " + ".join(f"(u >= {p})::INT" for p in POISSON)
SIGNIFICANCE = {
    "tall": " UNION ALL ".join(
        f"SELECT system, qid, '{name}' AS metric, {column} AS value FROM per_query"
        for name, column in (("ndcg@10", "m_ndcg"), ("recall@100", "m_recall"), ("map@1000", "m_map"))
    ),
    "changed": """
SELECT a.system, a.metric, a.qid, a.value - b.value AS d FROM tall a JOIN tall b USING (qid, metric)
WHERE b.system = 'original' AND a.system <> 'original'""",
    "digests": "SELECT *, md5(concat_ws(':', 5, r, qid)) AS digest FROM changed, (SELECT unnest(range(200)) AS r)",
    "draws": f"""
SELECT system, metric, r, d, CASE WHEN substr(digest, 1, 1) < '8' THEN 1 ELSE -1 END AS sign, {POISSON_TIMES} AS times
FROM (SELECT *, CAST('0x' || substr(digest, 9, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u FROM digests)""",
    "by_round": """
SELECT system, metric, r, count(*) AS n, sum(d) AS total, sum(sign * d) AS flipped, sum(times * d) / nullif(sum(times), 0) AS mean
FROM draws GROUP BY system, metric, r""",
}


def _swap(source: str, turn: int) -> str:
    """One round of the permutation over halves ``l`` and ``r``."""
    drawn = f"CAST('0x' || substr(md5(concat_ws(':', 7, epoch, {turn}, r)), 1, 8) AS BIGINT)"
    return f"SELECT epoch, n, side, r AS l, (l + {drawn}) % side AS r FROM ({source})"


_HALVES = """SELECT epoch, n, side, x // side AS l, x % side AS r FROM walk, rows_ WHERE NOT moved OR x >= total"""
PERMUTED = {
    "rows_": "SELECT count(*) AS total, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM labelled",
    "walk": f"""
SELECT epoch, n, n AS x, false AS moved FROM labelled, (SELECT unnest(range(2)) AS epoch)
UNION ALL
SELECT epoch, n, l * side + r, true FROM ({_swap(_swap(_swap(_swap(_HALVES, 0), 1), 2), 3)})""",
}


def statement(body: str, *steps: str | dict[str, str]) -> str:
    """``WITH`` all the named steps; a string names one of ``CTE``."""
    parts: dict[str, str] = {}
    for step in steps:
        parts.update({step: CTE[step]} if isinstance(step, str) else step)
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def _evaluated(body: str, systems: str = RUN_SYSTEMS, **settings) -> str:
    """``body`` over the metrics of ``systems``, with fused scores at hand."""
    steps: list[str | dict[str, str]] = ["evidence", "unranked", "runs", "qrels"]
    if "fused" in systems:
        steps += [{"parts": ONE_GROUP}, FUSION]
    steps += [{"systems": systems, "judged": "SELECT * FROM qrels"}, evaluation(**settings)]
    return statement(body, *steps)


def _fused(body: str) -> str:
    return statement(body, "evidence", "unranked", "runs", {"parts": ONE_GROUP}, FUSION)


def oracle() -> dict[str, str]:
    lexical = ("queries", "passages")
    text = ("triples", {"queries": OPENINGS_SQL}, "held", "text_triples", TEXT_SAMPLES)
    sql = {
        "ranked_candidates": """
WITH scored AS (
  SELECT event_id AS ord, user_id AS qid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pid, floor(value / 10) AS score
  FROM events),
kept AS (SELECT qid, pid, arg_max(score, ord) AS score, min(ord) AS ord FROM scored GROUP BY qid, pid)
SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, ord) AS rank, score FROM kept""",
        "ranked_runs": statement("SELECT run, qid, pid, rank, score FROM runs", "evidence", "unranked", "runs"),
        "query_metrics": _evaluated(
            """SELECT system AS run, qid, round(m_ndcg, 6) AS "ndcg@10", round(m_recall, 6) AS "recall@100",
round(m_map, 6) AS "map@1000" FROM per_query"""
        ),
        "run_metrics": _evaluated(MEANS),
        "run_metrics_short": _evaluated(
            """SELECT system, count(*) AS queries, round(avg(m_ndcg), 6) AS "ndcg@50", round(avg(m_recall), 6) AS "recall@50",
round(avg(m_map), 6) AS "map@50", round(avg(m_mrr), 6) AS "mrr@50" FROM per_query GROUP BY system""",
            ndcg=50, recall=50, ap=50, rr=50,
        ),
        "run_metrics_all_judged": _evaluated(
            """SELECT system, any_value(n) AS queries, round(sum(m_ndcg) / any_value(n), 6) AS "ndcg@10",
round(sum(m_recall) / any_value(n), 6) AS "recall@100", round(sum(m_map) / any_value(n), 6) AS "map@1000"
FROM per_query, (SELECT count(DISTINCT qid) AS n FROM judged) GROUP BY system"""
        ),
        "run_metrics_unjudged_run": _evaluated(
            """SELECT system, n AS queries, coalesce(round(sum(m_ndcg) / n, 6), 0) AS "ndcg@10",
coalesce(round(sum(m_recall) / n, 6), 0) AS "recall@100", coalesce(round(sum(m_map) / n, 6), 0) AS "map@1000"
FROM (SELECT DISTINCT system FROM systems) LEFT JOIN per_query USING (system), (SELECT count(DISTINCT qid) AS n FROM judged)
GROUP BY system, n""",
            f"{RUN_SYSTEMS} UNION ALL SELECT 'elsewhere', qid + 10000000, pid, score FROM unranked WHERE run = 'open'",
        ),
        "run_metrics_strict": statement(
            MEANS, "evidence", "unranked", "qrels",
            {
                "in_all": "SELECT qid FROM unranked GROUP BY qid HAVING count(DISTINCT run) = 3",
                "judged": "SELECT * FROM qrels SEMI JOIN in_all USING (qid)",
                "systems": f"SELECT * FROM ({RUN_SYSTEMS}) SEMI JOIN judged USING (qid)",
            },
            evaluation(),
        ),
        "run_metrics_trec_ties": _evaluated(MEANS, ties="CAST(s.pid AS VARCHAR) DESC"),
        "run_metrics_strict_grades": _evaluated(MEANS, min_rel=2),
        "run_metrics_percent": _evaluated(
            """SELECT system, count(*) AS queries, round(avg(m_ndcg) * 100, 2) AS "ndcg@10",
round(avg(m_recall) * 100, 2) AS "recall@100", round(avg(m_map) * 100, 2) AS "map@1000" FROM per_query GROUP BY system"""
        ),
        "parsed_log_metrics": _evaluated(
            """SELECT system, round(avg(m_ndcg) * 100, 2) AS "ndcg@10",
round(avg(m_recall) * 100, 2) AS "recall@100", round(avg(m_map) * 100, 2) AS "map@1000" FROM per_query GROUP BY system"""
        ),
        "queries_with_relevant": statement(
            "SELECT s_suppkey AS qid, s_name AS text FROM supplier SEMI JOIN (SELECT qid FROM qrels WHERE rel > 0) g ON g.qid = s_suppkey",
            "evidence", "qrels",
        ),
        "normalized_runs": _fused("SELECT run, qid, pid, rank, floor(norm * 1e6 + 0.5) / 1e6 AS score FROM normed"),
        "fused_scores": _fused(
            "SELECT qid, pid, " + ", ".join(f"""floor("{m}" * 1e6 + 0.5) / 1e6 AS "{m}\"""" for m in METHODS) + " FROM fused"
        ),
        "fusion_metrics": _evaluated(MEANS, FUSE_SYSTEMS),
        "fusion_leader": _evaluated(
            "SELECT system FROM per_query GROUP BY system ORDER BY round(avg(m_ndcg), 12) DESC, system LIMIT 1", FUSE_SYSTEMS
        ),
        "all_systems": _evaluated(
            f'SELECT * FROM ({MEANS}) ORDER BY "ndcg@10" DESC, system LIMIT 50', f"{RUN_SYSTEMS}\nUNION ALL {FUSE_SYSTEMS}"
        ),
        "pair_metrics": _pair_metrics(),
        "dev_queries": statement("SELECT qid FROM dev", "triples", SAMPLES),
        "dev_sample_ids": statement("SELECT * FROM dev_samples", "triples", SAMPLES),
        "training_triples": statement("SELECT * FROM triples ANTI JOIN held_out USING (qid)", "triples", SAMPLES),
        "training_sample_ids": statement("SELECT * FROM labelled", "triples", SAMPLES),
        "capped_sample_ids": statement("SELECT * FROM labelled ORDER BY ord LIMIT 5000", "triples", SAMPLES),
        "needed_passage_ids": statement("SELECT pid FROM needed", "triples", SAMPLES),
        "needed_collection": statement(
            "SELECT pid, text FROM passages SEMI JOIN needed USING (pid)", "triples", SAMPLES, "passages"
        ),
        "missing_passage_ids": statement("SELECT pid FROM needed ANTI JOIN held USING (pid)", "triples", SAMPLES, "held"),
        "missing_document_ids": statement(
            "SELECT pid FROM needed ANTI JOIN passages USING (pid)", "triples", SAMPLES, "passages"
        ),
        "all_training_texts": statement(
            """SELECT l.n, l.qid, l.pid, q.text AS query, p.text AS passage, l.label
FROM labelled l JOIN queries q USING (qid) JOIN passages p USING (pid)""", *text, "passages",
        ),
        "training_texts": statement(
            """SELECT l.n, l.qid, l.pid, q.text AS query, h.text AS passage, l.label
FROM labelled l JOIN queries q USING (qid) JOIN held h USING (pid)""", *text,
        ),
        "dev_texts": statement("SELECT * FROM dev_texts", *text),
        "dev_lists": statement(
            """SELECT qid, part, query, coalesce(string_agg(passage, chr(10) ORDER BY passage) FILTER (WHERE is_pos), '') AS positive,
coalesce(string_agg(passage, chr(10) ORDER BY passage) FILTER (WHERE NOT is_pos), '') AS negative
FROM (SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY pid, is_pos) - 1) // 1000 AS part FROM dev_texts)
GROUP BY qid, part, query""", *text,
        ),
        "training_batches": statement(
            """SELECT n, qid, pid, label,
(row_number() OVER (ORDER BY md5(concat('7:', n)), n) - 1) // 32 AS batch FROM labelled""", "triples", SAMPLES,
        ),
        "epoch_batches": statement(
            "SELECT n, qid, pid, label, epoch, x // 32 AS batch, x % 32 AS place FROM walk JOIN labelled USING (n), rows_ WHERE moved AND x < total",
            "triples", SAMPLES, PERMUTED,
        ).replace("WITH", "WITH RECURSIVE", 1),
        "training_summary": statement(
            """SELECT count(*) FILTER (WHERE kept) AS loaded, count(*) FILTER (WHERE kept AND label = 1) AS positives,
count(*) FILTER (WHERE kept AND label = 0) AS negatives, count(*) FILTER (WHERE NOT kept) AS dropped
FROM (SELECT l.label, q.qid IS NOT NULL AND h.pid IS NOT NULL AS kept
      FROM labelled l LEFT JOIN queries q USING (qid) LEFT JOIN held h USING (pid))""", *text,
        ),
        "bm25_top": statement(
            "SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM deep", *lexical, BM25, {"deep": top("bm25", 1000)}
        ),
        "bm25_indexed_top": statement(
            "SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM deep", *lexical, BM25, {"deep": top("bm25", 1000)}
        ),
        "bm25_indexed_again": statement(
            "SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM few",
            {"queries": OPENINGS_SQL}, "passages", BM25, {"few": top("bm25", 10)},
        ),
        "bm25_bounded_top": statement(
            "SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM few", *lexical, BM25, {"few": top("bm25", 10)}
        ),
        "bm25_merged_top": statement("SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM pairs", *lexical, BM25),
        "bm25_reranked": statement(
            """SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY r.score DESC, pid) AS rank, floor(r.score * 1e6 + 0.5) / 1e6 AS score
FROM pairs JOIN again r USING (qid, pid)""", *lexical, BM25, {"again": bm25(k1=1.2, b=0.75)},
        ),
        "retrieval_metrics": statement(
            MEANS, *lexical, BM25, GOLD,
            {"systems": f"SELECT 'bm25' AS system, qid, pid, score FROM ({top('bm25', 1000)})", "judged": "SELECT * FROM gold"},
            evaluation(),
        ),
        "holding_documents": statement("SELECT qid, pid, CAST(rel AS BIGINT) AS rel FROM gold", *lexical, GOLD),
        "candidate_pairs": statement(
            "SELECT ord, qid, pid, text AS query, passage FROM candidates JOIN queries USING (qid)", *lexical, CANDIDATE_TEXT
        ),
        **{name: _model_scored(lexical) for name in ("model_scored_pairs", "even_scored_pairs", "kept_pair_scores")},
        "softmax_scores": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       round(exp(b) / (exp(a) + exp(b) + exp(c)), 6) AS score
FROM (SELECT *, l_discount * 10 AS a, l_quantity / 10 AS b, l_tax * 10 AS c FROM lineitem)""",
        "truncated_texts": f"SELECT doc_id AS pid, {first_words('text', 512)} AS text FROM documents",
        "dev_reciprocal_rank": statement(
            """SELECT count(*) AS queries, round(avg(coalesce(1 / CAST(best AS DOUBLE), 0)), 6) AS "mrr@10" FROM (
  SELECT qid, min(CASE WHEN is_pos AND rank <= 10 THEN rank END) AS best FROM (
    SELECT d.qid, d.is_pos, row_number() OVER (PARTITION BY d.qid ORDER BY coalesce(b.score, 0) DESC, d.is_pos, d.pid) AS rank
    FROM dev_samples d JOIN passages USING (pid) LEFT JOIN bm25 b ON b.qid = d.qid AND b.pid = d.pid)
  GROUP BY qid HAVING bool_or(is_pos) AND NOT bool_and(is_pos))""", *text, "passages", BM25,
        ),
        "pair_features": statement(
            f"""SELECT p.qid, p.pid, floor(b.score * 1e6 + 0.5) / 1e6 AS bm25, b.shared, len(list_distinct({terms('q.text')})) AS query_terms,
len({terms('d.text')}) AS length
FROM pairs p JOIN bm25 b USING (qid, pid) JOIN queries q USING (qid) JOIN passages d USING (pid)""", *lexical, BM25,
        ),
        "ranker_training_table": statement(
            f"""SELECT t.qid, t.pid, floor(coalesce(b.score, 0) * 1e6 + 0.5) / 1e6 AS bm25, coalesce(b.shared, 0) AS shared,
len(list_distinct({terms('q.text')})) AS query_terms, len({terms('d.text')}) AS length, t.label
FROM (SELECT qid, pid, CAST(max(label) AS DOUBLE) AS label FROM labelled GROUP BY qid, pid) t
JOIN queries q USING (qid) JOIN passages d USING (pid) LEFT JOIN bm25 b USING (qid, pid)""", *text, "passages", BM25,
        ),
        "fitted_ranker_facts": statement(
            """SELECT true AS finite_weights, true AS rank_in_range, count(*) AS queries FROM (
  SELECT qid FROM dev_samples SEMI JOIN held_out USING (qid) SEMI JOIN passages USING (pid) GROUP BY qid HAVING bool_or(is_pos) AND NOT bool_and(is_pos))""",
            *text, "passages",
        ),
        "feedback_context": statement(
            "SELECT qid, string_agg(passage, chr(10) || chr(10) ORDER BY ord) AS passages FROM feedback GROUP BY qid",
            *lexical, FEEDBACK,
        ),
        "plain_prompts": r"""SELECT item_id AS qid,
concat('Rewrite this search query.', chr(10), 'Query: ', text, chr(10), 'Answer:') AS prompt FROM benchmark""",
        "feedback_prompts": statement(
            """SELECT qid, concat('Rewrite this search query.', chr(10), 'Query: ', text, chr(10), chr(10), coalesce(numbered, ''),
chr(10), chr(10), 'Answer:') AS prompt
FROM queries LEFT JOIN (
  SELECT qid, string_agg(concat('Passage ', ord, ': ', passage), chr(10) || chr(10) ORDER BY ord) AS numbered
  FROM feedback GROUP BY qid) USING (qid)""", *lexical, FEEDBACK,
        ),
        "answered_queries": statement("SELECT * FROM answered", "queries", ANSWERS),
        "appended_queries": statement(
            "SELECT qid, concat_ws(' ', text, answer) AS text FROM queries LEFT JOIN answers USING (qid)", "queries", ANSWERS
        ),
        "generated_responses": """
SELECT qid, concat(prompt, ' (', length(prompt), ' characters)') AS response FROM (SELECT item_id AS qid,
concat('Rewrite this search query.', chr(10), 'Query: ', text, chr(10), 'Answer:') AS prompt FROM benchmark)""",
        "kept_responses": """
SELECT qid, CASE WHEN length(prompt) % 3 = 0 THEN concat('again ', prompt) ELSE concat(prompt, ' (', length(prompt), ' characters)') END AS response,
CASE WHEN length(prompt) % 3 = 0 THEN 'ValueError: too hard' END AS first_reason FROM (SELECT item_id AS qid,
concat('Rewrite this search query.', chr(10), 'Query: ', text, chr(10), 'Answer:') AS prompt FROM benchmark)""",
        "best_feedback_terms": statement("SELECT qid, term, floor(weight * 1e6 + 0.5) / 1e6 AS weight, place FROM best", *lexical, FEEDBACK),
        "feedback_expanded_queries": statement("SELECT * FROM expanded", *lexical, FEEDBACK),
        "feedback_mixed_top": statement(
            "SELECT qid, pid, rank, floor(score * 1e6 + 0.5) / 1e6 AS score FROM few", *lexical, FEEDBACK,
            {
                "asked_size": "SELECT qid, count(*) AS size FROM asked GROUP BY qid",
                "told_by": "SELECT p.qid, p.pid, p.score, sum(p.score) OVER (PARTITION BY p.qid) AS total FROM pairs p WHERE p.rank <= 3",
                "likely": """
SELECT qid, term, round(sum(score / total / dl * tf), 9) AS p FROM told_by JOIN tf USING (pid) GROUP BY qid, term""",
                "likeliest": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY p DESC, term) AS place FROM likely) WHERE place <= 20""",
                "mixed": """
SELECT qid, term, round(sum(weight), 9) AS weight FROM (
  SELECT qid, term, CAST(0.5 AS DOUBLE) AS weight FROM asked
  UNION ALL
  SELECT qid, term, CAST(0.5 AS DOUBLE) * size * (p / sum(p) OVER (PARTITION BY qid)) FROM likeliest JOIN asked_size USING (qid))
GROUP BY qid, term""",
                "mixed_bm25": """
SELECT qid, pid, round(sum(weight * idf * tf * (CAST(0.9 AS DOUBLE) + 1) / (tf + CAST(0.9 AS DOUBLE) *
  (1 - CAST(0.4 AS DOUBLE) + CAST(0.4 AS DOUBLE) * dl / mean_length))), 9) AS score
FROM mixed JOIN idf USING (term) JOIN tf USING (term), collection GROUP BY qid, pid""",
                "few": top("mixed_bm25", 100),
            },
        ),
        "expansion_significance": statement(
            """SELECT system, metric, max(n) AS queries, floor(avg(total / n) * 1e6 + 0.5) / 1e6 AS change,
floor((count(*) FILTER (abs(flipped) >= abs(total) - 1e-9) + 1) / 201.0 * 1e6 + 0.5) / 1e6 AS p_value,
floor(quantile_cont(mean, 0.025) * 1e6 + 0.5) / 1e6 AS low, floor(quantile_cont(mean, 0.975) * 1e6 + 0.5) / 1e6 AS high
FROM by_round GROUP BY system, metric""", *lexical, EXPERIMENT, SIGNIFICANCE,
        ),
        "expansion_metrics": statement(MEANS, *lexical, EXPERIMENT),
        "expansion_changes": statement(
            """SELECT system, metric, round(before, 6) AS before, round(after, 6) AS after, round(after - before, 6) AS change
FROM tall JOIN (SELECT metric, after AS before FROM tall WHERE system = 'original') USING (metric)""",
            *lexical, EXPERIMENT,
            {
                "tall": " UNION ALL ".join(
                    f"SELECT system, '{name}' AS metric, avg({column}) AS after FROM per_query GROUP BY system"
                    for name, column in (("ndcg@10", "m_ndcg"), ("recall@100", "m_recall"), ("map@1000", "m_map"))
                )
            },
        ),
        "reread_runs": statement(
            "SELECT run, CAST(qid AS VARCHAR) AS qid, CAST(pid AS VARCHAR) AS pid, rank, score FROM runs",
            "evidence", "unranked", "runs",
        ),
        "reread_dirty_runs": statement(
            "SELECT run, CAST(qid AS VARCHAR) AS qid, CAST(pid AS VARCHAR) AS pid, rank, score FROM runs WHERE pid % 97 > 2",
            "evidence", "unranked", "runs",
        ),
        "bad_run_lines": statement(
            """SELECT run AS file,
CASE pid % 97 WHEN 0 THEN '4 fields, not 6' WHEN 1 THEN 'rank is no number: first' ELSE 'score is no number: NaN' END AS reason,
CASE pid % 97 WHEN 0 THEN concat_ws(' ', qid, 'Q0', pid, rank) WHEN 1 THEN concat_ws(' ', qid, 'Q0', pid, 'first 1.5 t')
  ELSE concat_ws(' ', qid, 'Q0', pid, rank, 'NaN t') END AS line FROM runs WHERE pid % 97 <= 2""",
            "evidence", "unranked", "runs",
        ),
        "reread_repeated_runs": statement(
            "SELECT run, CAST(qid AS VARCHAR) AS qid, CAST(pid AS VARCHAR) AS pid, rank - 1 AS rank, score FROM runs",
            "evidence", "unranked", "runs",
        ),
        "fused_zero_based_runs": _evaluated(MEANS, FUSE_SYSTEMS),
        "reread_passages": rf"""
SELECT CAST(doc_id AS VARCHAR) AS pid, row_number() OVER (ORDER BY doc_id) - 1 AS ord,
       concat(CASE WHEN doc_id % 2 = 1 THEN 'again ' ELSE '' END, {line('text')}, chr(9), 'end') AS text
FROM documents""",
        "reread_any_results": """
SELECT 'brands' AS source, p_brand AS model, count(*) AS steps, CAST(max(p_size) AS BIGINT) AS size, CAST(-1 AS BIGINT) AS key
FROM part GROUP BY p_brand
UNION ALL SELECT 'nations', n_name, -1, -1, CAST(n_nationkey AS BIGINT) FROM nation""",
        "reread_qrels": statement(
            "SELECT CAST(qid AS VARCHAR) AS qid, CAST(pid AS VARCHAR) AS pid, rel FROM qrels WHERE rel >= 1", "evidence", "qrels"
        ),
        "reread_triples": statement(
            """SELECT ord, CAST(qid AS VARCHAR) AS qid, CAST(pos_id AS VARCHAR) AS pos_id, CAST(neg_id AS VARCHAR) AS neg_id
FROM triples""", "triples",
        ),
        "reread_queries": f"SELECT CAST(item_id AS VARCHAR) AS qid, {line('text')} AS text FROM benchmark",
        "reread_candidates": statement(
            f"""SELECT row_number() OVER (ORDER BY qid, rank) - 1 AS ord, CAST(qid AS VARCHAR) AS qid, CAST(pid AS VARCHAR) AS pid,
{line('text')} AS passage FROM pairs JOIN passages USING (pid)""", *lexical, BM25,
        ),
        "reread_results": _evaluated(
            f"""SELECT CASE WHEN system LIKE 'fuse:%' THEN 'fused' ELSE 'base' END AS source, system, {METRIC_COLUMNS}
FROM per_query GROUP BY system""", f"{RUN_SYSTEMS}\nUNION ALL {FUSE_SYSTEMS}",
        ),
        "passage_terms": statement("SELECT pid, dl, term, tf FROM tf", "passages", LEXICAL_COUNTS),
        "collection_statistics": statement(
            "SELECT n AS passages, round(mean_length, 6) AS mean_length FROM collection", "passages", LEXICAL_COUNTS
        ),
    }
    for method in METHODS:
        sql[f"fused_{method}"] = _fused(
            f"""SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY "{method}" DESC, pid) AS rank,
floor("{method}" * 1e6 + 0.5) / 1e6 AS score FROM fused"""
        )
    return sql


LEXICAL_COUNTS = {name: LEXICAL[name] for name in ("listed", "collection", "tf")}


def _model_scored(lexical: tuple[str, str]) -> str:
    return statement(
        """SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, ord) AS rank, floor(score * 1e6 + 0.5) / 1e6 AS score
FROM (SELECT c.ord, c.qid, c.pid, count(h.word) / CAST(count(*) AS DOUBLE) AS score
  FROM candidates c JOIN asked_words a USING (qid) LEFT JOIN held_words h ON h.pid = c.pid AND h.word = a.word
  GROUP BY c.ord, c.qid, c.pid)""",
        *lexical, CANDIDATE_TEXT,
        {
            "asked_words": rf"SELECT DISTINCT qid, unnest(string_split({line('text')}, ' ')) AS word FROM queries",
            "held_words": rf"SELECT DISTINCT pid, unnest(string_split({line('text')}, ' ')) AS word FROM passages",
        },
    )


def _pair_metrics() -> str:
    """All pairs under all methods; the best method over all runs picks the rows."""
    pair_runs = """
SELECT n.a || '+' || n.b AS grp, r.* FROM runs r
JOIN (SELECT x.run AS a, y.run AS b FROM (SELECT DISTINCT run FROM runs) x JOIN (SELECT DISTINCT run FROM runs) y ON x.run < y.run) n
ON r.run = n.a OR r.run = n.b
UNION ALL SELECT 'all', * FROM runs"""
    systems = "\nUNION ALL ".join(
        f"""SELECT CASE WHEN grp = 'all' THEN 'fuse:{m}' ELSE 'pair:' || grp || ' ({m})' END AS system, qid, pid, "{m}" AS score
FROM fused""" for m in METHODS
    )
    body = f"""SELECT t.* FROM ({MEANS}) t, leader WHERE t.system LIKE 'pair:%(' || leader.method || ')'"""
    leader = """
SELECT substr(system, 6) AS method FROM per_query WHERE system LIKE 'fuse:%'
GROUP BY system ORDER BY round(avg(m_ndcg), 12) DESC, system LIMIT 1"""
    return statement(
        body, "evidence", "unranked", "runs", "qrels", {"parts": pair_runs}, FUSION,
        {"systems": systems, "judged": "SELECT * FROM qrels"}, evaluation(), {"leader": leader},
    )
