"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import (
    chat,
    cotraining,
    decontamination,
    linededup,
    pages,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    tokens,
    whitening,
)
from rankflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
PIECE_SEED = 11


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary files are, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_text_shards(spark: SparkSession, folder: str) -> DataFrame:
    sharded = sharding.shard(table(spark, folder, "documents"))
    return sharded.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select(F.col("key").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality(table(spark, folder, "documents"))
    return judged.withColumnRenamed("key", "doc_id")


def op4_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages")).withColumnRenamed("key", "page_id")


def op5_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


def op6_dropout_pieces(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(table(spark, folder, "documents"), tokenizer_path(PIECE_MODEL), seed=PIECE_SEED)
    return encoded.withColumnRenamed("key", "doc_id")


def op7_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = cotraining.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumnRenamed("key", "doc_id")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokens.token_counts(table(spark, folder, "documents"), tokenizer_path(WORD_TOKENIZER))
    return counted.withColumnRenamed("key", "doc_id")


def op9_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.scan(docs, secrets.train_on(docs)).withColumnRenamed("key", "doc_id")


def op10_speaker_views(spark: SparkSession, folder: str) -> DataFrame:
    views = chat.dialogues(table(spark, folder, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return views.select(F.col("conv").alias("conv_id"), "speaker", "part", "n_turns", "dialogue", spans.alias("mask"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    if found is None:
        kinds = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kinds)
    shares = F.array(*[F.lit(float(e)) for e in found.explained])
    return found.rows.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get(shares, "at").alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    cleaned = linededup.clean(linededup.indexed(docs), docs)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return cleaned.select(F.col("key").alias("doc_id"), "n_lines", "n_dropped", digest.alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_text_shards": op1_text_shards,
    "op2_simhash_components": op2_simhash_components,
    "op3_quality_rules": op3_quality_rules,
    "op4_page_text": op4_page_text,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_dropout_pieces": op6_dropout_pieces,
    "op7_quality_scores": op7_quality_scores,
    "op8_token_counts": op8_token_counts,
    "op9_secret_spans": op9_secret_spans,
    "op10_speaker_views": op10_speaker_views,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    # Items of five words or more, as all of the table are.
    "op5_benchmark_leaks": r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
), doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared
  FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9
""",
    "op10_speaker_views": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'
), views AS (
  SELECT conv_id, speaker, turn, role, role = speaker AS own,
    '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant'
      ELSE 'user name=' || role END || chr(10) AS head,
    body || '<|im_end|>' || chr(10) AS tail
  FROM said JOIN speakers USING (conv_id)
), placed AS (
  SELECT *, coalesce(sum(length(head || tail)) OVER (
    PARTITION BY conv_id, speaker ORDER BY turn, role, head || tail
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM views
), parts AS (
  SELECT *, start // 8192 AS part FROM placed
), based AS (
  SELECT *, start - min(start) OVER (PARTITION BY conv_id, speaker, part) AS place FROM parts
)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || tail, '' ORDER BY start) AS dialogue,
  coalesce(string_agg((place + length(head)) || ':' || (place + length(head || tail) - 1), ',' ORDER BY start) FILTER (own), '') AS mask
FROM based GROUP BY conv_id, speaker, part
""",
    "op13_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, line, place, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
  )
), repeated AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, line, place, first IS NOT NULL AND first <> doc_id AS gone FROM lines LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
