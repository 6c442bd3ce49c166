from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankflow.llm import tokens
from rankflow.llm.queries import QUERIES, WORD_TOKENIZER, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " \n ", "Hello, World!  it's 42", "<|endoftext|> a<|startoftext|>b <|end oftext|>", "é é ́x", "a\x1cb\x1fc d\x85e f　g",
    "don't 'S ''ll", "日本語 テキスト", "x" * 5000, "word " * 100_000, "İstanbul ΑΣ ΣΑΣ", "�​  ",
]


def direct(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER))
    return [len(tokenizer.encode(t or "", add_special_tokens=False)) for t in texts]


def test_counts_equal_whole_encodings(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit("x")).withColumn("key", F.lit(0))
    got = tokens.token_counts(docs, tokenizer_path(WORD_TOKENIZER)).collect()
    want = direct(t for _, t in rows)
    assert sorted((r.key is None, r.key, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (k is None, k, len((t or "").encode()), n, n > 2048) for (k, t), n in zip(rows, want, strict=True)
    )


def test_memory_is_bounded():
    counter = tokens.Counter(tokenizer_path(WORD_TOKENIZER), known=3)
    texts = [f"w{i} same q{i % 3}" for i in range(20)]
    assert [counter.lengths([t.encode()])[0] for t in texts] == direct(texts)
    assert len(counter.known) <= 6


def test_batches_of_equal_bytes():
    pieces = [b"x" * n for n in (1, 500, 3, 90, 90, 90, 1)]
    batches = list(tokens.byte_batches(pieces, 200))
    assert [p for b in batches for p in b] == pieces and len(batches) == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokens.token_counts(docs, tokenizer_path(WORD_TOKENIZER)).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = dict(zip(texts, direct(texts.values()), strict=True))
    got = QUERIES["op8_token_counts"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(want)
