import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import spelling

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_vocabulary(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items()}


def frame(spark, docs):
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    return rows.withColumns({"word": F.lit("x"), "n": F.lit(1), "root": F.lit(None).cast("int"), "doc": F.lit("y"), "near": F.lit(2)})


def result(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def corpus(rng):
    """Texts over words with misspellings, which lead to misspellings again, in several alphabets."""
    words = ["".join(rng.choice("abcé×ÿz") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    for _ in range(300):
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é", "À", "zz"])
        words.append("".join(w) or "word")
    weights = [1 / (k + 1) for k in range(len(words))]
    texts = [" ,ő中-".join(rng.choices(words, weights, k=60)).replace("z", rng.choice("zZ")) for _ in range(150)]
    return list(enumerate(texts))


@pytest.mark.parametrize("bounds", [{}, {"class_words": 16, "round_bytes": 200}])
def test_equals_definition(spark, rng, bounds):
    docs = [*corpus(rng), (None, "abcde abcdé abcde"), (None, "abcde"), (900, None), (901, ""), (902, "abcde " * 500), (902, "abcde " * 500)]
    found = spelling.variants(frame(spark, docs), **bounds)
    expected = slow_variants(slow_vocabulary(docs))
    assert len(expected) > 100 and any(r[3] and r[5] != r[3] for r in expected)  # chains are among them
    assert result(found) == expected


def test_long_runs_and_runs_of_one_letter(spark):
    long = "ab" * 5000
    docs = [(d, f"{long} {long[1:]} {long[:-1]}c aaaaaa aaaaa {'z' * 64} {'z' * 65} {'z' * 63} {'z' * 64}") for d in range(4)]
    words = slow_vocabulary(docs)
    assert result(spelling.variants(frame(spark, docs))) == slow_variants(words) and len(words) >= 8


def test_hashes_of_edits(rng):
    words = ["".join(rng.choice("abcé") for _ in range(7)) for _ in range(9)]
    codes = spelling._codes(words)
    gone, put = spelling.deletions(codes, 2, 7), spelling.replacements(codes, 2, 7)
    for i, w in enumerate(words):
        for k in range(5):
            assert gone[i, k] == spelling.hashes(spelling._codes([w[: 2 + k] + w[3 + k :]]))[0]
            for letter, code in list(enumerate(spelling.ALPHABET))[::9]:
                assert put[i, k, letter] == spelling.hashes(spelling._codes([w[: 2 + k] + chr(code) + w[3 + k :]]))[0]


def test_filters_hold_their_words_and_few_others():
    draw = np.random.default_rng(5).integers(0, 1 << 64, 40_000, dtype=np.uint64)
    lanes = spelling.built(draw[:20_000])
    assert len(spelling.positive(lanes, draw[:20_000])) == 20_000
    assert len(spelling.positive(lanes, draw[20_000:])) < 200
    assert len(spelling.positive(spelling.built(draw[:0]), draw[:10])) == 0


def test_empty_table_and_no_words(spark):
    assert spelling.variants(frame(spark, [])).collect() == []
    assert spelling.variants(frame(spark, [(1, "a b c"), (2, None)])).collect() == []


def test_query(spark):
    from rankflow.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert result(QUERIES["op11_spelling_variants"](spark, FOLDER)) == slow_variants(slow_vocabulary(docs))
