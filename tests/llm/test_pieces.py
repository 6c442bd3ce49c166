import random

import sentencepiece
from pyspark.sql import functions as F

from rankflow.llm import pieces
from rankflow.llm.queries import PIECE_MODEL, QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
PATH = tokenizer_path(PIECE_MODEL)
TEXTS = [
    "", None, " ", "  two  blanks  ", "Hello world\n\n\tfoo\r\n bar", "naïve café 日本語 🙂 ‍", "▁bar ▁▁ a▁b", "\0 \0▁ x\0", "a" * 3000,
    "word " * 20_000, "<s> </s> <unk> <0x0A>", "internationalisation of representations", " 　",
]


def texts_of(spark):
    return [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_without_dropout_as_the_library(spark):
    library, ours = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.Model(PATH, rate=0)
    for text in [t or "" for t in TEXTS] + texts_of(spark)[:60]:
        if pieces.BLANK not in text:
            assert ours.encode(text) == library.encode(text)
        assert ours.decode(ours.encode(text)) == text


def slow_segment(model, stretch, variant):
    """Best candidate by scanning all pairs each time; skipped candidates stay skipped while they last."""
    symbols = [("▁" if c == " " else "\0▁" if c == "▁" else c, i) for i, c in enumerate(stretch)]
    key = pieces.xxhash.xxh64_intdigest(stretch, model.seed * 1_000_003 + variant)
    while True:
        pairs = [(model.cost[a + b], i, n, a + b) for n, ((a, i), (b, _)) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in model.cost]
        pairs = [p for p in pairs if not (model.skip_below and pieces.xxhash.xxh64_intdigest(p[3], key ^ p[1]) < model.skip_below)]
        if not pairs:
            break
        _, at, n, merged = min(pairs)
        symbols[n : n + 2] = [(merged, at)]
    return tuple(x for s, _ in symbols for x in ([model.ids[s]] if s in model.ids else [model.bytes[b] for b in s.removeprefix("\0").encode() or b"\0"]))


def test_agenda_equals_scanning(monkeypatch):
    rng = random.Random(4)
    for rate in (0.0, 1.0, 0.5, 0.1):
        model = pieces.Model(PATH, rate=rate, seed=3)
        for _ in range(150):
            stretch = " " + "".join(rng.choice("thearonisé ▁日") for _ in range(rng.randint(1, 25)))
            assert model.segment(stretch, 1) == slow_segment(model, stretch, 1)
    monkeypatch.setattr(pieces, "SHORT", 0)
    for stretch in (" representations", " thethethe▁é日", " aaaaaaaaaaaa"):
        assert model.segment(stretch, 2) == slow_segment(model, stretch, 2)


def test_many_stretches_at_a_time(monkeypatch):
    """Each comes out as alone, whatever is merged beside it, and however texts are put together."""
    rng = random.Random(7)
    stretches = [" " + "".join(rng.choice("thearonisé ▁日\0🙂") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["x", "\n"]
    variants = [rng.randrange(4) for _ in stretches]
    for rate in (0.0, 0.3):
        model = pieces.Model(PATH, rate=rate, seed=3)
        for rows in (7, pieces.ROWS):
            monkeypatch.setattr(pieces, "ROWS", rows)
            found = model.segments(stretches, variants)
            assert [tuple(pieces.np.frombuffer(f, "int32")) for f in found] == [slow_segment(model, s, v) for s, v in zip(stretches, variants, strict=True)]
    texts = ["".join(rng.choices(stretches, k=40)) for _ in range(30)] + ["", "y" * 100]
    keys = [str(i) for i in range(len(texts))]
    alone = [pieces.Model(PATH, seed=2).encode(t, k) for t, k in zip(texts, keys, strict=True)]
    for chars, portion in ((1, 3), (1, pieces.PORTION), (500, 7), (pieces.CHARS, pieces.PORTION)):
        monkeypatch.setattr(pieces, "CHARS", chars)
        monkeypatch.setattr(pieces, "PORTION", portion)
        assert [ids.tolist() for ids in pieces.Model(PATH, seed=2).encode_all(texts, keys)] == alone


def test_seeds_vary_and_repeat(spark):
    text = texts_of(spark)[5]
    plain = pieces.Model(PATH, rate=0).encode(text)
    one, again, other = (pieces.Model(PATH, seed=s).encode(text, "7") for s in (1, 1, 2))
    assert one == again != other and len(one) > len(plain)
    turns = pieces.Model(PATH, rate=0.5, seed=1)
    assert len({turns.segment(" from", v) for v in range(pieces.VARIANTS)}) > 1
    ids = turns.encode("from " * 8, "7")
    assert ids == turns.encode("from " * 8, "7") and ids[: len(ids) // 2] != ids[: 4] * (len(ids) // 8)
    assert len({pieces.Model(PATH, rate=0.3, seed=s).segment(" representation", 0) for s in range(20)}) > 5


def test_stretches_of_every_length_vary():
    model = pieces.Model(PATH, rate=0.3, seed=1)
    word = model.encode("representation " * 40, "7")
    assert len({tuple(word[i : i + 3]) for i in range(len(word) - 2)}) > 12
    for stretch in (" however", " representation", " internationalisation"):
        turns = [model.segment(stretch, v) for v in range(pieces.VARIANTS)]
        assert len(set(turns)) > 1
        ids = model.encode((stretch * 8)[1:], "7")
        start = pieces.xxhash.xxh64_intdigest("7", 1)
        assert ids == [x for turn in range(8) for x in turns[(start + turn) % pieces.VARIANTS]]


def test_round_trip(spark):
    rows = [*enumerate(TEXTS), (4, TEXTS[4]), (None, TEXTS[5])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("x")).withColumn("pieces", F.lit(0))
    encoded = pieces.encode(docs, PATH, rate=0.2, seed=9)
    assert all(r.lossless and r.n_pieces == len(r.pieces) for r in encoded.collect())
    got = pieces.decode(encoded, PATH).collect()
    assert sorted((str(r.key), r.text) for r in got) == sorted((str(k), t or "") for k, t in rows)


def test_empty_table_and_memory(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
    model = pieces.Model(PATH, seed=5)
    full = model.encode("one two three four five six")
    model.known = [{} for _ in model.known]
    old, pieces.KNOWN = pieces.KNOWN, 2
    try:
        assert model.encode("one two three four five six") == full and all(len(k) <= 1 for k in model.known)
    finally:
        pieces.KNOWN = old


def test_memory_on_a_long_text(monkeypatch):
    """A text of many different words leaves no more in memory than the bound, and encodes as with much memory."""
    text = " ".join(f"w{i}x" for i in range(3000)) + " " + "z" * 60
    full = pieces.Model(PATH, seed=5).encode(text, "7")
    monkeypatch.setattr(pieces, "CHARS", 100)
    monkeypatch.setattr(pieces, "PORTION", 40)
    monkeypatch.setattr(pieces, "KNOWN", 400)
    model = pieces.Model(PATH, seed=5)
    assert model.encode(text, "7") == full and model.decode(full) == text
    assert all(len(m) <= 50 + 40 for m in (*model.known, *model.older))


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op6_dropout_pieces"](spark, FOLDER).collect()
    model = pieces.Model(PATH, rate=0)
    assert len(got) == len(texts) and all(r.lossless for r in got)
    assert all(model.decode(r.pieces) == texts[r.doc_id] for r in got)
