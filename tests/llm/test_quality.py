import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankflow.llm import quality

FOLDER = "/root/testdata/sf0.001"


def slow_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


@pytest.mark.parametrize(
    "text", ["", " \n\t", "a", "a b c a b c", "a a a a a", "x\nx\n\n x\nx", "É#é\xa0b $|<", "a b c d a b c", "a\x0bb\x0cc\rd", "w " * 99_999]
)
def test_figures(text):
    if len(text) < 1000:
        assert quality.figures(text) == slow_figures(text)
    else:
        assert quality.figures(text)[0] == quality.figures(text)[4] == 99_999


def test_figures_of_all_documents(spark):
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert quality.figures(r.text) == slow_figures(r.text)


def corpus(rng):
    def line():
        return " ".join(rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(12))

    rows, boiler = [], "All Rights  reserved 2024"
    for d in range(60):  # a host with a boilerplate line in distinct documents
        own = [line() for _ in range(6)]
        rows.append((d, "\n".join([boiler.replace("2024", str(2000 + d)), *own]), "h"))
    copied = "\n".join(line() for _ in range(8))
    rows += [(100 + d, copied, "h") for d in range(80)]  # many exact copies are one document
    near = [line() for _ in range(12)]
    rows += [(200 + d, "\n".join([*near, line()]), "h") for d in range(60)]  # 60 distinct documents share twelve lines
    rows += [(300 + d, "\n".join([boiler, *[line() for _ in range(6)]]), "g") for d in range(5)]  # below the limit there
    rows += [(400, "\n".join([*([boiler] * 40), line()]), "h"), (401, None, "h"), (402, "", None), (403, "\n".join([boiler] * 30), None)]
    return rows


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return docs.withColumns({"line": F.lit("x"), "_x": F.lit(1), "kept": F.lit(None).cast("int")})


def test_lines_common_to_distinct_documents_go(spark, rng, monkeypatch):
    rows = corpus(rng)
    results = []
    for bound in (quality.MOST_BROADCAST, 0):  # as a set, and as a join
        monkeypatch.setattr(quality, "MOST_BROADCAST", bound)
        results.append({r.key: r for r in quality.quality(frame(spark, rows)).collect()})
    assert results[0] == results[1]
    got = results[0]
    assert len(got) == len(rows)
    assert all(got[d].n_lines_removed == 1 and got[d].kept for d in range(60))
    assert all(got[d].n_lines_removed == 0 and got[d].kept for d in [*range(100, 180), *range(300, 305)])
    assert all(got[d].n_lines_removed == 12 and not got[d].kept for d in range(200, 260))
    assert got[400].n_lines_removed == 40 and not got[400].kept and got[400].base_failed
    assert not got[401].kept and not got[402].kept and got[403].n_lines_removed == 0


def test_depleted_documents_are_rejected(spark, rng):
    rows = corpus(rng)
    boiler = [" ".join(rng.choice("klmno") + str(n) for n in range(k, k + 40)) for k in range(3)]
    rows += [(500 + d, "\n".join([*boiler, " ".join(f"u{d}x{i}" for i in range(20))]), "h") for d in range(40)]
    got = {r.key: r for r in quality.quality(frame(spark, rows)).collect()}
    assert all(not got[500 + d].kept and not got[500 + d].base_failed and got[500 + d].n_words_left < 60 for d in range(40)) or all(
        got[500 + d].kept for d in range(40)
    )
    assert sum(got[500 + d].kept for d in range(40)) in (0, 40)


@pytest.mark.parametrize(("block", "own"), [(3, 1), (3, 3), (5, 1), (5, 3)])
def test_lines_of_blocks_count_every_document(spark, block, own):
    """2,000 distinct documents, five blocks in 400 documents each: all block lines are over the limit of 100."""
    def line(name):
        return " ".join(chr(97 + int(x)) for x in str(name)) + " line with words"

    rows = [
        (d, "\n".join([*(line(10_000 + d % 5 * 100 + k) for k in range(block)), *(line(1_000_000 + d * 10 + k) for k in range(own))]), "h")
        for d in range(2000)
    ]
    assert quality.frequent_lines(frame(spark, rows)).count() == 5 * block


def test_exact_counts_beside_any_own_lines(spark):
    """Blocks of 1 to 30 lines in 30 of 60 documents with 1 to 5 own lines, one host each, and 40 copies of one document."""
    def line(*name):
        return " ".join(chr(97 + int(x)) * 3 for n in name for x in f"{n:03d}") + " line"

    rows, expected, count = [], {}, {}
    for block in range(1, 31):
        for own in range(1, 6):
            host = f"{block}-{own}"
            shared = [line(block, own, 900 + k) for k in range(block)]
            docs = [[*(shared if d < 30 else []), *(line(block, own, d, k) for k in range(own))] for d in range(60)]
            docs += [[line(block, own, 800, k) for k in range(block + own)]] * 40
            rows += [(len(rows), "\n".join(lines), host) for lines in docs]
            for lines in {tuple(sorted(lines)) for lines in docs}:
                for text in lines:
                    count[host, text] = count.get((host, text), 0) + 1
            expected |= {quality.line_keys(text, host)[0][0]: 30 for text in shared}
    assert all((n == 30) == (n > 20) for n in count.values())
    assert {r.line: r.n for r in quality.frequent_lines(frame(spark, rows)).collect()} == expected


@pytest.mark.parametrize("host_docs", [400, 4000])
def test_long_lines_have_one_limit_at_every_host_size(spark, host_docs):
    def name(n):
        return "".join(chr(97 + int(x)) for x in str(n))

    long, short = " ".join(f"w{name(k)}" for k in range(25)), "all rights"
    rows = [
        (d, "\n".join([*([long, short] if d < 21 else []), *(f"own {name(d)} {name(k)}" for k in range(4))]), "h") for d in range(host_docs)
    ]
    assert quality.frequent_lines(frame(spark, rows)).count() == (2 if host_docs == 400 else 1)


def test_depleted_documents_go(spark, rng):
    rows = corpus(rng)
    boiler = [" ".join(rng.choice("klmno") + chr(97 + n % 26) for n in range(k, k + 40)) for k in range(3)]
    rows += [(500 + d, "\n".join([*boiler, " ".join(f"u{chr(97 + d % 26)}{chr(97 + d // 26)}x{chr(97 + i)}" for i in range(20))]), "h") for d in range(40)]
    got = {r.key: r for r in quality.quality(frame(spark, rows)).collect()}
    assert all(not got[500 + d].kept and got[500 + d].n_words_left == 20 for d in range(40))


def test_filtered_cuts_lines_and_keeps_columns(spark, rng):
    docs = frame(spark, corpus(rng))
    got = {r.doc_id: r for r in quality.filtered(docs).collect()}
    assert quality.filtered(docs).columns == docs.columns
    assert set(got) == {*range(60), *range(100, 180), *range(300, 305)}
    assert all("rights" not in got[d].text.lower() for d in range(60)) and "Rights" in got[300].text


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert quality.quality(docs).collect() == [] and quality.filtered(docs).collect() == []


def test_query(spark):
    from rankflow.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op3_quality_rules"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        slow = slow_figures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow
        assert r.base_failed == (slow[0] < 50 or 100 * slow[4] > 50 * slow[0])
        assert not (r.kept and r.base_failed)
