import random
import re

import xxhash
from pyspark.sql import functions as F

from rankflow.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


TEXTS = [
    "", None, " \t\n", "one", "One TWO", "one  two\tthree", "a b c d", "a b c d e f g É É \x0b\x0c x y",
    "word " * 300_000, "word " * 7,
]


def test_fingerprint_equals_definition(rng):
    texts = TEXTS + [" ".join(rng.choice("ab cd ef É gh\n ij".split(" ")) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for text in texts:
        if text and len(text) > 10_000:
            continue
        assert simhash.fingerprint(text or "") == slow_fingerprint(text)
    assert simhash.fingerprint("word " * 300_000) == slow_fingerprint("word word word word")


def planted(rng):
    """Prints in chains and balls around centres, near each other and far apart."""
    prints = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            at = centre
            for _ in range(rng.randint(0, 5)):
                at ^= 1 << rng.randrange(64)
            prints.add(at)
            if rng.random() < 0.2:
                centre = at
    return prints | {rng.getrandbits(64) for _ in range(300)}


def found_components(spark, prints, crowd, segments):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "print bigint"), crowd, segments)
    label = {r.node & (2**64 - 1): r.label & (2**64 - 1) for r in simhash.components(edges).collect()}
    return {p: label.get(p, p) for p in prints}


def same_classes(a, b):
    return {(a[p], b[p]) for p in a} and len({(a[p], b[p]) for p in a}) == len(set(a.values())) == len(set(b.values()))


def test_links_connect_what_brute_force_connects(spark):
    for seed, crowd, segments in ((1, simhash.CROWD, None), (2, 3, simhash.FINE), (3, 3, simhash.COARSE)):
        prints = planted(random.Random(seed))
        assert same_classes(found_components(spark, prints, crowd, segments), slow_components(prints))


def test_pigeonhole():
    for segments in (simhash.FINE, simhash.COARSE):
        assert sum(radius + 1 for _, _, radius in segments) > simhash.DISTANCE
        assert sorted(b for low, bits, _ in segments for b in range(low, low + bits)) == list(range(64))


def test_rows_keep_nulls_ties_and_clashing_columns(spark, rng):
    base = " ".join(rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(200))
    rows = [(5, base), (3, base), (3, base), (9, base + " tail"), (None, base), (7, ""), (6, None), (1, "far away text " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumn("print", F.lit(1)).withColumn("key", F.lit("x")).withColumn("component", F.lit(0))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r.key, r.component) for r in got} == {(5, 3), (3, 3), (9, 3), (None, 3), (7, 6), (6, 6), (1, 1)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_query_equals_brute_force(spark):
    from rankflow.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    slow = slow_components(set(prints.values()))
    smallest = {}
    for doc, p in prints.items():
        smallest[slow[p]] = min(doc, smallest.get(slow[p], doc))
    want = {(d, f"{p:016x}", smallest[slow[p]]) for d, p in prints.items()}
    assert {tuple(r) for r in QUERIES["op2_simhash_components"](spark, folder).collect()} == want
