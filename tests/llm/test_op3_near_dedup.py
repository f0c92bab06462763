import random

import pytest

from latentforge.llm import near_dedup as nd
from latentforge.llm.components import components
from latentforge.llm.queries import QUERIES


def brute(rows, link=85):
    """Components by comparing every pair of shingle sets."""
    sets = {}
    for d, t in rows:
        w = bytes((t or ""), "utf-8").lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= link * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(sets[d]), find(d), d == find(d)) for d in ids}


def check(spark, rows, link=85):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS component_id", "1 AS sketch")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.classes(df, link).collect()}
    assert got == brute(rows, link)


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in QUERIES["op3_odd_sketches"](spark, sf).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_large_group_with_independent_edits(spark, seed):
    """Many copies of one text with few and many edits: links form chains, and
    some copies are near no other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(160)]
    rows = []
    for d in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5, 9])):
            w[rng.randrange(len(w))] = rng.choice(["the", "of", f"e{rng.randrange(10_000)}"])
        rows.append((d * 7, " ".join(w)))
    check(spark, rows)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two\n"), (6, "one two three"),
            (7, "É a b c d e f"), (8, "é a b c d e f"), (9, "a " * 60_000), (10, "a a a a a a"),
            (11, "x y z"), (12, "x y z")]
    check(spark, rows)


def test_repeated_and_missing_ids(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve"
    df = spark.createDataFrame([(5, a), (5, a), (5, b), (9, b), (None, a), (None, None), (12, a)],
                               "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in nd.classes(df).collect()), key=str)
    assert got == sorted([(5, 5, True)] * 3 + [(9, 5, False), (12, 5, False)] + [(None, None, True)] * 2, key=str)
    assert sorted(str(r["doc_id"]) for r in nd.dedup(df).collect()) == ["5", "5", "5", "None", "None"]


def test_many_texts_under_one_id(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(12)) for c in "abcd"}
    rows = [(5, "a"), (5, "b"), (5, "c"), (1, "a"), (2, "b"), (3, "c"), (4, "d")]
    df = spark.createDataFrame([(d, texts[c]) for d, c in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in nd.classes(df).collect()}
    assert got == {(5, 1), (1, 1), (2, 1), (3, 1), (4, 4)}


def test_empty_table(spark):
    assert nd.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(300, 299), (299, 298)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {x: 7 for x in range(200, 260)} | {299: 298, 300: 298}
    assert got == want


def test_sketch_distance_estimates_similarity(spark):
    rng = random.Random(3)
    ours = [rng.getrandbits(64) for _ in range(1000)]
    import numpy as np
    sets = [np.unique(np.array(ours[:1000 - k] + [rng.getrandbits(64) for _ in range(k)], np.uint64)) for k in (0, 20, 60, 500)]
    _, sk = nd.signatures(sets)
    dist = [sum(bin(int(x) & (1 << 64) - 1).count("1") for x in sk[0] ^ sk[i]) for i in range(4)]
    assert dist[0] == 0 < dist[1] < dist[2] < nd.sketch_limit() < dist[3]
