import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.llm import hard_negatives as hn
from latentforge.llm.oracle import ORACLES
from latentforge.llm.queries import QUERIES

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows):
    """The contract, row by row, with Python integers."""
    fit, seen = [], set()
    for i, label, e in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in e))
        if row not in seen:
            seen.add(row)
            fit.append(row)
    out = []
    for a in fit:
        if a[0] % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], c[2])), c[0], c[1]) for c in fit
                        if c is not a and len(c[2]) == len(a[2]))
        for s, i, _ in [x for x in scored if x[2] == a[1]][:5]:
            window = [x for x in scored if x[2] != a[1] and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out += [(a[0], i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(window)]
    return sorted(out)


def got(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"],
                   r["negative_score"]) for r in df.collect())


def test_query_equals_brute_force_and_sql(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table.collect()]
    mined = got(QUERIES["op11_hard_negatives"](spark, sf))
    assert mined == brute(rows) and len(mined) > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    cols = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    assert mined == sorted(con.sql(f"SELECT {cols} FROM ({ORACLES['op11_hard_negatives']})").fetchall())


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (17, 64, 33), (40, 9, 100), (64, 64, 64), (3, 0, 4)])
def test_strassen_equals_the_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a = rng.integers(-(1 << 20), 1 << 20, (m, k))
    b = rng.integers(-(1 << 20), 1 << 20, (k, n))
    for leaf in (1, 2, 8):
        assert (hn.strassen(a, b, leaf) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = random.Random(1)
    rows = [(rng.randrange(4), rng.randrange(6), i) for i in range(200)]
    want = sorted(x for r in range(4) for x in sorted((y for y in rows if y[0] == r), key=lambda y: (-y[1], y[2]))[:3])
    for size in (1, 7, 200):
        rng.shuffle(rows)
        h = hn.Heaps(3)
        for at in range(0, 200, size):
            h.merge(*(np.array(x) for x in zip(*rows[at:at + size])))
        assert sorted(zip(h.row, h.score, h.id)) == want


def test_odd_rows_ties_repeats_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 2)          # many cells
    monkeypatch.setattr(hn, "CANDIDATES", 3)
    rng = random.Random(2)
    rows = [(i, rng.randrange(3), [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(0, 400, 5)]
    rows += rows[:9]                                               # equal rows
    rows += [(50, 1, [1.0, 1.0, 0.5]), (50, 2, [1.0, 0.5, 0.5]), (-50, 1, [1.0, 1.0, 1.0])]  # one id, several rows
    rows += [(100, 1, [-1.0, -1.0, -1.0]), (150, 1, [0.25] * 4), (155, 1, [0.5] * 4), (160, 2, [0.25] * 4)]
    rows += [(None, 1, [1.0] * 3), (200, None, [1.0] * 3), (250, 1, None), (300, 1, [1.0, None, 1.0]),
             (350, 1, [float("nan"), 1.0, 1.0]), (351, 1, [float("inf"), 1.0, 1.0]), (1000, 1, []), (1001, 1, [])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "'x' AS rank", "3 AS uid")
    mined = got(hn.mine(df, F.col("id") % 50 == 0))
    assert mined == brute(rows) and len(mined) > 50


def test_a_hot_label_is_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(hn, "CANDIDATES", 50)
    rng = np.random.default_rng(5)
    rows = [(i, 3 if i % 3 else i % 9, [float(x) for x in rng.normal(size=8)]) for i in range(600)]
    assert got(hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0)) == brute(rows)


def test_empty_table(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).count() == 0


def test_scores_beyond_64_bits_are_an_error():
    big = np.full((1, 2), 1 << 40)
    with pytest.raises(OverflowError):
        list(hn._scores(big, big))
