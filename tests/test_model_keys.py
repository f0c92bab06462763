"""Model cache keys: settings never mix, models aren't loaded again per task."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.operators import filters as flt
from latentforge.operators import inference as inf
from latentforge.operators.positions import with_position


def test_alternating_settings_give_no_wrong_row(spark):
    df = spark.range(0, 40, numPartitions=20).select("id", F.array(*[F.lit(float(j)) for j in range(64)]).alias("x"))
    for _ in range(2):
        for shape in ((1, 8, 8), (4, 4, 4), (1, 16, 4)):
            want, _lv = inf.PoolImageEncoder(*shape)(np.arange(64.0)[None, :])
            for r in inf.embed_images(df, "id", "x", shape).collect():
                assert r.status == "success" and np.allclose(r.mean, want[0])
    words = df.select("id", F.lit("some words here").alias("t"))
    for dim in (8, 16, 8):
        assert {len(r.e) for r in inf.embed_text(words, "t", "e", dim=dim).collect()} == {dim}
        tokens = words.select("id", F.split("t", " ").alias("tokens"))
        assert {len(r.hidden[0]) for r in inf.prompt_embedding(tokens, "id", "tokens", dim=dim).collect()} == {dim}


@pytest.mark.parametrize("operator", ["images", "tokens", "text"])
def test_loads_are_bounded_by_workers(spark, operator, tmp_path):
    log = str(tmp_path / "loads")
    os.makedirs(log)

    def note():
        import uuid
        open(f"{log}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

    df = spark.range(0, 64, numPartitions=32).select("id", F.array(*[F.lit(1.0)] * 64).alias("x"),
                                                     F.lit("a b").alias("t"), F.array(F.lit("a")).alias("tokens"))
    if operator == "images":
        def make():
            note()
            return inf.PoolImageEncoder(1, 8, 8)
        out = inf.embed_images(df, "id", "x", (1, 8, 8), make_encoder=make)
    elif operator == "tokens":
        def make():
            note()
            return inf.HashTokenEncoder(4)
        out = inf.prompt_embedding(df, "id", "tokens", make_encoder=make)
    else:
        def make():
            note()
            return inf.HashTextEncoder(4)
        out = inf.embed_text(df, "t", "e", make_encoder=make)
    out.collect()
    files = os.listdir(log)
    assert 1 <= len(files) == len({f.split("-")[0] for f in files})


def test_workers_hold_few_models():
    for k in range(3 * inf.MAX_MODELS):
        inf.lazy_model(f"held-{k}", lambda: k)
    assert len(inf._MODELS) <= inf.MAX_MODELS


def test_text_encoder_gets_the_truncated_tokens(spark):
    common = " ".join(f"w{i}" for i in range(75))
    df = spark.createDataFrame([(1, common + " one"), (2, common + " two more")], "id long, t string")
    a, b = (r.e for r in inf.embed_text(df, "t", "e").orderBy("id").collect())
    assert a == b
    a, b = (r.e for r in inf.embed_text(df, "t", "e", max_len=None).orderBy("id").collect())
    assert a != b


@pytest.mark.parametrize("n", [100, 10_001, 20_000, 50_000])
def test_prefix_by_any_order(spark, n):
    df = spark.range(0, 30_000, numPartitions=5).select("id", F.md5(F.col("id").cast("string")).alias("s"))
    rows = [(r.id, r.s) for r in df.collect()]
    for order, key in ((["s"], lambda r: r[1]), ([F.col("id").desc()], lambda r: -r[0])):
        want = {r[0] for r in sorted(rows, key=key)[:n]}
        assert {r.id for r in flt.take_prefix(df, n, order).collect()} == want


@pytest.mark.parametrize("order", [[F.col], ["asc"], ["desc"], ["desc_nulls_first"], ["asc_nulls_last"]])
@pytest.mark.parametrize("key", ["s", "v", "b"])
def test_positions_follow_sparks_order(spark, order, key):
    df = spark.range(0, 400, numPartitions=7).select(
        "id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("é" * 2), (F.col("id") % 97).cast("string"))).alias("s"),
        F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).when(F.col("id") % 11 != 0, F.col("id") % 89).alias("v"),
        F.when(F.col("id") % 11 != 0, F.md5(F.col("id").cast("string")).cast("binary")).alias("b"))
    first = F.col(key) if callable(order[0]) else getattr(F.col(key), order[0])()
    want = [r.id for r in df.orderBy(first, "id").collect()]
    got = {r.pos: r.id for r in with_position(df, [first, "id"], num_buckets=9).collect()}
    assert [got[i] for i in range(400)] == want
