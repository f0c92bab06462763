"""Output frames, batches and state whose size doesn't follow that of the input."""

import os
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latentforge.operators import diffusion as dd
from latentforge.operators import inference as inf
from latentforge.plans.registry import double_or_fail
from latentforge.streaming import encode_stream as es

SCHEMA = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.DoubleType())])


class Stage:
    """In place of the input of a Python stage: hands out its function."""

    @staticmethod
    def select(*columns):
        return Stage

    @staticmethod
    def mapInPandas(run, schema):
        return Stage(run)

    mapInArrow = mapInPandas

    def __init__(self, run):
        self.run = run

    def withColumnRenamed(self, old, new):
        return self


@pytest.fixture
def staged(monkeypatch):
    for module in (inf, dd):
        monkeypatch.setattr(module, "spread", lambda df: Stage)


def test_safe_map_gives_a_frame_for_many_batches(spark, staged):
    df = spark.createDataFrame([], SCHEMA)
    n = 10_000
    pdf = pd.DataFrame({"pos": range(n), "_v": [float(i % 50) for i in range(n)]})
    stage = inf.safe_map(df, double_or_fail, ["pos"], "value", T.DoubleType(), batch_size=8)
    frames = list(stage.run([pdf]))
    assert len(frames) == -(-n // inf.FRAME_ROWS)
    got = pd.concat(frames)
    assert got["pos"].tolist() == list(range(n))
    assert (got["status"] == "error").sum() == sum(i % 50 > 40 for i in range(n)) == got["result"].isna().sum()
    good = got[got["status"] == "success"]
    assert (good["result"] == 2 * pdf["_v"][good.index]).all()


def test_safe_map_frames_of_large_results_stay_small(spark, staged):
    df = spark.createDataFrame([], SCHEMA)
    pdf = pd.DataFrame({"pos": range(4000), "_v": [1.0] * 4000})
    stage = inf.safe_map(df, lambda vs: [(np.ones(900), [0.5] * 124) for _ in vs], ["pos"], "value",
                         T.StringType(), batch_size=8)
    frames = list(stage.run([pdf]))
    assert max(map(len, frames)) == inf.FRAME_VALUES // 1024 and sum(map(len, frames)) == 4000


def test_whole_numbers_beside_an_error_stay_whole(spark):
    big = 2 ** 60 + 1

    def fn(values):
        if 3 in values:
            raise ValueError("three")
        return [big + v for v in values]
    df = spark.createDataFrame([(i,) for i in range(20)], "k long").coalesce(1)
    got = {r.k: r.result for r in inf.safe_map(df, fn, ["k"], "k", T.LongType(), batch_size=2).collect()}
    assert got == {k: None if k == 3 else big + k for k in range(20)}


def test_encoder_gets_bounded_batches(spark, staged):
    seen = []

    def make():
        def encode(tokens):
            seen.append(len(tokens))
            return inf.HashTokenEncoder(4)(tokens)
        return encode
    df = spark.createDataFrame([], "id long, tokens array<string>")
    pdf = pd.DataFrame({"key": range(1000), "tokens": [[f"w{i}", "x"] for i in range(1000)]})
    frames = list(inf.prompt_embedding(df, "id", "tokens", make_encoder=make).run([pdf]))
    assert max(seen) <= inf.ENCODE_ROWS and max(map(len, frames)) <= inf.ENCODE_ROWS
    got = pd.concat(frames)
    assert got["key"].tolist() == list(range(1000))
    want = inf.HashTokenEncoder(4)(pdf["tokens"])
    assert all(np.array_equal(g, w) for g, w in zip(got["hidden"], want))


def sampled(run, *frames):
    """Rows that a stage gives for frames, sent as Arrow batches."""
    return pd.concat(b.to_pandas() for b in run(
        [pa.RecordBatch.from_pandas(f, preserve_index=False) for f in frames]))


def test_denoise_loop_takes_bounded_batches(spark, staged):
    sizes = []

    def predictor(x, t, context=None):
        sizes.append(x.size + sum(m.size for m in context or []))
        shift = 0.0 if context is None else np.array([[m.mean()] for m in context])
        return 0.1 * x, 0.2 * x + shift
    rng = np.random.default_rng(1)
    n, dim = 3000, 64
    x, hidden = list(rng.normal(size=(n, dim))), [list(rng.normal(size=(1 + k % 9, 32))) for k in range(n)]
    df = spark.createDataFrame([], "id long, hidden array<array<double>>")
    pdf = pd.DataFrame({"key": range(n), "x": x, "context": hidden})
    for context in (None, "hidden"):
        run = dd.denoise_numpy(df, "id", 5, dim, predictor, steps=3, context=context).run
        rows = pdf if context else pdf[["key", "x"]]
        sizes.clear()
        got = sampled(run, pd.concat([rows] * 3, ignore_index=True))
        assert max(sizes) <= dd.LOOP_VALUES
        assert got["key"].tolist() == 3 * list(range(n))
        alone = sampled(run, *(rows.iloc[k:k + 1] for k in (0, 7, n - 1)))
        assert np.allclose(np.stack(got["sample"].iloc[[0, 7, n - 1]]), np.stack(alone["sample"]))
        assert not list(run([pa.RecordBatch.from_pandas(rows.iloc[:0], preserve_index=False)]))


def test_a_row_larger_than_the_bound_passes(spark, staged):
    dim = dd.LOOP_VALUES + 1
    df = spark.createDataFrame([], "id long, hidden array<array<double>>")
    pdf = pd.DataFrame({"key": [1, 2], "x": [np.ones(dim)] * 2, "context": [[np.ones(2)]] * 2})
    for context in (None, "hidden"):
        run = dd.denoise_numpy(df, "id", 5, dim, lambda x, t, *c: (x, x), steps=1, context=context).run
        assert [f.num_rows for f in run([pa.RecordBatch.from_pandas(pdf, preserve_index=False)])] == [1, 1]


def folder():
    return tempfile.mkdtemp(prefix="lf-test-", dir="/tmp")


def test_one_file_of_a_stream_keeps_all_cores_busy(spark):
    def where(values):
        from pyspark import TaskContext
        return [float(TaskContext.get().partitionId())] * len(values)
    src, sink = folder(), folder()
    spark.createDataFrame([(i, float(i)) for i in range(400)], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    es.encode_stream(spark, src, SCHEMA, where, ["pos"], "value", T.DoubleType(), sink, folder())
    out = spark.read.parquet(sink)
    assert out.count() == 400
    assert out.select("result").distinct().count() == spark.sparkContext.defaultParallelism


def test_state_has_no_more_partitions_than_cores(spark):
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    assert cores < int(before)
    src, provider = folder(), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.createDataFrame([(i, float(i % 50)) for i in range(100)], SCHEMA).write.mode("append").parquet(src)
    first, second = folder(), folder()
    es.stream_progress(spark, src, SCHEMA, double_or_fail, ["pos"], "value", T.DoubleType(), folder(), first)
    es.resume_progress(spark, src, SCHEMA, double_or_fail, ["pos"], "value", folder(), second)
    for at in (first, second):
        assert 1 <= len([x for x in os.listdir(f"{at}/state/0") if x.isdigit()]) <= cores
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_progress_gets_a_row_for_each_task_and_status(spark):
    df = spark.createDataFrame([("success", float(i)) if i % 4 else ("error", None) for i in range(1000)],
                               "status string, result double").coalesce(2)
    parts = df.mapInPandas(es._partial_progress, "status string, n long, total double").collect()
    assert len(parts) <= 4
    sums = {s: (sum(r.n for r in parts if r.status == s), sum(r.total for r in parts if r.status == s))
            for s in ("success", "error")}
    assert sums == {"success": (750, float(sum(i for i in range(1000) if i % 4))), "error": (250, 0.0)}
    empty = df.where(F.lit(False)).mapInPandas(es._partial_progress, "status string, n long, total double")
    assert empty.count() == 0


def test_denoise_keeps_keys_of_any_type(spark):
    import datetime
    keys = [datetime.datetime(2024, 7, 1, 12, 30, k) for k in range(3)] + [None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(k,) for k in keys], "k timestamp")
        out = dd.denoise_numpy(df, "k", 1, 4, lambda x, t: (x, x), steps=2)
        assert out.schema["k"].dataType == df.schema["k"].dataType
        want, got = df.select(F.col("k").cast("string")), out.select(F.col("k").cast("string"))
        assert sorted(want.collect(), key=str) == sorted(got.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
