"""Inference surface (E1–E9), sources/sinks (S1–S8) and streaming."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latentforge.operators import aggregates as agg
from latentforge.operators import inference as inf
from latentforge.sources import annotations as an
from latentforge.sources import images as io
from latentforge.sources import sinks
from latentforge.streaming import encode_stream as es


def scratch():
    return tempfile.mkdtemp(prefix="lf-test-", dir="/tmp")


def test_tokenize_pad_and_mask(spark):
    df = spark.createDataFrame([("A man, walking!",), (" ".join(["w"] * 100),)], "caption string")
    r = df.select(inf.tokenize_pad("caption", 8).alias("t")).collect()
    assert r[0].t.tokens == ["<s>", "a", "man", "walking", "</s>", "<pad>", "<pad>", "<pad>"]
    assert r[0].t.attention_mask == [1, 1, 1, 1, 1, 0, 0, 0]
    assert r[1].t.tokens[-1] == "</s>" and len(r[1].t.tokens) == 8 and sum(r[1].t.attention_mask) == 8


def test_embed_text_equals_hash_embed(spark):
    df = spark.createDataFrame([(1, "a man and a dog"), (2, "der und les"), (3, "")], "id long, caption string")
    dense = {r.id: r.e for r in inf.embed_text(df, "caption", "e", dim=16).collect()}
    sparse = inf.dense_from_sparse(inf.hash_embed(df, "id", "caption", 16), "id", 16).collect()
    for r in sparse:
        np.testing.assert_allclose(r.embedding, dense[r.id], atol=1e-12)
    assert dense[3] == [0.0] * 16


def test_safe_map_isolates_one_bad_row(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(8)], "k long, v double")

    def fn(vals):
        if any(v == 5.0 for v in vals):
            raise RuntimeError("bad row")
        return [v + 1 for v in vals]

    out = {r.k: r for r in inf.safe_map(df, fn, ["k"], "v", T.DoubleType(), batch_size=8).collect()}
    assert len(out) == 8
    assert [k for k, r in out.items() if r.status == "error"] == [5]
    assert out[4].result == 5.0 and "bad row" in out[5].error_message


def test_lazy_model_loads_once_per_worker(spark):
    df = spark.range(0, 400, numPartitions=16)

    def run(batches):
        import os as _os

        import pandas as pd

        from latentforge.operators.inference import lazy_model, load_count
        for pdf in batches:
            lazy_model("probe", lambda: object())
            yield pd.DataFrame({"pid": [_os.getpid()] * len(pdf), "loads": [load_count("probe")] * len(pdf)})

    got = df.mapInPandas(run, "pid long, loads long").groupBy("pid").agg(F.max("loads").alias("m")).collect()
    assert all(r.m == 1 for r in got)


def test_embed_images_shapes(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(16)]), (2, [1.0] * 3)], "id long, x array<double>")
    out = {r.id: r for r in inf.embed_images(df, "id", "x", (1, 4, 4)).collect()}
    assert out[1].status == "success" and out[1].mean == [2.5, 4.5, 10.5, 12.5]
    assert out[2].status == "error" and out[2].mean is None


def test_annotations_round_trip(spark):
    path = scratch()
    caps = spark.createDataFrame([(1, 10, "a man"), (1, 11, "x"), (2, 12, "y")], "image_id long, ann_id long, caption string")
    imgs = spark.createDataFrame([(1, "a.jpg"), (2, "b.jpg")], "id long, file_name string")
    an.write_annotations(caps, imgs, path)
    a, i = an.read_annotations(spark, path)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, caps.collect()))
    assert sorted(map(tuple, i.collect())) == sorted(map(tuple, imgs.collect()))


def test_classic_single_document(spark):
    path = os.path.join(scratch(), "captions.json")
    with open(path, "w") as f:
        f.write('{"annotations": [{"image_id": 1, "id": 5, "caption": "a kid"}],\n'
                ' "images": [{"id": 1, "file_name": "1.jpg"}]}')
    a, i = an.read_annotations(spark, path, multi_line=True)
    assert a.collect()[0].caption == "a kid" and i.collect()[0].file_name == "1.jpg"


def test_read_images_with_bad_file(spark):
    d = scratch()
    df = spark.createDataFrame([(1, bytes(range(12)), 2, 2, 3)], "k long, px binary, h int, w int, c int")
    io.write_image_files(df, "k", "px", "h", "w", "c", d)
    with open(os.path.join(d, "2.raw"), "wb") as f:
        f.write(b"garbage")
    r = {os.path.basename(x.path): x for x in io.read_images(spark, d).collect()}
    assert r["1.raw"].status == "success" and r["1.raw"].pixels == bytes(range(12)) and r["1.raw"].c == 3
    assert r["2.raw"].status == "error" and r["2.raw"].pixels is None


def odd_folder():
    """A folder with names of all kinds, some of which Spark's sources leave out."""
    d = os.path.join(scratch(), "a b")
    one = io.encode_raw(np.arange(6, dtype=np.uint8).reshape(1, 2, 3))
    for name in ("1.raw", "a b%20c.raw", "é\U0001f600.raw", "x,y.raw", "x.bin", ".hid.raw", "_hid.raw", "_k=1.raw", "d._COPYING_",
                 "sub/2.raw", "_sub=1/3.raw"):
        os.makedirs(os.path.dirname(os.path.join(d, name)), exist_ok=True)
        with open(os.path.join(d, name), "wb") as f:
            f.write(one)
    for name, text in (("bad.raw", b"garbage"), ("empty.raw", b"")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(text)
    return d


@pytest.mark.parametrize("glob", [None, "*.raw", "{1,x*}.[!q]?[n-w]", "nothing*"])
def test_read_images_lists_what_spark_lists(spark, glob):
    d = odd_folder()
    os.remove(os.path.join(d, "_sub=1", "3.raw"))
    reader = spark.read.format("binaryFile")
    want = (reader if glob is None else reader.option("pathGlobFilter", glob)).load(d).select("path").collect()
    got = io.read_images(spark, d, glob=glob).collect()
    assert sorted(r.path for r in got) == sorted(r.path for r in want)
    assert {os.path.basename(r.path): r.status for r in got if r.status != "success"} == (
        {"bad.raw": "error"} if glob in (None, "*.raw") else {})
    assert all(r.pixels == bytes(range(6)) and (r.h, r.w, r.c) == (1, 2, 3) for r in got if r.status == "success")


def test_read_images_of_partition_folders_files_and_patterns(spark):
    d = scratch()
    for k in range(3):
        os.makedirs(os.path.join(d, f"k={k}"))
        with open(os.path.join(d, f"k={k}", f"{k}.raw"), "wb") as f:
            f.write(io.encode_raw(np.full((1, 1, 1), k, dtype=np.uint8)))
    full = {f"file:{d}/k={k}/{k}.raw": bytes([k]) for k in range(3)}
    for path in (d, f"file://{d}/", f"{d}/k=*"):
        assert {r.path: r.pixels for r in io.read_images(spark, path).collect()} == full
    assert [r.pixels for r in io.read_images(spark, f"{d}/k=2/2.raw").collect()] == [b"\x02"]
    with pytest.raises(Exception):
        io.read_images(spark, f"{d}/missing").collect()


def test_many_images_are_not_listed_by_the_driver(spark):
    d = scratch()
    first = os.path.join(d, "0.raw")
    with open(first, "wb") as f:
        f.write(io.encode_raw(np.zeros((1, 1, 1), dtype=np.uint8)))
    for k in range(1, 3000):
        os.link(first, os.path.join(d, f"{k}.raw"))
    r = io.read_images(spark, d, glob="*.raw")
    assert r.inputFiles() == []
    assert r.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    found = r.where("status = 'success'").select("path").collect()
    assert sorted(int(os.path.basename(x.path)[:-4]) for x in found) == list(range(3000))


def test_stats_document_round_trip(spark):
    stats = spark.createDataFrame([("gender_distribution", "male", 3), ("activities", "walking", 2)],
                                  "dimension string, category string, n long")
    path = sinks.write_stats(stats, os.path.join(scratch(), "coco"), "20240101_120000")
    assert path.endswith("coco_20240101_120000_stats.json")
    back = sorted(map(tuple, sinks.read_stats(spark, path).collect()))
    assert back == sorted(map(tuple, stats.collect()))


def test_resolve_embeddings(spark):
    df = spark.createDataFrame([(1, [1.0])], "id long, e array<double>")
    assert "image_embeddings" in sinks.resolve_embeddings(df).columns


from latentforge.plans.registry import double_or_fail as _fn  # noqa: E402  (importable by workers)


def test_stream_equals_batch_and_resumes(spark):
    src, sink, ckpt = scratch(), scratch(), scratch()
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.DoubleType())])
    data = [(i, float(i % 50)) for i in range(400)]
    first, second = data[:240], data[240:]
    spark.createDataFrame(first, schema).repartition(3).write.mode("append").parquet(src)
    es.encode_stream(spark, src, schema, _fn, ["pos"], "value", T.DoubleType(), sink, ckpt)
    assert spark.read.parquet(sink).count() == 240
    # more input arrives; the restart continues from the checkpoint
    spark.createDataFrame(second, schema).repartition(2).write.mode("append").parquet(src)
    es.encode_stream(spark, src, schema, _fn, ["pos"], "value", T.DoubleType(), sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == 400 and out.select("pos").distinct().count() == 400
    batch = inf.safe_map(spark.createDataFrame(data, schema), _fn, ["pos"], "value", T.DoubleType(), 8)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_progress_final_state(spark):
    src, prog, ckpt = scratch(), scratch(), scratch()
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.DoubleType())])
    spark.createDataFrame([(i, float(i % 50)) for i in range(100)], schema).repartition(4) \
        .write.parquet(src + "/d")
    es.stream_progress(spark, src + "/d", schema, _fn, ["pos"], "value", T.DoubleType(), prog, ckpt)
    got = {r.status: r.n for r in es.latest_progress(spark, prog).collect()}
    assert got == {"success": 82, "error": 18}


def test_bundle_shapes(spark):
    df = spark.createDataFrame([([1.0, 2.0], "a"), ([1.0], None)], "e array<double>, caption string")
    r = agg.bundle_shapes(df, ["e"], "caption").collect()[0]
    assert (r.n, r.e_min_len, r.e_max_len, r.caption_count) == (2, 1, 2, 1)


def test_missing_annotation_file_raises(spark):
    import pytest
    with pytest.raises(Exception):
        an.read_annotations(spark, "/tmp/definitely-missing-annotations-dir")[0].count()


def test_attach_captions_drops_uncaptioned_and_null(spark):
    from latentforge.operators import joins as jn
    caps = spark.createDataFrame([(1, 1, "a man"), (1, 2, "a woman"), (2, 3, None), (3, 4, "a dog")],
                                 "image_id long, ann_id long, caption string")
    imgs = spark.createDataFrame([(1, "1.jpg"), (2, "2.jpg"), (3, "3.jpg"), (4, "4.jpg")], "id long, file_name string")
    got = {r.id: r for r in jn.attach_captions(imgs, caps, root="/r").collect()}
    assert list(got) == [1] and got[1].n_captions == 2 and got[1].caption in ("a man", "a woman")
    assert got[1].image_path == "/r/train2014/train2014/1.jpg"
    again = {r.id: r.caption for r in jn.attach_captions(imgs, caps, root="/r").collect()}
    assert again[1] == got[1].caption            # the pick is deterministic


def test_materialize_uses_shared_checkpoint_dir(spark):
    from latentforge.operators.parallel import materialize
    df = materialize(spark.range(10).select((F.col("id") * 2).alias("x")))
    assert df.count() == 10 and spark.sparkContext.getCheckpointDir()


def test_stream_split_by_status(spark):
    src, sink, ckpt = scratch(), scratch(), scratch()
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.DoubleType())])
    spark.createDataFrame([(i, float(i % 50)) for i in range(100)], schema).write.parquet(src + "/d")
    es.encode_stream(spark, src + "/d", schema, _fn, ["pos"], "value", T.DoubleType(), sink, ckpt,
                     split_by_status=True)
    assert {"status=error", "status=success"} <= set(os.listdir(sink))
    assert spark.read.parquet(sink + "/status=error").count() == 18


def test_hash_embedding_equals_the_encoder_and_shuffles_nothing(spark):
    import contextlib
    import io as text_io

    import numpy as np
    texts = ["a cat and a dog", "", None, "Été été ÉTÉ x", "word " * 3000 + "other", "...", "the the the a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, caption string").coalesce(1)
    for dim in (1, 2, 64):
        sparse = inf.hash_embed(df, "id", "caption", dim)
        got = np.zeros((len(texts), dim))
        for r in sparse.collect():
            assert r.value != 0
            got[r.id, r.bucket] = r.value
        assert np.allclose(got, inf.HashTextEncoder(dim)(np.array(texts, dtype=object)))
    buf = text_io.StringIO()
    with contextlib.redirect_stdout(buf):
        inf.hash_embed(spark.range(0, 100, 1, 64).select("id", F.lit("a b").alias("caption")), "id", "caption").explain()
    assert "Exchange" not in buf.getvalue()


def test_interrupted_run_is_taken_up_again(spark):
    """T4 with state: a run stopped in its middle, and one that is repeated."""
    src, out, ckpt = scratch() + "/in", scratch() + "/out", scratch()
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.DoubleType())])
    data = [(i, float(i % 50)) for i in range(300)]
    spark.createDataFrame(data, schema).repartition(6).write.parquet(src)

    def run(stop=None):
        return es.resume_progress(spark, src, schema, _fn, ["pos"], "value", out, ckpt, stop_after=stop)

    def progress():
        return {r.status: (r.n, r.total) for r in es.last_progress(spark, out).collect()}
    assert run(2) is False
    part = progress()
    assert 0 < sum(n for n, _ in part.values()) < 300
    assert run(0) is False and progress() == part          # interrupted at once: nothing is lost or doubled
    assert run(1) is False and run() is True
    batch = inf.safe_map(spark.createDataFrame(data, schema), _fn, ["pos"], "value", T.DoubleType(), 8)
    want = {r.status: (r.n, r.total) for r in batch.groupBy("status").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("result"), F.lit(0.0)).alias("total")).collect()}
    assert progress() == want
    assert run() is True and progress() == want            # nothing left to do
