"""End-to-end plans L1–L4 on small inputs."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.functions import lexicon as lx
from latentforge.operators import diffusion as dd
from latentforge.operators import filters as flt
from latentforge.operators import sampling as smp
from latentforge.plans import curation, embedding, generation, training
from latentforge.sources import annotations as an
from latentforge.sources import images as io
from latentforge.sources import sinks


def scratch():
    return tempfile.mkdtemp(prefix="lf-plan-", dir="/tmp")


def test_curation_from_annotation_documents(spark):
    d = scratch()
    caps = spark.createDataFrame([(1, 1, "a man riding a horse"), (1, 2, "a red car"), (2, 3, "a kid playing"),
                                  (3, 4, "a tree")], "image_id long, ann_id long, caption string")
    imgs = spark.createDataFrame([(1, "1.jpg"), (2, "2.jpg"), (3, "3.jpg")], "id long, file_name string")
    an.write_annotations(caps, imgs, d + "/ann")
    px = spark.createDataFrame([(1, bytes(12), 2, 2, 3), (3, bytes(12), 2, 2, 3)], "k long, px binary, h int, w int, c int")
    io.write_image_files(px, "k", "px", "h", "w", "c", d + "/train2014/train2014", suffix=".jpg")
    # image 2 can't be opened: it is gone before the statistics
    opened, few = curation.curate_and_analyze(spark, d + "/ann", root=d)
    assert [r.id for r in opened.collect()] == [1]
    ds, stats = curation.curate_and_analyze(spark, d + "/ann", stats_prefix=d + "/people", stamp="20240101_000000",
                                            load=False)
    assert sorted(r.id for r in ds.collect()) == [1, 2]
    person, _ = curation.curate_and_analyze(spark, d + "/ann", load=False, person=flt.gazetteer_person(["tree"]))
    assert sorted(r.id for r in person.collect()) == [1, 2, 3]
    assert {r.dimension: r.n for r in few.collect() if r.category == "child"}.get("age_groups", 0) == 0
    back = {(r.dimension, r.category): r.n for r in sinks.read_stats(spark, d + "/people_20240101_000000_stats.json")
            .collect()}
    assert back[("gender_distribution", "male")] + back[("age_groups", "child")] >= 1
    assert back == {(r.dimension, r.category): r.n for r in stats.collect()}


def test_curation_drops_undecodable_images(spark):
    d = scratch()
    px = spark.createDataFrame([(1, bytes(12), 2, 2, 3)], "k long, px binary, h int, w int, c int")
    io.write_image_files(px, "k", "px", "h", "w", "c", d + "/train2014/train2014", suffix=".jpg")
    with open(d + "/train2014/train2014/2.jpg", "wb") as f:
        f.write(b"broken")
    caps = spark.createDataFrame([(1, 1, "a man"), (2, 2, "a woman")], "image_id long, ann_id long, caption string")
    imgs = spark.createDataFrame([(1, "1.jpg"), (2, "2.jpg")], "id long, file_name string")
    pixels = io.read_images(spark, d + "/train2014/train2014")
    ds = curation.curate(imgs, caps, root=d, pixels=pixels)
    assert [r.id for r in ds.collect()] == [1]
    loaded = curation.curate(imgs, caps, root=d, load=True).collect()   # decode after the join
    assert [(r.id, r.h, r.w, r.c) for r in loaded] == [(1, 2, 2, 3)]


def test_image_embedding_job_end_to_end(spark):
    d = scratch()
    rng = np.random.default_rng(3)
    rows = [(i, bytes(rng.integers(0, 256, 24 * 16 * 3, dtype=np.uint8)), 24, 16, 3) for i in range(6)]
    rows.append((6, bytes(3 * 3000), 1, 3000, 3))                 # letterboxes to width 0
    recs = spark.createDataFrame(rows, "key long, px binary, h int, w int, c int")
    out = embedding.embed_images_job(recs, "key", "px", "h", "w", "c", out_path=d + "/lat", target=32, factor=8)
    res = {r.key: r for r in out.collect()}
    assert len(res) == 7 and res[6].status == "error" and res[6].embedding is None
    assert len(res[0].embedding) == 3 * 4 * 4
    s = embedding.summary(out, 10.0).collect()[0]
    assert (s.successful, s.failed) == (6, 1)
    first3 = embedding.embed_images_job(recs, "key", "px", "h", "w", "c", limit=3, target=32)
    assert sorted(r.key for r in first3.collect()) == [0, 1, 2]


def test_training_input_partitioned_write(spark):
    d = scratch()
    lat = spark.range(70).select("id", F.array(*[F.lit(float(j)) for j in range(4)]).alias("x"))
    ti = training.training_input(lat, dd.noise_schedule(spark), "id", "x", world=2, epoch=0, batch_size=16)
    training.write_training_input(ti, d + "/ti")
    assert sorted(os.listdir(d + "/ti/epoch=0")) == ["rank=0", "rank=1"]
    back = spark.read.parquet(d + "/ti")
    assert back.count() == 64 and back.groupBy("rank", "batch").count().where("count != 16").count() == 0


def test_generation_many_prompts(spark):
    prompts = spark.createDataFrame([(1, "a man"), (2, "a dog")], "id long, caption string")
    def predictor(x, t, context):
        return 0.1 * x, 0.2 * x + np.array([[m[1:4].sum(0) @ np.arange(m.shape[1]) / 100] for m in context])   # the words, not the padding

    def latents(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "id long, caption string")
        return [r.sample for r in generation.generate(df, "id", "caption", predictor, steps=3, seed=5,
                                                      latent_shape=(1, 2, 2), to_pixels=False).orderBy("id").collect()]
    assert latents(["a man"]) == latents(["a man"]) != latents(["two dogs run"])      # the prompt matters
    g = generation.generate(prompts, "id", "caption", predictor, steps=3, seed=5, latent_shape=(1, 2, 2)).collect()
    assert len(g) == 2 and all(len(r.pixels) == 4 and 0 <= min(r.pixels) and max(r.pixels) <= 255 for r in g)


def test_sample_n_strict(spark):
    df = spark.range(5)
    assert smp.sample_n(df, 3, "id").count() == 3
    with pytest.raises(ValueError):
        smp.sample_n(df, 6, "id", strict=True)


def test_lexicon_is_swappable(spark):
    from latentforge.operators import aggregates as agg
    df = spark.createDataFrame([(1, "der und les")], "id long, caption string")
    d = {(r.dimension, r.category): r.n for r in agg.demographics(df, lexicon=lx.TEST).collect()}
    assert d[("activities", "der")] == 1 and d[("gender_distribution", "neutral")] == 1


def test_training_samples_join_text_by_key(spark):
    lat = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.3, 0.4]), (3, [0.5, 0.6])], "k long, embedding array<double>")
    bundle = spark.createDataFrame([(2, [1.0], "b"), (1, [2.0], "a")], "k long, text_embedding array<double>, caption string")
    got = {r.k: (r.caption, r.text_embedding) for r in training.training_samples(lat, bundle, "k").collect()}
    assert got == {1: ("a", [2.0]), 2: ("b", [1.0])}
