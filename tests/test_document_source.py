"""One JSON document read in byte ranges (S1) and image files with a commit."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from latentforge.plans import generation
from latentforge.sources import annotations as an
from latentforge.sources import images as io
from latentforge.sources.json_document import read_elements


def scratch():
    return tempfile.mkdtemp(prefix="lf-doc-")


def document(rng, n, layout):
    odd = ['"', "\\", '\\"', "{", "}", "[", "]", '{"id": 1}', "é\U0001f600", "\n", "],\"images\": [", "\\\\", ""]
    anns = [{"image_id": rng.randrange(50), "id": k, "caption": " ".join(rng.choice(odd) for _ in range(rng.randrange(4))),
             "extra": {"x": [{"y": "}"}], "z": None}} for k in range(n)]
    imgs = [{"id": k, "file_name": f"{k}{rng.choice(odd)}.jpg", "size": [1, 2]} for k in range(n // 3)]
    doc = {"info": {"note": "a [ {", "by": [{"q": 1}]}, "annotations": anns, "licenses": [{"id": 1}], "images": imgs}
    return json.dumps(doc, **layout), anns, imgs


@pytest.mark.parametrize("seed,layout,step", [(1, {}, 7), (2, {"indent": 2}, 64), (3, {"separators": (",", ":")}, 101),
                                              (4, {"ensure_ascii": False}, 1 << 20)])
def test_ranges_of_any_size_give_all_elements(spark, seed, layout, step):
    text, anns, imgs = document(random.Random(seed), 12 if step < 10 else 60, layout)
    path = os.path.join(scratch(), "captions.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    a, i = an.read_annotations(spark, path, multi_line=True, range_bytes=step)
    assert sorted(map(tuple, a.collect())) == sorted((x["image_id"], x["id"], x["caption"]) for x in anns)
    assert sorted(map(tuple, i.collect())) == sorted((x["id"], x["file_name"]) for x in imgs)
    assert read_elements(spark, path, step).rdd.getNumPartitions() == -(-len(text.encode()) // step)


def test_document_equals_the_lines_form(spark, sf):
    from latentforge.sources import views as vw
    doc, lines = scratch(), scratch()
    an.write_annotation_document(vw.captions(spark, sf), vw.images(spark, sf), doc)
    an.write_annotations(vw.captions(spark, sf), vw.images(spark, sf), lines)
    for one, other in zip(an.read_annotations(spark, doc, multi_line=True, range_bytes=10_000),
                          an.read_annotations(spark, lines)):
        assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)


def test_empty_arrays_several_documents_and_errors(spark):
    folder = scratch()
    for k, text in enumerate(['{"annotations": [], "images": []}', '{"images": [{"id": 7, "file_name": "x"}]}', "{}"]):
        with open(os.path.join(folder, f"{k}.json"), "w") as f:
            f.write(text)
    a, i = an.read_annotations(spark, folder, multi_line=True, range_bytes=5)
    assert a.count() == 0 and [tuple(r) for r in i.collect()] == [(7, "x")]
    none = scratch()
    an.write_annotation_document(spark.createDataFrame([], "image_id long, ann_id long, caption string"),
                                 spark.createDataFrame([], "id long, file_name string"), none)
    assert [x.count() for x in an.read_annotations(spark, none, multi_line=True)] == [0, 0]
    for text in ('{"annotations": [{"id": 1]}', '{"annotations": [{"id": 1}', '{"annotations": [{"id": x}]}'):
        path = os.path.join(scratch(), "bad.json")
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            an.read_annotations(spark, path, multi_line=True)[0].collect()
    with pytest.raises(Exception):
        an.read_annotations(spark, "/tmp/no-such-annotations.json", multi_line=True)


def image_rows(spark, n, bad=None):
    return spark.range(n).repartition(4).select(
        "id", F.array(*[(F.col("id") % 200 + k).cast("int") for k in range(6)]).alias("px"),
        F.lit(1).alias("h"), F.when(F.col("id") == bad, 5).otherwise(2).alias("w"), F.lit(3).alias("c"))


def test_image_files_appear_whole_or_not_at_all(spark):
    out = os.path.join(scratch(), "images")
    with pytest.raises(Exception):
        io.write_image_files(image_rows(spark, 40, bad=17), "id", "px", "h", "w", "c", out)
    assert os.listdir(os.path.dirname(out)) == []                  # aborted: nothing is left
    io.write_image_files(image_rows(spark, 40), "id", "px", "h", "w", "c", out)
    assert sorted(os.listdir(out)) == sorted(f"{k}.raw" for k in range(40))
    assert os.listdir(os.path.dirname(out)) == ["images"]
    back = {r["path"].split("/")[-1]: r for r in io.read_images(spark, out, glob="*.raw").collect()}
    assert all(r["status"] == "success" for r in back.values())
    assert back["17.raw"]["pixels"] == bytes(17 + k for k in range(6))
    with pytest.raises(FileExistsError):
        io.write_image_files(image_rows(spark, 2), "id", "px", "h", "w", "c", out)
    with pytest.raises(Exception):                                 # a failed overwrite leaves the old files
        io.write_image_files(image_rows(spark, 40, bad=3), "id", "px", "h", "w", "c", out, overwrite=True)
    assert len(os.listdir(out)) == 40
    io.write_image_files(image_rows(spark, 2), "id", "px", "h", "w", "c", out, overwrite=True)
    assert sorted(os.listdir(out)) == ["0.raw", "1.raw"]


def test_odd_names_and_no_rows(spark):
    out = os.path.join(scratch(), "images")
    df = spark.createDataFrame([("a/b", b"123"), ("..", b"456")], "k string, px binary") \
        .withColumns({"h": F.lit(1), "w": F.lit(1), "c": F.lit(3)})
    io.write_image_files(df, "k", "px", "h", "w", "c", out)
    assert sorted(os.listdir(out)) == ["...raw", "a%2Fb.raw"]
    empty = os.path.join(scratch(), "images")
    io.write_image_files(df.where("false"), "k", "px", "h", "w", "c", empty)
    assert os.listdir(empty) == []


def test_generated_images_are_written(spark):
    def halves(x, t, context):
        return 0.5 * x, 0.25 * x

    out = os.path.join(scratch(), "made")
    prompts = spark.createDataFrame([(1, "a red bird"), (2, "two boats"), (3, None)], "id long, caption string")
    generation.generate_files(prompts, "id", "caption", halves, out, latent_shape=(3, 4, 5), steps=2, seed=1)
    back = {r["path"].split("/")[-1]: r for r in io.read_images(spark, out).collect()}
    want = {f"{r['id']}.raw": bytes(int(v) for v in r["pixels"]) for r in generation.generate(
        prompts, "id", "caption", halves, latent_shape=(3, 4, 5), steps=2, seed=1).collect()}
    assert {k: (r["h"], r["w"], r["c"], r["pixels"]) for k, r in back.items()} == \
        {k: (4, 5, 3, v) for k, v in want.items()}
