"""Caption annotation documents.

The classic format is one JSON document ``{"annotations": [...], "images":
[...]}``.  It is read in byte ranges by :mod:`json_document`, so a large one is
parsed by many tasks, and once for both arrays.  JSON Lines, where every line
is a document of the same shape holding a few entries, is what
:func:`write_annotations` produces; Spark splits it by itself.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parallel import stored
from .json_document import RANGE_BYTES, read_elements

_ANNOTATION = T.StructType([
    T.StructField("image_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("caption", T.StringType())])
_IMAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("file_name", T.StringType())])

ANNOTATION_SCHEMA = T.StructType([
    T.StructField("annotations", T.ArrayType(_ANNOTATION)),
    T.StructField("images", T.ArrayType(_IMAGE)),
])


def read_annotations(spark: SparkSession, path: str, multi_line: bool = False,
                     range_bytes: int = RANGE_BYTES):
    """(annotations, images) DataFrames from annotation documents.

    annotations: (image_id, ann_id, caption); images: (id, file_name).
    ``multi_line`` reads whole documents (the classic format) in ranges of
    ``range_bytes``; the parsed elements are stored once and both DataFrames
    read them.  A missing path raises, like the original, and so does a
    malformed document.
    """
    if multi_line:
        strict = {"mode": "FAILFAST"}
        parsed = stored(
            read_elements(spark, path, range_bytes).where(F.col("section").isin("annotations", "images")).select(
                F.when(F.col("section") == "annotations", F.from_json("element", _ANNOTATION, strict)).alias("a"),
                F.when(F.col("section") == "images", F.from_json("element", _IMAGE, strict)).alias("i")),
            "annotations")
        ann, img = parsed.where("a IS NOT NULL"), parsed.where("i IS NOT NULL")
    else:
        docs = spark.read.schema(ANNOTATION_SCHEMA).option("mode", "FAILFAST").json(path)
        ann = docs.select(F.explode("annotations").alias("a"))
        img = docs.select(F.explode("images").alias("i"))
    return (ann.select(F.col("a.image_id").alias("image_id"), F.col("a.id").alias("ann_id"),
                       F.col("a.caption").alias("caption")),
            img.select(F.col("i.id").alias("id"), F.col("i.file_name").alias("file_name")))


def write_annotations(captions: DataFrame, images: DataFrame, path: str) -> None:
    """Write captions (image_id, ann_id, caption) and images (id, file_name)
    as JSON Lines annotation documents, one entry per line."""
    a = captions.select(F.array(F.struct(F.col("image_id").cast("long").alias("image_id"),
                                         F.col("ann_id").cast("long").alias("id"),
                                         F.col("caption"))).alias("annotations"))
    i = images.select(F.array(F.struct(F.col("id").cast("long").alias("id"),
                                       F.col("file_name"))).alias("images"))
    a.unionByName(i, allowMissingColumns=True).write.mode("overwrite").json(path)


def write_annotation_document(captions: DataFrame, images: DataFrame, path: str) -> None:
    """Write captions and images as one document of the classic format.  One
    document is one file, so one task writes it, element by element."""
    def elements(df: DataFrame, part: int, *fields) -> DataFrame:
        return df.select(F.lit(part).alias("part"), F.to_json(F.struct(*fields)).alias("value"))

    rows = elements(captions, 0, F.col("image_id").cast("long").alias("image_id"),
                    F.col("ann_id").cast("long").alias("id"), "caption") \
        .union(elements(images, 1, F.col("id").cast("long").alias("id"), "file_name"))

    def lines(batches):
        at, first = -1, True
        for batch in batches:
            out = []
            for part, value in zip(*(c.to_pylist() for c in batch.columns)):
                while at < part:
                    at += 1
                    out.append(("{" if at == 0 else "],") + f'"{ANNOTATION_SCHEMA.names[at]}": [')
                    first = True
                out.append(value if first else "," + value)
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        rest = [("{" if k == 0 else "],") + f'"{ANNOTATION_SCHEMA.names[k]}": [' for k in range(at + 1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array([*rest, "]}"], pa.string())], names=["value"])

    rows.repartition(1).sortWithinPartitions("part", "value").mapInArrow(lines, "value string") \
        .write.mode("overwrite").text(path)
