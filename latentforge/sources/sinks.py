"""Sinks (S4–S7) and the embeddings column resolver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_embeddings(df: DataFrame, column: str = "image_embeddings") -> DataFrame:
    """The named embedding column if present, else the first array
    column (the original took the first value of the dict)."""
    if column in df.columns:
        return df.withColumn(column, F.col(column))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            return df.withColumnRenamed(f.name, column)
    raise ValueError("no embedding column")


def write_records(df: DataFrame, path: str) -> None:
    """Overwrite one result dataset (written once)."""
    df.write.mode("overwrite").parquet(path)


BUNDLE_COLUMNS = ("image_embedding", "text_embedding", "attention_mask", "caption")


def write_bundle(df: DataFrame, path: str, image_type: T.DataType = T.ArrayType(T.FloatType())) -> None:
    """One row per sample with the four bundle columns; the image
    embedding may be absent (NULL) as in the variant that had none."""
    if "image_embedding" not in df.columns:
        df = df.withColumn("image_embedding", F.lit(None).cast(image_type))
    df.select(*BUNDLE_COLUMNS).write.mode("overwrite").parquet(path)


def stats_document(stats: DataFrame) -> DataFrame:
    """The long statistics table (dimension, category, n) as one row with a
    map of maps — the shape of the original JSON.  Groups are bounded by the
    number of categories."""
    per_dim = stats.groupBy("dimension").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("counts"))
    return per_dim.agg(F.map_from_entries(F.collect_list(F.struct("dimension", "counts"))).alias("stats"))


def write_stats(stats: DataFrame, prefix: str, stamp: str) -> str:
    """Write ``{prefix}_{stamp}_stats.json``; the time stamp is passed in
    (``%Y%m%d_%H%M%S``) so reruns are repeatable."""
    path = f"{prefix}_{stamp}_stats.json"
    stats_document(stats).select(F.to_json("stats").alias("value")).write.mode("overwrite").text(path)
    return path


def read_stats(spark, path: str) -> DataFrame:
    """Read a statistics document back into (dimension, category, n)."""
    doc = spark.read.text(path).select(
        F.from_json("value", "map<string, map<string, bigint>>").alias("m"))
    d = doc.select(F.explode("m").alias("dimension", "counts"))
    return d.select("dimension", F.explode("counts").alias("category", "n"))
