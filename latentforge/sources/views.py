"""Stand-in views over the driver tables (FIXTURES.md §2).

The original jobs read COCO annotations, images, embedding pickles and run
logs.  These views give the same shapes from the given tables, so every
query's work grows with the tables.  Each returns a lazy DataFrame; column
pruning reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import with_position
from .tables import read_table


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Curated captions: (id, caption)."""
    return read_table(spark, sf, "documents", ["doc_id", "text"]) \
        .select(F.col("doc_id").alias("id"), F.col("text").alias("caption"))


def captions(spark: SparkSession, sf: str) -> DataFrame:
    """``annotations[]``: (image_id, ann_id, caption)."""
    return read_table(spark, sf, "conversations", ["conv_id", "turn", "text"]) \
        .select(F.col("conv_id").alias("image_id"), F.col("turn").alias("ann_id"),
                F.col("text").alias("caption"))


def images(spark: SparkSession, sf: str) -> DataFrame:
    """``images[]``: (id, file_name)."""
    return read_table(spark, sf, "documents", ["doc_id", "source"]) \
        .select(F.col("doc_id").alias("id"), F.col("source").alias("file_name"))


def latents(spark: SparkSession, sf: str) -> DataFrame:
    """Latents of 64 floats: shape (4,4,4), or an 8×8 grey image."""
    return read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]) \
        .select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"), "label")


def sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Image sizes (w, h) with their multiplicity n."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    return li.groupBy((F.col("l_partkey") % 1999 + 1).alias("w"),
                      (F.col("l_orderkey") % 1499 + 1).alias("h")) \
        .agg(F.count(F.lit(1)).alias("n"))


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Job results: (pos, status, value)."""
    ev = read_table(spark, sf, "events", ["event_id", "event_type", "value"])
    return ev.select(F.col("event_id").alias("pos"),
                     F.when(F.col("event_type") == "error", F.lit("error"))
                     .otherwise(F.lit("success")).alias("status"),
                     "value")


def losses(spark: SparkSession, sf: str, num_buckets: int | None = None) -> DataFrame:
    """Loss log: (epoch, batch_idx, loss); batch_idx is the position of the
    event within its day, ordered by (ts, event_id)."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "value"]) \
        .withColumn("epoch", F.dayofmonth("ts"))
    ev = with_position(ev, ["ts", "event_id"], partition_by=["epoch"],
                       num_buckets=num_buckets, pos_col="batch_idx")
    return ev.select("epoch", F.col("batch_idx").cast("long").alias("batch_idx"),
                     F.col("value").alias("loss"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run timings derived from the event table: method = event type,
    workers = 2^(user_id mod 4) ∈ {1,2,4,8}, seconds = summed values."""
    ev = read_table(spark, sf, "events", ["event_type", "user_id", "value"]) \
        .where(F.col("event_type").isNotNull() & F.col("user_id").isNotNull())
    return ev.groupBy(F.col("event_type").alias("method"),
                      F.pow(F.lit(2), F.col("user_id") % 4).cast("int").alias("workers")) \
        .agg(F.sum("value").alias("seconds"))
