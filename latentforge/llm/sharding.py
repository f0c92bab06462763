"""Sharding by fixed virtual slots.

Records are hashed into a fixed, large number of virtual slots.  One
aggregation gives rows and bytes per slot; a small versioned table maps slots
to shards.  Rebalancing edits that map — it moves whole slots from heavy to
light shards — and stores it as the next version, so records are placed by a
lookup and only those of moved slots change place.

The slot table has ``N_SLOTS`` rows whatever the input size; only it is
balanced on the driver and broadcast.

Defined results: a null text has 0 bytes (size 8) and the CRC-32 of the empty
text; null ids are placed like any other by their hash together with size and
CRC-32.  Repeated rows get positions of their own.  An empty table gives an
empty result and a map with the initial assignment.  Extra columns are carried
along by :func:`place` unless they have the name of an output column.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int"


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 8 for the id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def virtual_slot(*keys: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def slot_totals(slotted: DataFrame) -> DataFrame:
    """Rows and bytes of each virtual slot (pre-aggregated in each task)."""
    return slotted.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.sum("size").alias("n_bytes"))


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> np.ndarray:
    """Version 0: slots dealt in turn."""
    return np.arange(n_slots) % n_shards


def rebalance(shard_of: np.ndarray, weight: np.ndarray, n_shards: int,
              tolerance: float = 0.0005, max_moves: int = 20_000) -> np.ndarray:
    """Edit a slot map until the shards' weights are near equal.

    Each step takes the heaviest and the lightest shard and does the one move
    or exchange of slots that brings the two closest together.  It ends within
    ``tolerance`` of the mean or when no step helps.  Slots stay where they
    are unless a step moves them.
    """
    shard_of = shard_of.copy()
    load = np.bincount(shard_of, weights=weight, minlength=n_shards)
    mean = load.sum() / n_shards
    closed: set = set()                      # pairs without a helpful step
    for _ in range(max_moves):
        pairs = [(h, l) for h in np.argsort(-load)[:3] for l in np.argsort(load)[:3]
                 if load[h] > load[l] and (h, l) not in closed]
        if not pairs or load.max() - load.min() <= tolerance * mean:
            break
        hi, lo = pairs[0]
        half = (load[hi] - load[lo]) / 2
        a, b = np.flatnonzero(shard_of == hi), np.flatnonzero(shard_of == lo)
        # weight moved by giving slot i, or exchanging slots i and j
        moved = weight[a][:, None] - np.concatenate([[0.0], weight[b]])[None, :]
        moved = np.where((moved > 0) & (moved < 2 * half), moved, np.inf)
        i, j = np.unravel_index(np.argmin(np.abs(moved - half)), moved.shape) if moved.size else (0, 0)
        if not moved.size or not np.isfinite(moved[i, j]):
            closed.add((hi, lo))
            continue
        shard_of[a[i]] = lo
        if j:
            shard_of[b[j - 1]] = hi
        load[hi] -= moved[i, j]
        load[lo] += moved[i, j]
        closed = {p for p in closed if not {hi, lo} & set(p)}
    return shard_of


def store_map(spark: SparkSession, path: str, version: int, shard_of: np.ndarray) -> None:
    """Append one version of the map; earlier versions stay readable."""
    rows = [(version, s, int(x)) for s, x in enumerate(shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One stored version (the latest by default)."""
    maps = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version)


def place(records: DataFrame, path: str, n_shards: int = 24, n_slots: int = N_SLOTS) -> DataFrame:
    """Balance the bytes of ``records`` (id, size, crc columns) over shards.

    Stores the initial map as version 0 and the rebalanced one as version 1
    under ``path``.  Adds ``virtual_slot``, ``shard`` and ``slot``, the
    gapless position of a record in its shard: an offset for each virtual slot
    and a row number inside it, so no task orders a whole shard.
    """
    spark = records.sparkSession
    slotted = records.withColumn("virtual_slot", virtual_slot(
        F.col("doc_id"), F.col("size"), F.col("text_crc32"), n_slots=n_slots))
    totals = slot_totals(slotted).collect()                     # at most n_slots rows
    n_rows, n_bytes = np.zeros(n_slots, dtype=np.int64), np.zeros(n_slots)
    for t in totals:
        n_rows[t["virtual_slot"]], n_bytes[t["virtual_slot"]] = t["n_rows"], t["n_bytes"]
    start = initial_map(n_shards, n_slots)
    shard_of = rebalance(start, n_bytes, n_shards)
    store_map(spark, path, 0, start)
    store_map(spark, path, 1, shard_of)

    offset = np.zeros(n_slots, dtype=np.int64)
    for shard in range(n_shards):
        own = np.flatnonzero(shard_of == shard)
        offset[own] = np.cumsum(n_rows[own]) - n_rows[own]
    offsets = spark.createDataFrame([(s, int(o)) for s, o in enumerate(offset)], "virtual_slot int, _offset long")
    slots = (load_map(spark, path).select(F.col("slot").alias("virtual_slot"), "shard")
             .join(offsets, "virtual_slot"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (slotted.drop("shard", "slot")
            .withColumn("_row", F.row_number().over(inside).cast("long") - 1)
            .join(F.broadcast(slots), "virtual_slot")           # n_slots rows
            .withColumn("slot", F.col("_offset") + F.col("_row"))
            .drop("_offset", "_row"))
