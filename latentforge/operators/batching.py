"""Chunks, shards and batches.

Each operator assigns rows to chunks/ranks/batches with arithmetic on a
distributed position ``pos`` and the row count ``n`` (from
:func:`positions.with_position`).  No operator moves data by itself; to
place chunk i on worker i physically, ``repartition(W, col)`` afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .positions import with_position
from .sampling import epoch_shuffle


def _pos(df: DataFrame, order, pos: str = "pos", n: str = "n") -> DataFrame:
    if pos in df.columns and n in df.columns:
        return df
    return with_position(df, order, pos_col=pos, size_col=n)


def _div(a: Column, b: Column) -> Column:
    # integer division guarded against a zero divisor (ANSI mode raises)
    return F.when(b > 0, F.floor(a / b)).cast("long")


def chunks_floor(df: DataFrame, workers: int, order=("id",)) -> DataFrame:
    """B1: size = n div w, or n when that is 0; may give more than w chunks."""
    p = _pos(df, list(order))
    size = F.when(F.col("n") / workers >= 1, F.floor(F.col("n") / workers)).otherwise(F.col("n"))
    return p.withColumn("chunk", _div(F.col("pos"), size))


def chunks_floor_min1(df: DataFrame, workers: int, order=("id",)) -> DataFrame:
    """B2: size = max(1, n div w)."""
    p = _pos(df, list(order))
    size = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / workers).cast("long"))
    return p.withColumn("chunk", _div(F.col("pos"), size))


def chunks_ceil(df: DataFrame, workers: int, order=("id",)) -> DataFrame:
    """size = ceil(n / w); the number of chunks may be below w; worker =
    chunk mod the actual number of chunks."""
    p = _pos(df, list(order))
    size = F.ceil(F.col("n") / workers).cast("long")
    chunk = _div(F.col("pos"), size)
    n_chunks = F.ceil(F.col("n") / size).cast("long")
    return p.withColumn("chunk", chunk).withColumn("worker", F.col("chunk") % n_chunks)


def batches(df: DataFrame, size: int, order=("id",)) -> DataFrame:
    """Consecutive batches of ``size`` rows; the last may be short."""
    p = _pos(df, list(order))
    return p.withColumn("batch", F.floor(F.col("pos") / size).cast("long"))


def round_robin(df: DataFrame, batch_size: int, workers: int, order=("id",)) -> DataFrame:
    """Mini-batch j goes to worker j mod W."""
    b = batches(df, batch_size, order)
    return b.withColumn("worker", (F.col("batch") % workers).cast("int"))


def rank_shards(df: DataFrame, world: int, order=("id",)) -> DataFrame:
    """N div W rows per rank, the remainder to the last rank."""
    p = _pos(df, list(order))
    per = F.floor(F.col("n") / world).cast("long")
    rank = F.when(per == 0, F.lit(world - 1)).otherwise(
        F.least(F.floor(F.col("pos") / per).cast("long"), F.lit(world - 1)))
    return p.withColumn("rank", rank.cast("int"))


def epoch_sampler(df: DataFrame, key: str, world: int, epoch: int, seed: int = 0,
                  drop_last: bool = True) -> DataFrame:
    """Per epoch a fresh permutation; with ``drop_last`` the tail of
    n mod W rows is dropped; rank r takes permuted positions r, r+W, ….

    ``local`` is the index of the row in its rank's sample list and
    ``rank_n`` the size of that list (the same for every rank).  Without
    ``drop_last`` the permutation is padded from its start (as the sampler
    does), which repeats rows.
    """
    p = epoch_shuffle(df, key, epoch, seed, pos_col="perm", size_col="n")
    if drop_last:
        total = F.floor(F.col("n") / world) * world
        return p.where(F.col("perm") < total).select(
            "*", (F.col("perm") % world).cast("int").alias("rank"),
            F.floor(F.col("perm") / world).cast("long").alias("local"),
            F.floor(F.col("n") / world).cast("long").alias("rank_n"))
    # the first (padded - n) rows of the permutation appear a second time at
    # perm + n: one explode, no second pass over the input
    padded = F.ceil(F.col("n") / world) * world
    slots = F.when(F.col("perm") < padded - F.col("n"), F.array(F.col("perm"), F.col("perm") + F.col("n"))) \
        .otherwise(F.array(F.col("perm")))
    allp = p.withColumn("perm", F.explode(slots))
    return allp.select("*", (F.col("perm") % world).cast("int").alias("rank"),
                       F.floor(F.col("perm") / world).cast("long").alias("local"),
                       F.ceil(F.col("n") / world).cast("long").alias("rank_n"))


def loader_batches(df: DataFrame, size: int, drop_last: bool = True, local: str = "local",
                   rank: str = "rank") -> DataFrame:
    """Per rank, batches of ``size`` consecutive samples; with
    ``drop_last`` an incomplete last batch is dropped.

    Expects ``local`` (index in the rank) and ``rank`` columns, e.g. from
    :func:`epoch_sampler`.  The rank sizes come from its ``rank_n`` column
    when present (no extra pass), else from a small per-rank aggregate.
    """
    if "rank_n" in df.columns:
        b = df.withColumn("_rank_n", F.col("rank_n"))
    else:
        counts = df.groupBy(rank).agg(F.count(F.lit(1)).alias("_rank_n"))
        b = df.join(counts, rank)
    b = b.withColumn("batch", F.floor(F.col(local) / size).cast("long"))
    if drop_last:
        b = b.where(F.col(local) < F.floor(F.col("_rank_n") / size) * size)
    return b.drop("_rank_n")
