"""Sorts, top-k and sampling.

Random choices are key hashes (:mod:`functions.rand`), so a rerun, a retry
or a different partitioning picks the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rand import hash_hex, uniform, with_permuted
from .positions import with_position

PREFIX_DIGITS = 4         # hex digits of a hash that are counted in one step


def top_k(df: DataFrame, k: int = 10, count_col: str = "n", label_col: str = "category") -> DataFrame:
    """O1: the k largest counts, ties by label (a per-task top-k, then a
    merge of at most k rows per task)."""
    return df.orderBy(F.col(count_col).desc(), F.col(label_col).asc()).limit(k)


def image_order(df: DataFrame, order="id") -> DataFrame:
    """O2: output in input order — applied only at the sink."""
    return df.orderBy(order)


def pick_one(df: DataFrame, key: str, value: str, tiebreak: str, seed: int = 0) -> DataFrame:
    """O3: one pseudo-random value per key (smallest hash of seed|key|tiebreak).
    ``min_by`` aggregates partially on the map side, so a hot key is cheap."""
    return df.groupBy(key).agg(F.min_by(F.col(value), hash_hex(seed, F.col(key), F.col(tiebreak))).alias(value))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0, strict: bool = False) -> DataFrame:
    """N distinct pseudo-random rows (all rows when fewer than n): those
    with the n smallest hashes of their key, ties by key.

    The n-th smallest hash is found by counting: rows by the first digits of
    their hash, then the rows of the group in which the n-th lies by the next
    digits.  All rows before that last group pass a filter; only within it,
    about 2^-32 of the rows, is there a sort.  ``strict=True`` raises when the
    input has fewer than n rows, like the original's sampling without
    replacement.
    """
    digest = hash_hex(seed, F.col(key))
    head, left = "", n
    for _ in range(2):
        size = len(head) + PREFIX_DIGITS
        counts = df.where(F.startswith(digest, F.lit(head))).groupBy(F.substring(digest, 1, size).alias("p")).count()
        before = F.sum("count").over(Window.orderBy("p"))            # 16 ** PREFIX_DIGITS rows at most
        at = counts.withColumn("upto", before).where(F.col("upto") >= left).orderBy("p").first()
        if at is None:
            if strict and left > 0:
                raise ValueError(f"cannot take {n} distinct rows from a smaller input")
            return df
        head, left = at["p"], left - (at["upto"] - at["count"])
    last = with_position(df.where(F.startswith(digest, F.lit(head))), [digest, key], pos_col="_lf_pos")
    return df.where(F.substring(digest, 1, len(head)) < head).unionByName(
        last.where(F.col("_lf_pos") < left).drop("_lf_pos"))


def sample_by_hash(df: DataFrame, fraction: float, key: str, seed: int = 0) -> DataFrame:
    """Each row kept when u(seed, key) < fraction — a Bernoulli sample that
    does not depend on partitioning."""
    return df.where(uniform(seed, F.col(key)) < F.lit(float(fraction)))


def epoch_shuffle(df: DataFrame, key: str, epoch: int, seed: int = 0, pos_col: str = "pos",
                  size_col: str | None = None) -> DataFrame:
    """A fresh permutation per epoch: the place of each row.

    Rows are numbered once along ``key`` (a number they may bring along as
    ``index`` and ``n``); each epoch then permutes these numbers by arithmetic
    alone (:func:`rand.with_permuted`), so an epoch sorts and moves nothing.
    """
    index, n = "_lf_index", "_lf_size"
    if "index" in df.columns and "n" in df.columns:
        rows = df.withColumns({index: F.col("index"), n: F.col("n")})
    else:
        rows = with_position(df, [key], pos_col=index, size_col=n)
    out = with_permuted(rows, index, n, seed + epoch, pos_col)
    if size_col is not None:
        out = out.withColumn(size_col, F.col(n))
    return out.drop(index, n)
