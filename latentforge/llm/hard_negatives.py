"""Hard negatives by exact integer scores of anchors against all rows.

1. Vectors become integers, ``floor(256 * x)`` of each component.
2. Anchors and candidates are dealt by hash over a grid of cells, each with at
   most about ``ANCHORS`` by ``CANDIDATES`` rows; a cell's scores are one
   product of two int64 tiles, taken by Strassen's recursion.  Odd sides are
   padded with zeros.  Integer sums wrap, so the recursion's large intermediate
   values do no harm as long as the scores themselves fit 64 bits.
3. The positives of an anchor are kept in bounded heaps, one for each anchor
   and cell, that merge; cells hold rows of one label there.  With the scores
   of the positives known, a second pass keeps, again in heaps that merge, the
   best rows of other labels within each positive's window of scores.

A label that a third of the rows have is dealt over as many cells as its rows
need.  A cell returns at most ``k`` rows for each of its anchors (and window),
and the final merge drops most of these before its shuffle.

Defined results: rows without an id, a label or a vector, and vectors with a
component that is null or not finite, take no part.  Equal rows count once;
other rows under one id are rows of their own, and an anchor id with several
rows has the results of each.  Only vectors of equal length are compared.  A
score that could need more than 64 bits is an error.  An empty table has no
results.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95                 # percent of the positive's score
ANCHORS, CANDIDATES = 1024, 4096   # rows of a cell's two sides, on average
LEAF = 8                           # shortest side that is split further is longer
TILE = 256                         # anchors whose scores are in memory at once

_KEPT = "anchor_id long, anchor long, slot int, score long, id long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two integer matrices by seven products of their quarters."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), a.dtype)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The ``k`` best (score, id) of each list; higher scores first,
    ties by smaller id.  Heaps over parts of the rows merge into those of all."""

    def __init__(self, k: int):
        self.k = k
        self.row, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row = row[order]
        first = np.searchsorted(row, row, "left")
        keep = np.arange(len(row)) - first < self.k
        order = order[keep]
        self.row, self.score, self.id = row[keep], score[order], ids[order]


def best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(row, score, id) of at least the ``k`` best allowed entries of each row.

    Every entry as good as the ``k``-th is returned, ties included.
    """
    floor = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, floor)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
    else:
        least = np.full(len(masked), floor)
    row, at = np.nonzero(allowed & (masked >= least[:, None]))
    return row, scores[row, at], ids[at]


def integers(rows: DataFrame) -> DataFrame:
    """(id, label, v, uid) of the rows that take part, equal rows once."""
    x = F.col("embedding")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fit)
            .select(F.col("vec_id").cast("long").alias("id"), label.alias("label"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))
            .distinct().withColumn("uid", F.xxhash64("id", "label", "v")))


def _parts(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def _cells(rows: DataFrame, anchors: DataFrame, keys: list) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt over the cells of their ``keys``: a row of one side goes
    to one strip of that side and to all strips of the other."""
    counts = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .join(anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("a")), keys)
              .select(*keys, _parts(F.col("a"), ANCHORS).alias("across"), _parts(F.col("n"), CANDIDATES).alias("down")))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        one = F.pmod(F.col("uid"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        out = side.join(counts, keys).withColumn(f"{own}_at", one).withColumn(f"{other}_at", every)
        return out.select(*[F.col(c).alias(c) for c in (*side.columns, "across_at", "down_at")])
    return dealt(anchors, "across", "down"), dealt(rows, "down", "across")


def _matrix(table: pa.Table) -> np.ndarray:
    v = table.column("v").combine_chunks()
    return v.flatten().to_numpy().reshape(len(v), -1)


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def _scores(a: np.ndarray, c: np.ndarray):
    """(first anchor, scores) for tiles of anchors against all candidates."""
    most = max(int(np.abs(a).max(initial=0)), 1) * max(int(np.abs(c).max(initial=0)), 1)
    if most * max(a.shape[1], 1) >= 1 << 62:
        raise OverflowError("scores of these vectors need more than 64 bits")
    across = np.ascontiguousarray(c.T)
    for at in range(0, len(a), TILE):
        yield at, strassen(a[at:at + TILE], across)


def _kept(ids, uids, slots, heaps: Heaps) -> pa.Table:
    r = heaps.row
    return pa.table([pa.array(x, t) for x, t in (
        (ids[r], pa.int64()), (uids[r], pa.int64()), (slots[r], pa.int32()),
        (heaps.score, pa.int64()), (heaps.id, pa.int64()))],
        names=["anchor_id", "anchor", "slot", "score", "id"])


def _positive_cell(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    ids, uids = _numbers(anchors, "id", "uid")
    c_ids, c_uids = _numbers(rows, "id", "uid")
    heaps = Heaps(k)
    for at, scores in _scores(_matrix(anchors), _matrix(rows)) if len(ids) and len(c_ids) else ():
        own = slice(at, at + len(scores))
        other = (c_ids[None] != ids[own, None]) | (c_uids[None] != uids[own, None])
        row, score, found = best(scores, other, c_ids, k)
        heaps.merge(row + at, score, found)
    return _kept(ids, uids, np.zeros(len(ids), np.int64), heaps)


def _negative_cell(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    ids, uids, labels = _numbers(anchors, "id", "uid", "label")
    c_ids, c_labels = _numbers(rows, "id", "label")
    lists = anchors.column("positives").combine_chunks()
    owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    flat = lists.flatten()
    window, slot = (flat.field(c).to_numpy() for c in ("score", "slot"))
    heaps = Heaps(k)
    for at, scores in _scores(_matrix(anchors), _matrix(rows)) if len(ids) and len(c_ids) else ():
        mine = np.flatnonzero((owner >= at) & (owner < at + len(scores)))
        here = owner[mine] - at
        # 50 p <= 100 s <= 95 p with p and s of 64 bits: bounds of s, rounded inward
        least = np.array([-(-low * int(p) // 100) for p in window[mine]], np.int64)
        most = np.array([high * int(p) // 100 for p in window[mine]], np.int64)
        for slots in range(0, len(mine), TILE):
            part = slice(slots, slots + TILE)
            s = scores[here[part]]
            allowed = (s >= least[part, None]) & (s <= most[part, None]) & \
                (c_labels[None] != labels[owner[mine[part]], None])
            row, score, found = best(s, allowed, c_ids, k)
            heaps.merge(mine[part][row], score, found)
    return _kept(ids[owner], uids[owner], slot, heaps)


def _first(kept: DataFrame, k: int) -> DataFrame:
    """Heaps of all cells merged: the ``k`` best of each anchor and slot."""
    order = Window.partitionBy("anchor_id", "anchor", "slot").orderBy(F.desc("score"), "id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id,
    positive_score, negative_score); ``anchor`` selects anchors by ``id``."""
    table = stored(integers(rows).withColumn("size", F.size("v")), "integers")
    anchors = table.where(anchor)

    left, right = _cells(table, anchors, ["label", "size"])
    cell = ["label", "size", "across_at", "down_at"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        partial(_positive_cell, k=positives), _KEPT)
    best_ones = stored(_first(found, positives).select(
        "anchor_id", "anchor", F.col("rank").alias("slot"), "score", "id"), "positives")

    listed = best_ones.groupBy("anchor_id", "anchor").agg(
        F.collect_list(F.struct("slot", "score")).alias("positives"))      # ``positives`` of them at most
    wanted = anchors.join(listed.select(F.col("anchor_id").alias("id"), F.col("anchor").alias("uid"), "positives"),
                          ["id", "uid"])
    left, right = _cells(table, wanted, ["size"])
    cell = ["size", "across_at", "down_at"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        partial(_negative_cell, k=negatives, low=low, high=high), _KEPT)
    return (_first(found, negatives)
            .select("anchor_id", "anchor", "slot", "rank", F.col("id").alias("negative_id"),
                    F.col("score").alias("negative_score"))
            .join(best_ones.select("anchor_id", "anchor", "slot", F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["anchor_id", "anchor", "slot"])
            .select("anchor_id", "positive_id", F.col("slot").alias("positive_rank"), "rank", "negative_id",
                    "positive_score", "negative_score"))
