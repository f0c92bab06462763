"""Best-fit packing into bins of several permitted sequence lengths.

Documents are measured in words and cut into pieces no longer than the
largest permitted length, so every word of every document is packed.  Pieces
are dealt evenly over partitions and packed in bounded groups, longest first:

* a piece goes to the open bin with the least room that still holds it;
* if none does, a bin is opened whose capacity costs least for each word it
  is still expected to hold;
* at the end each bin is downsized to the smallest permitted length that
  holds its contents.

Every ceiling on the capacities is tried for a group (with the largest
lengths left out only if no piece needs them) and the cheapest packing after
downsizing is kept, so the lengths are chosen jointly.

Defined results: null and empty texts have no words and no piece; they give
no row.  Repeated rows are packed each.  Ties in length go by id, then piece.
An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

CAPACITIES = (256, 512, 1024, 2048, 4096)
GROUP_PIECES = 20_000          # pieces packed together: bounds memory and time
PARTITION_PIECES = 100_000     # pieces for each partition
SCHEMA = ("doc_id long, piece int, start int, length int, bin_id long, "
          "capacity int, bin_offset int, bin_used int")


def cost(capacity: int) -> float:
    """Training cost of one sequence: linear work, attention, fixed overhead."""
    return capacity + capacity * capacity / 16_384 + 32


def pieces(docs: DataFrame, length: Column, most: int) -> DataFrame:
    """(doc_id, piece, start, length): whole documents in runs of ``most``."""
    n = length.cast("int")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("_n"))
            .where("_n > 0")
            .select("doc_id", "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / most).cast("int")))
                    .alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * most).alias("start"),
                    F.least(F.lit(most), F.col("_n") - F.col("piece") * most).alias("length")))


def best_fit(lengths: list, capacities=CAPACITIES) -> tuple[list, list, list]:
    """Pack lengths (longest first): bin of each item, used and size of each bin.

    Open bins are kept by room: a bit mask tells which rooms occur, so the
    least sufficient room is found without a search through the bins.
    """
    mask, by_room, where, used = 0, {}, [], []
    capacities = sorted(capacities)
    left = sum(lengths)
    for n in lengths:
        fit = mask >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << room)
        else:
            b = len(used)
            used.append(0)
            room = min((c for c in capacities if c >= n), key=lambda c: (cost(c) / min(c, max(left, n)), c))
        used[b] += n
        left -= n
        room -= n
        if room:
            by_room.setdefault(room, []).append(b)
            mask |= 1 << room
        where.append(b)
    return where, used, [capacities[bisect_left(capacities, u)] for u in used]


def pack_group(lengths: list, capacities=CAPACITIES) -> tuple[list, list, list]:
    """The cheapest of the packings with each ceiling on the capacities."""
    capacities = sorted(capacities)
    most = max(lengths)
    tried = [best_fit(lengths, capacities[:k + 1]) for k, c in enumerate(capacities) if c >= most]
    return min(tried, key=lambda t: sum(map(cost, t[2])))


def _packer(capacities, group):
    def pack(batches):
        first = TaskContext.get().partitionId() << 33
        held = None

        def flush(part):
            nonlocal first
            part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True],
                                    kind="stable", na_position="last")
            where, used, size = pack_group(part["length"].tolist(), capacities)
            bins = pd.Series(where, index=part.index)
            part = part.assign(bin_id=bins + first, capacity=[size[b] for b in where],
                               bin_offset=part.groupby(bins)["length"].cumsum() - part["length"],
                               bin_used=[used[b] for b in where])
            first += len(used)
            return part[["doc_id", "piece", "start", "length", "bin_id", "capacity", "bin_offset", "bin_used"]]

        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            while len(held) >= group:
                yield flush(held.iloc[:group].reset_index(drop=True))
                held = held.iloc[group:]
        if held is not None and len(held):
            yield flush(held.reset_index(drop=True))
    return pack


def pack(docs: DataFrame, length: Column | None = None, capacities=CAPACITIES,
         group: int = GROUP_PIECES) -> DataFrame:
    """One row for each piece: its bin, the bin's capacity and its place there.

    Only ids and lengths are shuffled.  The deal over partitions is even
    whatever the keys are; the sort inside a partition makes the groups, and
    so the bins, the same when a task runs again.
    """
    length = F.size(words(F.col("text"))) if length is None else length
    cut = pieces(docs, length, max(capacities))
    n = cut.count()
    parts = max(1, -(-n // PARTITION_PIECES))
    dealt = cut.repartition(parts).sortWithinPartitions(F.xxhash64("doc_id", "piece"), "doc_id", "piece", "length")
    return dealt.mapInPandas(_packer(tuple(capacities), group), SCHEMA)


def bins(packed: DataFrame) -> DataFrame:
    """One row for each bin: capacity, words used and number of pieces."""
    return packed.groupBy("bin_id").agg(F.first("capacity").alias("capacity"),
                                        F.first("bin_used").alias("bin_used"),
                                        F.count(F.lit(1)).alias("n_pieces"))
