"""Explicit row positions and running totals without a single-task window.

The original jobs are positional: list index, ``data[:n]``, ``chunk i``,
running counts.  A global ``Window.orderBy`` would put every row in one task.
Here the rows are sorted once, over all tasks:

1. ``repartitionByRange`` over the whole order key (group columns first, then
   every column of ``order``) gives each task one range of it.  A hot group, or
   a hot first key, is split wherever a later key differs.
2. The sorted rows are written once, to the shared folder, each with its place
   in its range; so the ranges stay as they are, however often the table is
   read and whatever adaptive execution makes of the later plan.
3. Counts of each (group, range) — from the places alone, a column of its own
   in the file — become offsets, and an equi-join adds them.  That table has a
   row for each group and range; AQE broadcasts it while it is small.

Only rows that are equal in the whole order key can't be split over ranges;
their order among each other is any, but fixed by the write.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parallel import stored

_AT = "_lf_at"             # range << 33 | place in the range
_RANGE = "_lf_range"


def _names(cols) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in (cols or [])]


def ranked(df: DataFrame, order, partition_by=(), num_buckets: int | None = None) -> DataFrame:
    """``df`` sorted by (groups, order) over ranges and stored, with the place
    of each row in ``_lf_at``."""
    keys = [*_names(partition_by), *_names(order)]
    ranges = df.repartitionByRange(num_buckets, *keys) if num_buckets else df.repartitionByRange(*keys)
    placed = ranges.sortWithinPartitions(*keys).withColumn(_AT, F.monotonically_increasing_id())
    return stored(placed, "ranked")


def _range() -> Column:
    return F.call_function("shiftright", F.col(_AT), F.lit(33))


def _offsets(counts: DataFrame, part: list, sums: dict, totals: bool) -> DataFrame:
    """Per (group, range): what the group has in earlier ranges."""
    earlier = Window.partitionBy(*part).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *part, _RANGE, *[c for c in counts.columns if c not in (*part, _RANGE, *sums)],
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_lf_o_{n}") for s, n in sums.items()],
        *([F.sum(s).over(Window.partitionBy(*part)).alias(f"_lf_t_{n}") for s, n in sums.items()] if totals else []))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list) -> DataFrame:
    renamed = {k: f"_lf_r_{k}" for k in keys}
    r = right.withColumnsRenamed(renamed)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[renamed[k]]) for k in keys])
    return left.join(r, cond, "inner").drop(*renamed.values())


def with_position(df: DataFrame, order, partition_by=(), num_buckets: int | None = None, pos_col: str = "pos",
                  size_col: str | None = None) -> DataFrame:
    """0-based position along ``order`` within ``partition_by`` groups.

    ``size_col`` (optional) receives the group size — what the original
    jobs get from ``len(data)``.  Nulls and NaN stand where Spark sorts them.
    """
    part = list(partition_by or [])
    rows = ranked(df, order, part, num_buckets).withColumn(_RANGE, _range())
    counts = rows.groupBy(*part, _RANGE).agg(F.min(_AT).alias("_lf_first"), F.count(F.lit(1)).alias("_lf_n"))
    offsets = _offsets(counts, part, {"_lf_n": "pos"}, size_col is not None)
    joined = _null_safe_join(rows, offsets, part + [_RANGE])
    return joined.select(
        *[joined[c] for c in df.columns if c not in (pos_col, size_col)],
        (F.col(_AT) - F.col("_lf_first") + F.col("_lf_o_pos")).alias(pos_col),
        *([F.col("_lf_t_pos").alias(size_col)] if size_col is not None else []))


def cumulative(df: DataFrame, order, sums: dict, partition_by=(), num_buckets: int | None = None,
               totals: bool = False, inclusive: bool = True) -> DataFrame:
    """Running sums of ``sums`` (name → Column) along ``order`` within groups.

    ``inclusive`` sums include the current row.  With ``totals=True`` the
    group total of each sum is added as ``<name>_total``.  Sums run inside
    ranges, and the sums of earlier ranges are added.
    """
    part = list(partition_by or [])
    value = {n: f"_lf_v_{n}" for n in sums}
    rows = ranked(df.select("*", *[c.alias(value[n]) for n, c in sums.items()]), order, part, num_buckets) \
        .withColumn(_RANGE, _range())
    counts = rows.groupBy(*part, _RANGE).agg(*[F.sum(v).alias(v) for v in value.values()])
    offsets = _offsets(counts, part, {v: n for n, v in value.items()}, totals)
    inside = Window.partitionBy(*part, _RANGE).orderBy(_AT) \
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    inner = rows.select(*df.columns, _RANGE, *[
        F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_lf_i_{n}") for n, v in value.items()])
    joined = _null_safe_join(inner, offsets, part + [_RANGE])
    return joined.select(
        *[joined[c] for c in df.columns],
        *[(F.col(f"_lf_o_{n}") + F.col(f"_lf_i_{n}")).alias(n) for n in sums],
        *([F.col(f"_lf_t_{n}").alias(f"{n}_total") for n in sums] if totals else []))
