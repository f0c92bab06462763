"""Window-style operators.

Running quantities over a global order (progress, success rate, loss-log
windows) aggregate first and run their sums in two levels, inside buckets and
over the buckets' totals; no ``Window`` without ``partitionBy`` sees more than
one row for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durations import format_duration
from .parallel import stored
from .positions import cumulative, with_position


def scaling_table(runs: DataFrame, method: str = "method", workers: str = "workers",
                  seconds: str = "seconds") -> DataFrame:
    """speedup = base / time and efficiency = speedup / workers, where the
    base is the time at the fewest workers of the same method.

    ``runs`` is an aggregate (one row per method and worker count), so the
    window per method is small.
    """
    w = Window.partitionBy(method).orderBy(workers)
    base = F.first(seconds).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ratio = base / F.col(seconds)
    return runs.select(method, workers, F.round(seconds, 6).alias("seconds"),
                       F.round(ratio, 2).alias("speedup"),
                       F.round(F.lit(100.0) * ratio / F.col(workers), 2).alias("efficiency_pct"))


def _cumulative_product(df: DataFrame, col: str, order, out: str = "cumprod") -> DataFrame:
    """Π of ``col`` along ``order``, for the noise schedule, whose T rows
    are a parameter: one ordered window."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.product(col).over(w))


def _batch_totals(results: DataFrame, order, batch_size: int, status: str, value: str | None):
    """Per batch: running totals of its rows, and the number of all rows.

    Rows are numbered once (one sort over ranges); batches are aggregated, and
    their sums run in two levels: inside buckets of consecutive batches, kept
    as one stored table, and over the buckets' totals, of which there are as
    many as shuffle partitions.
    """
    slim = results.select(*order, *[c for c in (status, value) if c and c not in order]) \
        if all(isinstance(c, str) for c in order) else results
    pos = with_position(slim, order, pos_col="_pos", size_col="_n")
    per_batch = pos.groupBy(F.floor(F.col("_pos") / batch_size).cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col(status) == "success").alias("ok_so_far"),
        F.max("_n").alias("total"), *([F.sum(value).alias("elapsed")] if value else []))
    names = ["processed", "ok_so_far", *(["elapsed"] if value else [])]
    buckets = max(8, int(results.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    bucket = F.floor(F.col("batch") * buckets / F.ceil(F.col("total") / batch_size)).alias("bucket")
    inside = Window.partitionBy("bucket").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    run = stored(per_batch.select("*", bucket).select(
        "bucket", "batch", "total", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(n) for n in names]), "runs")
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = run.groupBy("bucket").agg(F.max_by(F.struct(*names), "batch").alias("end")).select(
        "bucket", *[F.coalesce(F.sum(f"end.{n}").over(earlier), F.lit(0)).alias(f"before_{n}") for n in names])
    return run.join(offsets, "bucket").select(
        "batch", "total", *[(F.col(n) + F.col(f"before_{n}")).alias(n) for n in names])


def progress(results: DataFrame, order, batch_size: int, seconds_col: str = "value",
             status_col: str = "status") -> DataFrame:
    """After each batch — items done, items/s, items left and ETA.

    Elapsed time is the running sum of per-item seconds, taken at microsecond
    resolution so that speed and ETA do not depend on the order in which the
    distributed sum was added up; ETA is 0 when the speed is 0, as in the
    original loop.
    """
    c = _batch_totals(results, order, batch_size, status_col, seconds_col) \
        .withColumn("elapsed", F.round("elapsed", 6))
    speed = F.when(F.col("elapsed") > 0, F.col("processed") / F.col("elapsed")).otherwise(F.lit(0.0))
    remaining = F.col("total") - F.col("processed")
    eta = F.when(speed > 0, remaining / speed).otherwise(F.lit(0.0))
    return c.select("batch", F.col("processed").cast("long").alias("processed"),
                    F.col("elapsed"),
                    F.round(speed, 2).alias("items_per_second"),
                    remaining.cast("long").alias("remaining"),
                    format_duration(eta).alias("eta"))


def running_success_rate(results: DataFrame, order, batch_size: int = 8,
                         status_col: str = "status") -> DataFrame:
    """Success share of everything received so far, after each batch."""
    c = _batch_totals(results, order, batch_size, status_col, None)
    return c.select("batch", F.col("processed").cast("long").alias("received"),
                    F.round(F.lit(100.0) * F.col("ok_so_far") / F.col("processed"), 1)
                    .alias("success_rate_pct"))


def _time_bucket(df: DataFrame, first) -> Column:
    """A value that never decreases along an ascending first order key, with
    many rows to a value: hours, ranges of numbers, beginnings of strings."""
    first = F.col(first) if isinstance(first, str) else first
    kind = df.select(first.alias("x")).schema["x"].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", first)
    if isinstance(kind, T.IntegralType):
        return F.floor(first / (1 << 16))
    if isinstance(kind, T.StringType):
        return F.substring(first, 1, 2)
    return F.lit(0)


def ema(df: DataFrame, key: str, order, value: str, decay: float = 0.9999, bucket: Column | None = None) -> DataFrame:
    """The EMA shadow after all updates, per key; ``order`` ascends.

    shadow₀ = x₀; shadowᵢ = (1-d)·xᵢ + d·shadowᵢ₋₁.  A run of updates maps a
    shadow s to D·s + v, so it is a pair (D, v), and two runs in a row merge
    into (D₁·D₂, D₂·v₁ + v₂).  Each key's rows in one ``bucket`` (by default
    an hour, or a like span of the first order key) become a pair; then the
    pairs of a key, one row each, are merged in order.  A key with very many
    rows is thus spread over its buckets, and nothing needs a position.
    """
    d = F.lit(float(decay))
    rows = df.select(F.col(key), (_time_bucket(df, order[0]) if bucket is None else bucket).alias("_bucket"),
                     F.struct(*order).alias("_at"), F.col(value).alias("_x"))
    later = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(F.desc("_at"))) - 1
    pairs = (rows.withColumn("_w", F.pow(d, later)).groupBy(key, "_bucket")
             .agg(F.count(F.lit(1)).alias("_n"), F.sum((1 - d) * F.col("_w") * F.col("_x")).alias("_v"),
                  F.min(F.struct("_at", "_x")).alias("_first")))
    after = Window.partitionBy(key).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    merged = (pairs.withColumn("_later", F.pow(d, F.coalesce(F.sum("_n").over(after), F.lit(0)))).groupBy(key)
              .agg(F.sum(F.col("_later") * F.col("_v")).alias("_v"), F.sum("_n").alias("updates"),
                   F.min(F.struct("_bucket", "_first")).alias("_start")))
    # the first value starts the shadow whole, not with the weight 1 - d
    start = F.coalesce(F.pow(d, F.col("updates")) * F.col("_start._first._x"), F.lit(0.0))
    return merged.select(key, (F.coalesce("_v", F.lit(0.0)) + start).alias("ema"), "updates")


def log_windows(losses: DataFrame, interval: int, epoch: str = "epoch", batch: str = "batch_idx",
                loss: str = "loss") -> DataFrame:
    """The logged loss — the sum since the previous log point divided by
    ``interval`` — at every batch with ``batch % interval == 0``.

    The running sum is never reset at epoch borders (original behaviour);
    ``true_mean`` divides by the real number of batches instead.  In an epoch,
    ``ceil(batch / interval)`` is the number of the log point that a batch
    counts for, so one aggregate gives the pieces of all windows.  A piece that
    lacks its log point (an epoch's end) counts for the next that has one:
    pieces, not rows, are numbered by the log points before them.
    """
    piece = F.ceil(F.col(batch) / interval).cast("long")
    pieces = losses.groupBy(F.col(epoch), piece.alias("_piece")).agg(
        F.sum(loss).alias("_sum"), F.count(F.lit(1)).alias("_cnt"),
        F.max((F.col(batch) % interval == 0).cast("long")).alias("_logs"), F.max(batch).alias(batch))
    isl = cumulative(pieces, [epoch, "_piece"], {"_island": F.col("_logs")}, inclusive=False)
    g = isl.groupBy("_island").agg(
        F.sum("_logs").alias("_logs"), F.sum("_sum").alias("_sum"), F.sum("_cnt").alias("_cnt"),
        F.max(F.struct(F.col(epoch), F.col(batch))).alias("_at"))
    return g.where(F.col("_logs") == 1).select(
        F.col("_at")[epoch].alias(epoch), F.col("_at")[batch].alias(batch),
        F.round(F.col("_sum") / interval, 6).alias("logged_loss"),
        F.round(F.col("_sum") / F.col("_cnt"), 6).alias("true_mean"))
