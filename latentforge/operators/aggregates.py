"""Aggregations.

All aggregates here are algebraic (counts, sums, min/max, ``min_by``), so
Spark runs them as partial hash aggregation before the shuffle: a key that
holds a third of all rows is reduced on the map side and never lands in one
task as raw rows.  No operator collects an unbounded group into a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..functions.arrays import sq_error_sum
from ..functions.durations import format_duration
from .parallel import spread
from .positions import with_position

DIMENSIONS = ("gender_distribution", "age_groups", "group_sizes", "activities")


def _lower(df: DataFrame, text_col: str) -> DataFrame:
    # Lower-case once; the projection is kept because `_lc` is used many
    # times (Catalyst does not inline non-cheap expressions used repeatedly).
    return spread(df.select(text_col)).select(tx.lower_text(text_col).alias("_lc"))


def _long(row_cols: list) -> Column:
    """(dimension, category, n) rows from a list of (dimension, category, Column)."""
    return F.inline(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.lit(c).alias("category"),
                 v.cast("long").alias("n")) for d, c, v in row_cols]))


def captions_per_image(df: DataFrame, key: str = "image_id", order: str = "ann_id") -> DataFrame:
    """A1: the ordered captions of each image, as rows (key, order, caption,
    pos, n_captions) — the list of the original, without building it in one task."""
    return with_position(df, [order], partition_by=[key], pos_col="pos", size_col="n_captions")


def gender_counts(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT) -> DataFrame:
    """A2: rows with a space-delimited term per gender; every gender present, 0 included."""
    lc = F.col("_lc")
    agg = _lower(df, text_col).agg(*[
        F.count_if(tx.space_term_match(lc, terms)).alias(g) for g, terms in lexicon.gender.items()])
    return agg.select(_long([("gender_distribution", g, F.col(g)) for g in lexicon.gender])) \
        .select("category", "n")


def age_counts(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT) -> DataFrame:
    """A3: rows per age group (a row may count in several); zero groups absent."""
    flags = tx.age_flags(F.col("_lc"), lexicon)
    agg = _lower(df, text_col).agg(*[F.count_if(f).alias(g) for g, f in flags.items()])
    return agg.select(_long([("age_groups", g, F.col(g)) for g in flags])) \
        .where("n > 0").select("category", "n")


def group_size_counts(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT) -> DataFrame:
    """A4: exactly one class per row."""
    return _lower(df, text_col).groupBy(tx.group_size_class(F.col("_lc"), lexicon).alias("category")) \
        .agg(F.count(F.lit(1)).alias("n"))


def activity_counts(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT) -> DataFrame:
    """A5: occurrences (not rows) of each activity word."""
    hits = _lower(df, text_col).select(F.explode(tx.find_terms(F.col("_lc"), lexicon.activities)).alias("category"))
    return hits.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def demographics(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT,
                 with_total: bool = False) -> DataFrame:
    """Gender, age, group-size and activity statistics in one scan.

    One projection computes every flag per row, one global aggregate (partial
    per task, then a single tiny merge) counts them, and the one-row result is
    unpivoted to (dimension, category, n).  Genders are always present;
    other categories only when seen, as in the original counters.
    """
    lc = F.col("_lc")
    age = tx.age_flags(lc, lexicon)
    classes = [name for name, _ in lexicon.group_sizes] + [lexicon.group_default]
    flags = _lower(df, text_col).select(
        *[tx.space_term_match(lc, t).alias(f"g_{i}") for i, t in enumerate(lexicon.gender.values())],
        *[f.alias(f"a_{i}") for i, f in enumerate(age.values())],
        tx.group_size_class(lc, lexicon).alias("grp"),
        tx.find_terms(lc, lexicon.activities).alias("hits"))
    sums = flags.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f"g_{i}")).alias(f"g_{i}") for i in range(len(lexicon.gender))],
        *[F.count_if(F.col(f"a_{i}")).alias(f"a_{i}") for i in range(len(age))],
        *[F.count_if(F.col("grp") == c).alias(f"s_{i}") for i, c in enumerate(classes)],
        *[F.sum(tx.count_term(F.col("hits"), t)).alias(f"t_{i}") for i, t in enumerate(lexicon.activities)])
    rows = ([("gender_distribution", g, F.col(f"g_{i}")) for i, g in enumerate(lexicon.gender)]
            + [("age_groups", g, F.col(f"a_{i}")) for i, g in enumerate(age)]
            + [("group_sizes", c, F.col(f"s_{i}")) for i, c in enumerate(classes)]
            + [("activities", t, F.coalesce(F.col(f"t_{i}"), F.lit(0))) for i, t in enumerate(lexicon.activities)])
    out = sums.select("total", _long(rows))
    out = out.where((F.col("dimension") == "gender_distribution") | (F.col("n") > 0))
    return out if with_total else out.drop("total")


def distribution_summary(df: DataFrame, text_col: str = "caption", lexicon: lx.Lexicon = lx.DEFAULT,
                         dimensions=("gender_distribution", "age_groups", "group_sizes")) -> DataFrame:
    """Count and percent of the dataset size per category.

    The total comes out of the same one-row aggregate as the counts, so no
    extra scan or join is needed.
    """
    d = demographics(df, text_col, lexicon, with_total=True)
    return d.where(F.col("dimension").isin(list(dimensions))).select(
        "dimension", "category", "n", "total", tx.percent("n", "total", 2).alias("pct"))


def processing_summary(results: DataFrame, seconds: Column | float, status_col: str = "status",
                       only_if_success: bool = False) -> DataFrame:
    """success/failure counts, seconds per item and items per second.

    ``seconds`` is the elapsed time (a number or an aggregate expression).
    ``only_if_success`` gives the GPU variant: rates NULL when nothing succeeded.
    """
    secs = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    s = results.agg(F.count_if(F.col(status_col) == "success").alias("successful"),
                    F.count_if(F.col(status_col) == "error").alias("failed"),
                    secs.alias("total_seconds"))
    ok = F.col("successful")
    avg = F.round(F.col("total_seconds") / F.greatest(ok, F.lit(1)), 3)
    speed = F.round(ok / F.col("total_seconds"), 2)
    if only_if_success:
        avg, speed = F.when(ok > 0, F.round(F.col("total_seconds") / ok, 3)), F.when(ok > 0, speed)
    return s.select("successful", "failed", format_duration("total_seconds").alias("total_time"),
                    avg.alias("avg_seconds_per_item"), speed.alias("items_per_second"))


def mse(df: DataFrame, pred: str, target: str, group_by=()) -> DataFrame:
    """Mean squared error over all elements of each group (a batch)."""
    return df.groupBy(*group_by).agg(
        (F.sum(sq_error_sum(pred, target)) / F.sum(F.size(pred))).alias("mse"))


def eval_loss(batch_losses: DataFrame, loss_col: str = "loss", group_by=()) -> DataFrame:
    """A10: mean of batch means; +Infinity when there is no batch.

    Without grouping the global aggregate always yields one row, so an empty
    input gives Infinity like the original.
    """
    return batch_losses.groupBy(*group_by).agg(
        F.coalesce(F.avg(loss_col), F.lit(float("inf"))).alias("eval_loss"))


def profile(df: DataFrame) -> DataFrame:
    """Rows, and per column its type, nulls and array size range — over
    all rows (the original looked at the first record only)."""
    from pyspark.sql.types import ArrayType

    aggs = [F.count(F.lit(1)).alias("_rows")]
    fields = df.schema.fields
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"_n{i}"))
        if isinstance(f.dataType, ArrayType):
            aggs += [F.min(F.size(c)).alias(f"_lo{i}"), F.max(F.size(c)).alias(f"_hi{i}")]
        else:
            aggs += [F.lit(None).cast("int").alias(f"_lo{i}"), F.lit(None).cast("int").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
                              F.col(f"_n{i}").cast("long").alias("nulls"),
                              F.col(f"_lo{i}").cast("int").alias("min_size"),
                              F.col(f"_hi{i}").cast("int").alias("max_size"))
                     for i, f in enumerate(fields)])
    return one.select(F.col("_rows").cast("long").alias("n_rows"), F.inline(rows))


def bundle_shapes(df: DataFrame, array_cols, text_col: str | None = None, null_counts=()) -> DataFrame:
    """N and the per-row length range of each array column (one scan)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in array_cols:
        aggs += [F.min(F.size(c)).alias(f"{c}_min_len"), F.max(F.size(c)).alias(f"{c}_max_len")]
    if text_col:
        aggs.append(F.count(text_col).alias(f"{text_col}_count"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in null_counts]
    return df.agg(*aggs)


def collate(df: DataFrame, batch_cols, order: str, fields) -> DataFrame:
    """The samples of each batch stacked in order.

    Batches are bounded by the batch size, so collecting one batch into an
    array is bounded too.  An empty input gives no batch.
    """
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *[F.col(f) for f in fields])))
    g = df.groupBy(*batch_cols).agg(packed.alias("_items"))
    return g.select(*batch_cols, F.size("_items").alias("batch_len"),
                    *[F.transform("_items", _getter(f)).alias(f) for f in fields])


def _getter(field: str):
    return lambda s: s[field]


def per_item_time(total_seconds: Column, n: Column) -> Column:
    """Seconds per item, three decimals."""
    return F.when(n != 0, F.round(total_seconds / n, 3))


def time_saved(runs: DataFrame, method_a: str, method_b: str, key: str = "workers",
               method_col: str = "method", value_col: str = "seconds") -> DataFrame:
    """A − b and its percent of a, per key, with conditional aggregates."""
    a = F.max(F.when(F.col(method_col) == method_a, F.col(value_col)))
    b = F.max(F.when(F.col(method_col) == method_b, F.col(value_col)))
    g = runs.groupBy(key).agg(a.alias("a_seconds"), b.alias("b_seconds"))
    saved = F.col("a_seconds") - F.col("b_seconds")
    return g.select(key, F.round("a_seconds", 6).alias("a_seconds"), F.round("b_seconds", 6).alias("b_seconds"),
                    F.round(saved, 6).alias("saved_seconds"),
                    F.when(F.col("a_seconds") != 0, F.round(F.lit(100.0) * saved / F.col("a_seconds"), 2))
                    .alias("saved_pct"))


def checkpoint_loss(losses: DataFrame, log_interval: int, save_interval: int,
                    epoch: str = "epoch", batch: str = "batch_idx", loss: str = "loss") -> DataFrame:
    """The loss stored with each checkpoint.

    Batch 0 of every epoch is a log point, so the running sum at the end of an
    epoch is the sum of the batches after its last log point (the last block
    of ``log_interval`` batches, minus its first batch); it is divided by the
    number of batches of that epoch.  Two chained aggregates — per (epoch,
    block), then ``max_by`` per epoch — read the log once, split a hot epoch
    into blocks, and need no join or window.
    """
    saves = losses.where((F.col(epoch) + 1) % save_interval == 0)
    blocks = saves.groupBy(epoch, F.floor(F.col(batch) / log_interval).alias("_blk")).agg(
        F.sum(F.when(F.col(batch) % log_interval != 0, F.col(loss))).alias("_tail"),
        F.max(batch).alias("_last"))
    per_epoch = blocks.groupBy(epoch).agg(F.max_by("_tail", "_blk").alias("_tail"),
                                          F.max("_last").alias("_last"))
    return per_epoch.select(
        epoch, F.col("_last").alias("last_batch"),
        (F.coalesce(F.col("_tail"), F.lit(0.0)) / (F.col("_last") + 1)).alias("checkpoint_loss"))
