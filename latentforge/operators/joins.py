"""Joins (J1–J5).

Big-to-big joins are plain equi-joins: AQE picks broadcast when the runtime
size of a side is under the broadcast threshold and splits skewed
partitions otherwise.  An explicit ``broadcast()`` is used only for the
noise schedule, whose size is fixed by its parameter T.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..functions.rand import hash_hex
from .filters import fallback_predicate
from .positions import with_position

# The schedule has T rows of six numbers; above this it is not broadcast.
MAX_BROADCAST_SCHEDULE_ROWS = 1_000_000


def attach_captions(images: DataFrame, captions: DataFrame, terms=lx.PEOPLE_KEYWORDS, seed: int = 0,
                    root: str = "", split: str = "train2014", content_col: str | None = None,
                    image_key: str = "id", caption_key: str = "image_id", ann_key: str = "ann_id",
                    text: str = "caption", person=None) -> DataFrame:
    """J1 (with F1, F2, O3, X1, F3): images that have at least one passing
    caption, each with the number of passing captions and one picked caption.

    Captions are filtered and reduced per image first (partial aggregation:
    ``count`` and ``min_by`` of a key hash — a deterministic stand-in for the
    unseeded random pick), so only one row per image reaches the join.
    ``person`` (a UDF of the text, such as :func:`filters.gazetteer_person`)
    also lets captions pass that name a person without a keyword.
    """
    keyword = tx.any_substring(tx.lower_text(text), terms)
    passing = captions.where(keyword) if person is None else fallback_predicate(captions, keyword, person, text)
    pick = hash_hex(seed, F.col(caption_key), F.col(ann_key))
    per_image = passing.groupBy(caption_key).agg(
        F.count(F.lit(1)).alias("n_captions"),
        F.min_by(F.col(text), pick).alias(text))
    imgs = images if content_col is None else images.where(F.col(content_col).isNotNull())
    j = imgs.join(per_image, imgs[image_key] == per_image[caption_key], "inner").drop(per_image[caption_key])
    return j.withColumn("image_path", tx.image_path(root, split, "file_name"))


def has_caption(images: DataFrame, captions: DataFrame, image_key: str = "id",
                caption_key: str = "image_id") -> DataFrame:
    """Images with at least one caption (left semi join)."""
    return images.join(captions, images[image_key] == captions[caption_key], "left_semi")


def zip_join(left: DataFrame, right: DataFrame, left_order, right_order,
             pos_col: str = "pos") -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right``
    (truncated to the shorter side), by distributed positions."""
    lp = with_position(left, left_order, pos_col=pos_col)
    rp = with_position(right, right_order, pos_col=pos_col)
    return lp.join(rp, pos_col, "inner")


def key_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J3, recommended form: join on the sample key instead of position."""
    return left.join(right, key, "inner")


def lookup_schedule(df: DataFrame, schedule: DataFrame, t_col: str = "t",
                    schedule_rows: int | None = None) -> DataFrame:
    """Schedule values at each row's timestep (no match out of range).

    The schedule has one row per timestep; it is broadcast when its known
    row count is under the limit, else joined normally.
    """
    s = schedule.withColumnRenamed("t", "_t")
    if schedule_rows is not None and schedule_rows <= MAX_BROADCAST_SCHEDULE_ROWS:
        s = F.broadcast(s)
    return df.join(s, df[t_col] == s["_t"], "inner").drop("_t")


def compare_methods(table: DataFrame, methods, key: str = "workers", method: str = "method",
                    values=("speedup", "efficiency_pct")) -> DataFrame:
    """Methods side by side per worker count (pivot with known values,
    so no extra job is needed to find them)."""
    out = table.groupBy(key).pivot(method, list(methods)).agg(*[F.first(v).alias(v) for v in values])
    if len(values) == 1:  # Spark names a single-aggregate pivot column by the value alone
        for m in methods:
            out = out.withColumnRenamed(str(m), f"{m}_{values[0]}")
    return out
