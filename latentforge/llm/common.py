"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A word is a run of code points other than the six ASCII white-space
# characters; Java and Python regular expressions read both alike.
SPACE = r"[\x20\x09-\x0D]"
NON_SPACE = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the two columns that the operators read."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column used inside a higher-order function may be inlined by the
    optimizer and then be computed again for every element; a lambda variable
    is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text in order (array<string>); null and empty give none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def positions(n: Column) -> Column:
    """0 .. n-1 (empty for n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)) \
            .otherwise(F.array().cast("array<int>"))


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared folder and read it back.

    The folder is the one that ``spark.checkpoint.dir`` names, so that the
    table survives lost executors and later jobs don't compute it again.  The
    shuffle files behind it aren't needed any more and are removed at the end
    of the write.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


BROADCAST_ROWS = 1_000_000     # rows of one id each: 16 MB at most


def if_small(ids: DataFrame) -> DataFrame:
    """A stored one-column table of ids, marked for broadcast only if its count
    is at most ``BROADCAST_ROWS``; larger ones are joined by shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
