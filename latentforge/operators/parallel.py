"""Spreading CPU-heavy per-row work over the cluster.

A small input (one Parquet row group) is scanned by a single task, and
every per-row stage after it — regexes over whole texts, tokenising,
Python encoders, array math — would run on one core.  :func:`spread`
round-robin repartitions such an input to the cluster's parallelism before
the heavy stage.  Large inputs already have more splits than cores and are
returned unchanged, so at scale it adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of an expensive intermediate (a Python stage used by
    two branches, a long plan) with a reliable checkpoint in the shared
    folder named by ``spark.checkpoint.dir`` — it survives lost executors,
    unlike a cache or a local checkpoint."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once, as Parquet in the shared folder, and
    read it back.  Unlike a checkpoint it is read by column, and unlike a cache
    it survives lost executors."""
    from ..session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHUFFLE_NODES = ("Exchange", "TakeOrderedAndProject", "CollectLimit", "GlobalLimit")


def _after_shuffle(df: DataFrame) -> bool:
    """True when the planned query already contains a shuffle or a limit.

    Reads the planned physical plan as printed by ``explain()`` (nothing
    runs).  Asking such a plan for its RDD partition count would make
    adaptive execution run the upstream shuffle stages right away, so those
    inputs are left as they are — their partition count comes from the
    shuffle, not from small files.
    """
    import contextlib
    import io

    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            df.explain()
    except Exception:
        return True
    plan = buf.getvalue()
    return any(n in plan for n in _SHUFFLE_NODES)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition a small scan-level input before CPU-heavy work.

    Spread when the input has fewer splits than cores, or fewer files than
    cores while still small (under four splits per core): a file with one
    row group is planned as several byte-range splits of which only one
    holds rows.  Inputs with many splits, and inputs that already come out of
    a shuffle, are returned unchanged.  A stream is always spread: a
    micro-batch of a few files, each of one row group, would keep as few cores
    busy, however large the files are.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming:
        return df.repartition(target)
    if _after_shuffle(df):
        return df
    try:
        n = df.rdd.getNumPartitions()      # file splits only: no job for a scan
        if n >= 4 * target:
            return df
        files = len(df.inputFiles())
    except Exception:  # planning failed here; let the real action report it
        return df
    return df.repartition(target) if (n < target or files < target) else df
