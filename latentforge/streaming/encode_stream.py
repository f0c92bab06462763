"""The encode queue as a Structured Streaming query.

The original fed mini-batches to GPU workers through queues with an end
marker and collected results as they arrived.  Here the input is a folder
of record files read by ``readStream`` (``maxFilesPerTrigger`` bounds the
micro-batch, the checkpoint remembers which files are done), each
micro-batch goes through the same error-isolating batch operator as the
batch job, and results go to a file sink that is exactly-once through the
checkpoint.  ``trigger(availableNow=True)`` drains what is there and stops
— the end marker.  A stopped or crashed run resumes from the checkpoint
without losing or doubling rows (T4).
"""

from __future__ import annotations

import contextlib

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.inference import safe_map

_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def source(spark: SparkSession, src_dir: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(src_dir)


def encode_stream(spark: SparkSession, src_dir: str, schema: T.StructType, fn, keys, value_col: str,
                  result_type: T.DataType, sink_dir: str, checkpoint_dir: str,
                  files_per_batch: int = 1, batch_size: int = 8, split_by_status: bool = False):
    """Stream → ``safe_map`` (error rows instead of a dead worker) →
    Parquet sink.  With ``split_by_status`` the sink is partitioned by
    ``status``, so success and error rows land in separate folders.  Runs
    until the available input is drained; returns the finished query (its
    ``recentProgress`` has per-batch row counts)."""
    stream = source(spark, src_dir, schema, files_per_batch)
    out = safe_map(stream, fn, keys, value_col, result_type, batch_size=batch_size)
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).option("path", sink_dir)
    if split_by_status:
        w = w.partitionBy("status")
    q = w.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


@contextlib.contextmanager
def _stateful(spark: SparkSession, settings: dict | None = None):
    """Settings of a query with state while it runs.  Its state has one key for
    each status, so it gets no more partitions than there are cores: each costs
    a state store and a commit in every micro-batch, with rows or without."""
    cores, now = spark.sparkContext.defaultParallelism, int(spark.conf.get(_PARTITIONS))
    settings = {_PARTITIONS: str(min(cores, now)), **(settings or {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_progress(spark: SparkSession, src_dir: str, schema: T.StructType, fn, keys, value_col: str,
                    result_type: T.DataType, progress_dir: str, checkpoint_dir: str,
                    files_per_batch: int = 1, batch_size: int = 8):
    """Running count and success rate after every micro-batch.

    A streaming aggregation by status (state = one count per status) in
    ``complete`` mode; each micro-batch rewrites the small progress table
    under its batch id, so a retried batch overwrites itself.
    """
    stream = source(spark, src_dir, schema, files_per_batch)
    out = safe_map(stream, fn, keys, value_col, result_type, batch_size=batch_size)
    counts = out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))

    def write(batch_df: DataFrame, batch_id: int):
        total = F.sum("n").over(Window.partitionBy())
        (batch_df.select("status", "n", F.round(F.lit(100.0) * F.col("n") / total, 1).alias("pct"))
         .write.mode("overwrite").parquet(f"{progress_dir}/batch_id={batch_id}"))

    with _stateful(spark):
        q = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint_dir)
             .foreachBatch(write).trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def latest_progress(spark: SparkSession, progress_dir: str) -> DataFrame:
    """Counts after the last micro-batch."""
    p = spark.read.parquet(progress_dir)
    last = p.agg(F.max("batch_id").alias("batch_id"))
    return p.join(last, "batch_id").select("status", "n", "pct")


PROGRESS = T.StructType([T.StructField("status", T.StringType()), T.StructField("n", T.LongType()),
                         T.StructField("total", T.DoubleType()), T.StructField("files", T.IntegerType())])


def _partial_progress(batches):
    """A task's rows of a micro-batch as one row for each status: rows and sum
    of their values."""
    sums: dict = {}
    for pdf in batches:
        for status, part in pdf.groupby("status")["result"]:
            n, total = sums.get(status, (0, 0.0))
            sums[status] = n + len(part), total + float(part.sum())
    yield pd.DataFrame([(k, *v) for k, v in sums.items()], columns=["status", "n", "total"])


class _Progress(StatefulProcessor):
    """Keeps, for each status, its rows, the sum of their values and the number
    of micro-batches that brought any; emits them after each micro-batch.  Gets
    the sums of the micro-batch's tasks."""

    def init(self, handle):
        self.state = handle.getValueState("progress", "n long, total double, files int")

    def handleInputRows(self, key, rows, timerValues):
        n, total, files = self.state.get() if self.state.exists() else (0, 0.0, 0)
        for r in rows:
            n, total = n + r["n"], total + r["total"]
        self.state.update((n, total, files + 1))
        yield Row(status=key[0], n=n, total=total, files=files + 1)

    def close(self):
        pass


def resume_progress(spark: SparkSession, src_dir: str, schema: T.StructType, fn, keys, value_col: str,
                    out_dir: str, checkpoint_dir: str, files_per_batch: int = 1, batch_size: int = 8,
                    stop_after: int | None = None) -> bool:
    """T4: encode the files of ``src_dir`` and keep running progress per status
    as state of the query; True when all input is done.

    ``stop_after`` interrupts the run after so many micro-batches: rows and
    state up to there are saved.  The next call with the same checkpoint goes
    on behind them.  Each micro-batch writes under its number, so that one
    that is repeated after a crash replaces its own output.
    """
    out = safe_map(source(spark, src_dir, schema, files_per_batch), fn, keys, value_col, T.DoubleType(),
                   batch_size=batch_size)
    parts = out.select("status", "result").mapInPandas(_partial_progress, "status string, n long, total double")
    progress = parts.groupBy("status").transformWithState(
        statefulProcessor=_Progress(), outputStructType=PROGRESS, outputMode="Update", timeMode="None")

    class Interrupted(Exception):
        pass

    seen = []

    def write(batch: DataFrame, batch_id: int):
        if stop_after is not None and len(seen) == stop_after:
            raise Interrupted
        seen.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    try:
        with _stateful(spark, {_PROVIDER: _ROCKS}):
            query = (progress.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir)
                     .foreachBatch(write).trigger(availableNow=True).start())
            query.awaitTermination()
    except StreamingQueryException as e:
        if "Interrupted" not in str(e):
            raise
        return False
    return True


def last_progress(spark: SparkSession, out_dir: str) -> DataFrame:
    """(status, n, total): the latest progress of each status."""
    rows = spark.read.schema(T.StructType([*PROGRESS.fields, T.StructField("batch_id", T.LongType())])).parquet(out_dir)
    return rows.groupBy("status").agg(F.max_by(F.struct("n", "total"), "batch_id").alias("p")).select("status", "p.*")
