"""The scaling study: times → speedup → efficiency, methods side by side.

Run timings are a table (method, workers, seconds); text times such as
``0:04:59`` go through X3 first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import parse_duration
from ..operators import aggregates as agg
from ..operators import joins as jn
from ..operators import windows as win

BASELINE_RUNS = [
    ("image-multiprocessing", 1, "0:04:59"), ("image-multiprocessing", 2, "0:05:23"),
    ("image-multiprocessing", 4, "0:05:39"), ("image-multiprocessing", 8, "0:05:57"),
    ("image-joblib", 1, "0:04:55"), ("image-joblib", 2, "0:05:04"),
    ("image-joblib", 4, "0:04:58"), ("image-joblib", 8, "0:05:09"),
]


def runs_from_text(df: DataFrame, text_col: str = "time") -> DataFrame:
    return df.withColumn("seconds", parse_duration(text_col).cast("double"))


def study(runs: DataFrame, methods, baseline_method: str | None = None, other: str | None = None):
    """(scaling table, side-by-side comparison[, time saved])."""
    table = win.scaling_table(runs)
    side = jn.compare_methods(table, methods)
    saved = agg.time_saved(runs, baseline_method, other) if baseline_method and other else None
    return table, side, saved


def baseline_runs(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(BASELINE_RUNS, "method string, workers int, time string")
    return runs_from_text(df).select("method", "workers", F.col("seconds"))
