"""Reading the input tables (S3).

Tables are Parquet; selecting columns right at the read lets the scan prune
to exactly those columns (``ReadSchema`` in the plan), and filters written
afterwards are pushed into the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in sf_dir else os.path.join(sf_dir, name)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_records(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """S3: a record file is a Parquet dataset (pickles are not read)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
