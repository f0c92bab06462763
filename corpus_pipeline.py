"""Cleaning and packing a corpus: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's
input.  All but the last return the columns of ``documents``.

Defined results: null and empty texts, and texts without words, fail the
quality rules and go.  Rows without an id are kept as they are by the near
duplicates and come first where ids order rows; rows that share an id are one
document to the near duplicates and are kept or dropped together, and rows of
their own to the other stages.  Extra columns are carried along under any
name up to the packing, which has columns of its own.  An empty table gives an
empty result.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from latentforge.llm import near_dedup, packing, quality_rules, secrets, suffix_dedup  # noqa: E402
from latentforge.session import ensure_checkpoint_dir, ship_package  # noqa: E402


LINK = 80                 # percent of the union of two documents' shingles that makes them near duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    ship_package(spark)
    return near_dedup.dedup(docs, link=LINK)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that occur earlier."""
    ship_package(spark)
    return suffix_dedup.strip(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced by a mark."""
    redacted = secrets.redact(docs, secrets.train(docs))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in bins of permitted lengths."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("secret_scan", secret_scan),
    ("best_fit_packing", pack),
]

# Neither near-duplicate sketches nor best-fit packing can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last one."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
