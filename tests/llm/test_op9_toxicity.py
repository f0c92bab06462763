import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.llm import toxicity as tx
from latentforge.llm.queries import QUERIES

BIG = "/root/testdata/sf0.1"


def test_held_out_precision_and_recall(spark):
    got = QUERIES["op9_compression_distance"](spark, BIG).toPandas()
    docs = spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert len(got) == docs and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    labels = spark.read.parquet(f"{BIG}/labels.parquet").toPandas()
    m = got[got.held_out].merge(labels, on="doc_id")
    hit = int(((m.predicted == 1) & (m.toxic == 1)).sum())
    assert hit / m.predicted.sum() >= 0.9 and hit / (m.toxic == 1).sum() >= 0.85


def test_held_out_labels_have_no_influence(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.train(docs, labels) == tx.train(docs, turned)


def test_odd_texts_and_equal_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = tx.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "idiot"), (5, "x" * 600_000), (6, "a b " * 200_000), (7, "é"), (8, "é")]
    got = [tuple(r) for r in tx.score(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS score", "2 AS figures"), model).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == by[2] == by[3] and by[7] == by[8] and all(0 <= s <= 1 for _, s in got)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (3, 1)], [(None, 1), (1, None)]])
def test_missing_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (3, "b")], "doc_id long, text string")
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in tx.score(docs, model).collect()} == {1.0 if len(labels) == 2 and labels[0] == (1, 1) else 0.0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tx.score(docs, tx.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))).count() == 0


def test_codes_do_not_depend_on_chunks():
    text = (b"thus the words of this text go on, and on! " * 9000)
    whole = tx.codes(text)
    cut = np.concatenate([tx.codes(text[:43 * 100]), tx.codes(text[43 * 100:])])
    assert (whole == cut).all()
