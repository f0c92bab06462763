"""Registered queries: each operator over its whole table.

Every query is a thin application of one operator with production parameters;
digest columns are derived from the operator's real output here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (hard_negatives, merkle, near_dedup, packing, pii, quality_rules, secrets, sentencepiece_unigram,
               sharding, spherical_caps, suffix_dedup, toxicity, winnowing)
from .common import documents, stored


def op1_winnowing(spark, sf_dir):
    rows = winnowing.fingerprints(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        winnowing.as_string(F.col("fp")).alias("fingerprint"),
        winnowing.as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        winnowing.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op2_markov_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(docs))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.as_string(base), 256).alias("base_sha256"),
        secrets.as_string(F.col("spans")).alias("spans"), count(3).alias("n_random"))


def op3_odd_sketches(spark, sf_dir):
    return near_dedup.classes(documents(spark, sf_dir))


def op4_prefix_free_parsing(spark, sf_dir):
    rows = suffix_dedup.judge(documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op5_virtual_slots(spark, sf_dir):
    docs = documents(spark, sf_dir)
    records = docs.select("doc_id", sharding.record_size(F.col("text")).alias("size"),
                          sharding.text_crc(F.col("text")).alias("text_crc32"))
    maps = f"{ensure_checkpoint_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    return sharding.place(records, maps).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op6_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept",
                         F.array_join("failed_rules", ",").alias("failed_rules"))


def op7_sentencepiece(spark, sf_dir, vocabulary=None):
    path = vocabulary or sentencepiece_unigram.vocabulary_path()
    model = sentencepiece_unigram.build(sentencepiece_unigram.read_vocabulary(path))
    coded = sentencepiece_unigram.encode(documents(spark, sf_dir), model)
    back = sentencepiece_unigram.decode(coded, model)
    least, most = int(model["byte_ids"].min()), int(model["byte_ids"].max())
    return back.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.size(F.filter("ids", lambda i: i.between(least, most))).cast("long").alias("n_byte_tokens"),
        F.xxhash64("ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


def op9_compression_distance(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_boosted_pii(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = pii.scan(docs, pii.train(docs))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 4)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])],
        F.sha2(pii.as_string(base), 256).alias("base_sha256"),
        pii.as_string(F.col("spans")).alias("spans"), count(4).alias("n_other"))


def op11_hard_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    return hard_negatives.mine(rows, F.col("id") % 50 == 0).drop("positive_rank")


def op12_octopus_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*merkle.FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = {"n_chars": F.when(hit, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))}
    placed = stored(merkle.leaves(docs, claim=tampered), "leaves")
    rows = merkle.prove(placed, *merkle.manifest(placed)).withColumn("folded_root", merkle.fold(F.col("claim")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_spherical_caps(spark, sf_dir):
    return spherical_caps.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_markov_secrets": op2_markov_secrets,
    "op3_odd_sketches": op3_odd_sketches,
    "op4_prefix_free_parsing": op4_prefix_free_parsing,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_compression_distance": op9_compression_distance,
    "op10_boosted_pii": op10_boosted_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_octopus_manifest": op12_octopus_manifest,
    "op13_spherical_caps": op13_spherical_caps,
}
