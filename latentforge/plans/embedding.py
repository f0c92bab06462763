"""L2 — embedding jobs: images → latents, captions → text features.

Both are narrow per-row jobs: no shuffle except an optional
``repartition(n)`` to spread a small input over the cluster before the
Python stage.  Columns are pruned before ``mapInPandas`` (the whole child
row is shipped to Python), results are written once, and the summary is
computed from the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import diffusion as dd
from ..operators import filters as flt
from ..operators import image as im
from ..operators import inference as inf
from ..sources import sinks


def embed_images_job(records: DataFrame, key: str, pixels: str, h: str, w: str, c: str,
                     out_path: str | None = None, limit: int | None = None, order=None,
                     target: int = 512, make_encoder=None, seed: int = 0, factor: int = 8,
                     batch_size: int = 8) -> DataFrame:
    """Prefix (F4) → letterbox/normalise + encode in one Python stage (P7+E5,
    error rows instead of failures) → sample the latent (D2) → write (S5).

    Only latents leave the Python stage; the 3 MiB pixel tensors stay inside
    it.  Returns the written result table.
    """
    r = flt.take_prefix(records.select(key, pixels, h, w, c), limit, order or [key])
    enc = im.prepare_and_encode(r, key, pixels, h, w, c, target, target, make_encoder, factor, batch_size)
    res = enc.select(key, "status", "error_message",
                     F.when(F.col("status") == "success",
                            dd.latent_sample("mean", "logvar", F.col(key), seed)).alias("embedding"))
    if out_path:
        sinks.write_records(res, out_path)
        res = res.sparkSession.read.parquet(out_path)
    return res


def embed_captions_job(results: DataFrame, key: str, caption: str, embedding: str | None = None,
                       out_path: str | None = None, make_encoder=None, dim: int = 64,
                       batch_size: int = 32) -> DataFrame:
    """Successful image rows only (F5) → tokenise/pad/mask (E1/E2) → pooled
    text features (E3) → bundle (S6)."""
    ok = results.where(F.col("status") == "success") if "status" in results.columns else results
    t = ok.withColumn("_tok", inf.tokenize_pad(caption))
    t = inf.embed_text(t, caption, "text_embedding", make_encoder, batch_size, dim)
    b = t.select(F.col(key), F.col(embedding).alias("image_embedding") if embedding else F.lit(None)
                 .cast("array<float>").alias("image_embedding"),
                 "text_embedding", F.col("_tok.attention_mask").alias("attention_mask"),
                 F.col(caption).alias("caption"))
    if out_path:
        sinks.write_bundle(b, out_path)
    return b


def summary(results: DataFrame, seconds: float) -> DataFrame:
    """A8 over a written result table."""
    return agg.processing_summary(results, seconds)
