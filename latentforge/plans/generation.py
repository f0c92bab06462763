"""L4 — sampling many prompts in parallel.

prompts → tokens (E1) → per-token features (E6) → denoising loop (D10,
inside one Python stage per partition, or as one ``aggregate`` for a
closed-form predictor) → decode scaling (D3) → pixels (P10) → files (S8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import diffusion as dd
from ..operators import image as im
from ..operators import inference as inf
from ..sources import images as files


def generate(prompts: DataFrame, key: str, text: str, predictor, steps: int = 50, scale: float = 2.0,
             seed: int = 0, latent_shape=(4, 64, 64), to_pixels: bool = True) -> DataFrame:
    """One row per prompt with the sampled latent (and pixels when the
    latent has an image shape).  ``predictor(x, t, context)`` gets the prompts'
    per-token features at every step; a missing prompt is an empty one."""
    c, h, w = latent_shape
    dim = c * h * w
    toks = prompts.select(key, inf.tokenize_pad(tx.default_text(text, "")).alias("tok"))
    emb = inf.prompt_embedding(toks.select(key, F.col("tok.tokens").alias("tokens")), key, "tokens")
    out = dd.denoise_numpy(emb, key, seed, dim, predictor, steps, scale, context="hidden")
    if to_pixels:
        out = out.withColumn("pixels", im.denormalize_pixels(
            F.transform("sample", lambda v: v * F.lit(dd.LATENT_SCALE)), c, h, w))
    return out


def generate_files(prompts: DataFrame, key: str, text: str, predictor, out_dir: str, latent_shape=(4, 64, 64),
                   encoder=files.encode_raw, suffix: str = ".raw", overwrite: bool = False, **options) -> None:
    """L4 to its end: the sampled images as files, one for each prompt, named
    by its key.  The folder appears whole when all images are written."""
    c, h, w = latent_shape
    made = generate(prompts, key, text, predictor, latent_shape=latent_shape, **options).select(
        key, "pixels", F.lit(h).alias("h"), F.lit(w).alias("w"), F.lit(c).alias("c"))
    files.write_image_files(made, key, "pixels", "h", "w", "c", out_dir, encoder, suffix, overwrite)
