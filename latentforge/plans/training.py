"""L3 — training input and loss analysis.

The trainer itself is not part of this library; what it consumes is built
here: samples joined by key (J3, never by position after a drop), a
per-epoch permutation split over ranks (B7), fixed-size batches (B8) and
noised latents with their targets (D14).  The result is written
partitioned by (epoch, rank), so each trainer rank reads only its folder.

Loss logs come back as a table and are analysed with W6, A10 and A16.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import batching as bt
from ..operators import diffusion as dd
from ..operators import filters as flt
from ..operators import windows as win


def training_samples(latents: DataFrame, bundle: DataFrame, key: str, latent: str = "embedding",
                     text: str = "text_embedding", caption: str = "caption") -> DataFrame:
    """Samples for the trainer: each image latent with *its own* caption
    features, joined by key (J3) — the original paired by list position and
    then used a copy of the image embedding as the text input."""
    from ..operators.joins import key_join

    return key_join(latents.select(key, latent), bundle.select(key, text, caption), key)


def training_input(samples: DataFrame, schedule: DataFrame, key: str, latent: str, world: int,
                   epoch: int, batch_size: int = 32, seed: int = 0, extra=()) -> DataFrame:
    """(key, epoch, rank, batch, t, noisy, target, extra…) for one epoch."""
    s = bt.epoch_sampler(samples.select(key, latent, *extra), key, world, epoch, seed)
    b = bt.loader_batches(s, batch_size)
    # the noise stream is keyed differently from the permutation (seed+epoch)
    pairs = dd.training_pairs(b, schedule, key, latent, seed=f"{seed}e{epoch}",
                              extra=["rank", "batch", *extra])
    return pairs.withColumn("epoch", F.lit(epoch))


def write_training_input(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("epoch", "rank").parquet(path)


def loss_report(losses: DataFrame, log_interval: int, save_interval: int, eval_batch: int,
                eval_samples: int):
    """(log lines, checkpoint losses, eval loss per epoch)."""
    logs = win.log_windows(losses, log_interval)
    ckpt = agg.checkpoint_loss(losses, log_interval, save_interval)
    ev = agg.eval_loss(flt.eval_cap(losses, "batch_idx", eval_batch, eval_samples), group_by=["epoch"])
    return logs, ckpt, ev
