"""Diffusion data operators (D1–D14): schedules, noising, denoising steps.

Latents are flat ``array<float>`` columns (shape kept as metadata, no batch
dimension).  Element-wise math is written with ``transform``/``zip_with``
(JVM, no Python); randomness is the key-hashed generator of
:mod:`functions.rand`, so a recomputed partition reproduces its noise.
The schedule has T rows and is the only broadcast side.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import rand
from ..functions.arrays import clamp, clamp_value
from ..functions.text import col_
from .joins import lookup_schedule
from .parallel import spread
from .windows import _cumulative_product

LATENT_SCALE = 0.18215


def schedule_params(T: int = 1000, b0: float = 1e-4, b1: float = 0.02):
    """β_t = b0 + t·step with step = (b1-b0)/(T-1): both ends included."""
    step = (b1 - b0) / (T - 1) if T > 1 else 0.0
    return b0, step


def noise_schedule(spark: SparkSession, T: int = 1000, b0: float = 1e-4, b1: float = 0.02) -> DataFrame:
    """(t, beta, alpha, alpha_cumprod, sqrt_alpha_cumprod, sqrt_one_minus).

    ᾱ is the running product of α (W2) — a window over T rows, which is a
    fixed, small table.
    """
    b0, step = schedule_params(T, b0, b1)
    base = spark.range(T).select(F.col("id").cast("int").alias("t"))
    beta = F.lit(b0) + F.col("t") * F.lit(step)
    s = base.select("t", beta.alias("beta"), (F.lit(1.0) - beta).alias("alpha"))
    s = _cumulative_product(s, "alpha", ["t"], out="alpha_cumprod")
    return s.select("t", "beta", "alpha", "alpha_cumprod",
                    F.sqrt("alpha_cumprod").alias("sqrt_alpha_cumprod"),
                    F.sqrt(F.lit(1.0) - F.col("alpha_cumprod")).alias("sqrt_one_minus"))


def schedule_array(T: int = 1000, b0: float = 1e-4, b1: float = 0.02) -> np.ndarray:
    """ᾱ as a NumPy vector, multiplied in the same order as the window does."""
    b0, step = schedule_params(T, b0, b1)
    out = np.empty(T)
    acc = 1.0
    for t in range(T):
        acc = acc * (1.0 - (b0 + t * step))
        out[t] = acc
    return out


def latent_sample(mean, logvar, key, seed: int) -> Column:
    """Mean + exp(logvar/2)·ε with ε drawn per (seed, key, element).

    The two arrays are zipped once (not indexed inside the lambda, which
    would re-evaluate a computed input for every element)."""
    z = F.arrays_zip(col_(mean).alias("m"), col_(logvar).alias("lv"))
    noise = F.when(F.size(z) > 0, rand.normal_array(seed, key, F.size(z)))
    return F.when(F.size(z) == 0, F.array().cast("array<double>")).otherwise(F.zip_with(
        z, noise, lambda e, n: e["m"] + F.exp(e["lv"] * F.lit(0.5)) * n))


def scale_latents(arr, factor: float = LATENT_SCALE) -> Column:
    """D3, encode direction."""
    return F.transform(col_(arr), lambda v: v * F.lit(factor))


def unscale_latents(arr, factor: float = LATENT_SCALE) -> Column:
    """D3, decode direction."""
    return F.transform(col_(arr), lambda v: v / F.lit(factor))


def draw_timesteps(key, T: int = 1000, seed: int = 0) -> Column:
    """Uniform integer in [0, T) per row."""
    return rand.randint(seed, key, T)


def add_noise(x, noise, sqrt_ab, sqrt_one_minus) -> Column:
    """√ᾱ_t·x + √(1-ᾱ_t)·ε."""
    sa, so = col_(sqrt_ab), col_(sqrt_one_minus)
    return F.zip_with(col_(x), col_(noise), lambda a, n: sa * a + so * n)


def remove_noise(x, pred, sqrt_ab, sqrt_one_minus) -> Column:
    """(x - √(1-ᾱ_t)·ε̂) / √ᾱ_t — the inverse of D5 for ε̂ = ε."""
    sa, so = col_(sqrt_ab), col_(sqrt_one_minus)
    return F.zip_with(col_(x), col_(pred), lambda a, p: (a - so * p) / sa)


def noise_like(arr, key, seed: int, bound: float | None = None) -> Column:
    """Standard normal array of the same length (optionally clamped)."""
    n = rand.normal_array(seed, key, F.size(col_(arr)))
    return clamp(n, -bound, bound) if bound else n


def guidance(uncond, text, scale: float, bound: float = 10.0) -> Column:
    """U + s·(t − u), clamped, when s > 1; else the text prediction."""
    if scale <= 1.0:
        return col_(text)
    return F.zip_with(col_(uncond), col_(text),
                      lambda u, t: clamp_value(u + F.lit(float(scale)) * (t - u), -bound, bound))


def ddim_step(x, eps, abar_t, abar_prev, bound: float = 10.0) -> Column:
    """x̂₀ = clamp((x − √(1−ᾱ_t)·ε)/√ᾱ_t); x' = clamp(√ᾱ_prev·x̂₀ + √(1−ᾱ_prev)·ε)."""
    at, ap = col_(abar_t), col_(abar_prev)

    def step(a, e):
        x0 = clamp_value((a - F.sqrt(F.lit(1.0) - at) * e) / F.sqrt(at), -bound, bound)
        return clamp_value(F.sqrt(ap) * x0 + F.sqrt(F.lit(1.0) - ap) * e, -bound, bound)

    return F.zip_with(col_(x), col_(eps), step)


def timestep_grid(n: int, T: int = 1000) -> list:
    """``linspace(T-1, 0, n)`` truncated to int (n = 1 gives T-1)."""
    if n <= 1:
        return [T - 1]
    step = (0.0 - (T - 1)) / (n - 1)
    return [int((T - 1) + k * step) for k in range(n)]


def grid_frame(spark: SparkSession, n: int, T: int = 1000) -> DataFrame:
    """D11 as a table of (k, t)."""
    return spark.createDataFrame([(k, t) for k, t in enumerate(timestep_grid(n, T))], "k int, t int")


def _grid_with_abar(steps: int, T: int, prev: str):
    ab = schedule_array(T)
    grid = timestep_grid(steps, T)
    out = []
    for k, t in enumerate(grid):
        if prev == "grid":
            ap = ab[grid[k + 1]] if k + 1 < len(grid) else 1.0
        else:  # original: ᾱ at t−1 (1 at t = 0)
            ap = ab[t - 1] if t > 0 else 1.0
        out.append((t, float(ab[t]), float(ap)))
    return out


def denoise_linear(df: DataFrame, key: str, seed: int, dim: int, steps: int = 50,
                   uncond_coef: float = 0.1, text_coef: float = 0.2, scale: float = 2.0,
                   T: int = 1000, prev: str = "t-1", bound: float = 10.0,
                   decode: bool = True) -> DataFrame:
    """D10 with a closed-form (linear) predictor: ε̂ = c·x per branch.

    The loop is one ``aggregate`` over the grid (an array of (t, ᾱ_t, ᾱ_prev)
    literals computed from the schedule parameters), so the plan has the
    same size for 3 or 1000 steps and the whole loop runs in the JVM.
    """
    grid = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(a).alias("at"), F.lit(p).alias("ap"))
                     for t, a, p in _grid_with_abar(steps, T, prev)])
    x0 = clamp(rand.normal_array(seed, F.col(key), dim), -bound, bound)

    def one(acc, g):
        inp = clamp(acc, -bound, bound)
        u = F.transform(inp, lambda v: clamp_value(v * F.lit(uncond_coef), -bound, bound))
        t = F.transform(inp, lambda v: clamp_value(v * F.lit(text_coef), -bound, bound))
        eps = guidance(u, t, scale, bound)
        return ddim_step(acc, eps, g["at"], g["ap"], bound)

    x = F.aggregate(grid, x0, one)
    out = unscale_latents(clamp(x, -bound, bound)) if decode else x
    return spread(df.select(key)).select(key, out.alias("sample"))


LOOP_VALUES = 1 << 18      # numbers in the latents and features that a worker's loop holds


def _loop_rows(context, start: int, dim: int) -> int:
    """Rows from ``start`` on, with the features ``context`` (None: without),
    that hold ``LOOP_VALUES`` numbers; one at least."""
    if context is None:
        return max(1, LOOP_VALUES // max(dim, 1))
    held, n = 0, 0
    for k in range(start, len(context)):
        m = context[k].values           # the row's tokens, not taken out of Arrow
        held += dim + (0 if m is None else len(m.flatten()))
        if n and held > LOOP_VALUES:
            break
        n += 1
    return n


def denoise_numpy(df: DataFrame, key: str, seed: int, dim: int, predictor, steps: int = 50,
                  scale: float = 2.0, T: int = 1000, prev: str = "t-1", bound: float = 10.0,
                  decode: bool = True, context: str | None = None) -> DataFrame:
    """D10 with a Python predictor: the whole loop runs inside one
    ``mapInArrow`` task per partition, batch by batch (never one column
    expression per step).  ``predictor(x, t) -> (uncond, text)`` works on a
    (rows, dim) NumPy matrix.  Starting noise comes from the same key-hashed
    generator as the column path, computed in Spark before the Python stage.
    With ``context``, a column of per-token features, the predictor is called
    as ``predictor(x, t, context)`` at every step, with a list of one
    (tokens, features) matrix for each row.  The loop takes as many rows at a
    time as hold ``LOOP_VALUES`` numbers, in the latent and the features, and
    at least one: neither the matrices
    of a step nor the objects made of a batch grow with the Arrow batch.
    """
    grid = _grid_with_abar(steps, T, prev)
    more = [] if context is None else [context]
    start = spread(df.select(key, *more)).select(F.col(key).alias("key"),
                      clamp(rand.normal_array(seed, F.col(key), dim), -bound, bound).alias("x"),
                      *[F.col(c).alias("context") for c in more])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            context, start = batch.column("context") if more else None, 0
            while start < batch.num_rows:
                part = batch.slice(start, _loop_rows(context, start, dim))
                start += part.num_rows
                x = np.stack(part.column("x").to_pandas()).astype(np.float64)
                extra = [[np.stack(list(m)) for m in part.column("context").to_pandas()]] if more else []
                for t, at, ap in grid:
                    inp = np.clip(x, -bound, bound)
                    u, tx = predictor(inp, t, *extra)
                    u, tx = np.clip(u, -bound, bound), np.clip(tx, -bound, bound)
                    eps = np.clip(u + scale * (tx - u), -bound, bound) if scale > 1.0 else tx
                    x0 = np.clip((x - math.sqrt(1.0 - at) * eps) / math.sqrt(at), -bound, bound)
                    x = np.clip(math.sqrt(ap) * x0 + math.sqrt(1.0 - ap) * eps, -bound, bound)
                out = np.clip(x, -bound, bound) / LATENT_SCALE if decode else x
                sample = pa.array(list(out), pa.list_(pa.float64()), from_pandas=True)
                yield pa.RecordBatch.from_arrays([part.column("key"), sample], names=["key", "sample"])

    schema = Ty.StructType([Ty.StructField("key", df.schema[key].dataType),
                            Ty.StructField("sample", Ty.ArrayType(Ty.DoubleType()))])
    return start.mapInArrow(run, schema).withColumnRenamed("key", key)


def sinusoidal_embedding(t, dim: int = 256) -> Column:
    """[sin(t·fᵢ)…, cos(t·fᵢ)…] with fᵢ = exp(−i·ln(10000)/(half−1))."""
    half = dim // 2
    c = math.log(10000) / (half - 1)
    t = col_(t).cast("double")
    idx = F.sequence(F.lit(0), F.lit(half - 1))
    freq = lambda i: F.exp(i.cast("double") * F.lit(-c))
    return F.concat(F.transform(idx, lambda i: F.sin(t * freq(i))),
                    F.transform(idx, lambda i: F.cos(t * freq(i))))


def training_pairs(samples: DataFrame, schedule: DataFrame, key: str, x: str, seed: int,
                   T: int = 1000, extra=()) -> DataFrame:
    """Per sample a timestep, the noise, the noised latent and the
    target (= the noise) — the table a trainer consumes.

    ``seed`` should include the epoch so each epoch draws anew.
    """
    s = spread(samples.select(F.col(key), F.col(x), *extra)).select(
        F.col(key), F.col(x), *extra, draw_timesteps(F.col(key), T, seed).alias("t"))
    j = lookup_schedule(s, schedule.select("t", "sqrt_alpha_cumprod", "sqrt_one_minus"), "t",
                        schedule_rows=T)
    noise = noise_like(x, F.col(key), seed)
    return j.select(key, "t", *extra, noise.alias("target"), x, "sqrt_alpha_cumprod", "sqrt_one_minus") \
        .select(key, "t", *extra,
                add_noise(x, "target", "sqrt_alpha_cumprod", "sqrt_one_minus").alias("noisy"), "target")
