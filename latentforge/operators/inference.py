"""Text preparation and batched model inference.

Models are plug-ins: a *factory* that builds a NumPy-in/NumPy-out callable.
It is loaded lazily once per Python worker (E7) and applied to Arrow
batches (``predict_batch_udf`` / ``mapInPandas``), never row by row from
the JVM.  The stand-in encoders here (feature hashing, average pooling)
are small and deterministic so results can be checked against SQL.
"""

import hashlib
import os
import threading
import uuid
from collections import OrderedDict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import text as tx
from .parallel import spread

BOS, EOS, PAD = "<s>", "</s>", "<pad>"


# ------------------------------------------------------------------ E1/E2 --

def tokenize_pad(text, max_len: int = 77, bos: str = BOS, eos: str = EOS, pad: str = PAD) -> Column:
    """E1+E2: struct(tokens, attention_mask, length).

    Built-in tokenizer: lower-case, split on non-word characters, add the
    begin/end markers, truncate to ``max_len`` keeping the end marker, pad.
    The mask has 1 for real tokens (markers included) and 0 for padding.
    """
    words = tx.tokens(F.lower(tx.col_(text)))
    body = F.slice(words, 1, max_len - 2)
    toks = F.concat(F.array(F.lit(bos)), body, F.array(F.lit(eos)))
    n = F.size(toks)
    padded = F.concat(toks, F.array_repeat(F.lit(pad), F.lit(max_len) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
    return F.struct(padded.alias("tokens"), mask.alias("attention_mask"), n.alias("length"))


# ------------------------------------------------------------------- E7 --

MAX_MODELS = 4                 # models that one Python worker holds at a time

_MODELS: OrderedDict = OrderedDict()
_LOADS: dict = {}
_LOCK = threading.Lock()


def model_key(kind: str, make=None, *params) -> str:
    """Name of a model for :func:`lazy_model`, made on the driver when an
    operator is built and shipped to the workers as a string.

    A built-in model is named by its kind and parameters, so equal settings
    share it; a caller's factory gets a name of its own for each operator.
    """
    return f"{kind}:{params!r}" if make is None else f"{kind}:{uuid.uuid4().hex}"


def lazy_model(name: str, factory):
    """The model named ``name``, built by ``factory()`` on first use in
    this Python worker and reused by every later batch and task.  The least
    recently used model goes when a worker holds ``MAX_MODELS``."""
    with _LOCK:
        if name not in _MODELS:
            _MODELS[name] = factory()
            _LOADS[name] = _LOADS.get(name, 0) + 1
            while len(_MODELS) > MAX_MODELS:
                _MODELS.popitem(last=False)
        _MODELS.move_to_end(name)
        return _MODELS[name]


def load_count(name: str) -> int:
    return _LOADS.get(name, 0)


# ------------------------------------------------------ stand-in encoders --

def _word_split():
    import regex

    return regex.compile(r"[^\p{L}\p{N}_]+")


def token_bucket(token: str, dim: int):
    """(bucket, sign) of a token: first 32 bits of md5 mod dim; sign from the
    next byte's parity."""
    h = hashlib.md5(token.encode("utf-8")).hexdigest()
    return int(h[:8], 16) % dim, (1.0 if int(h[8:10], 16) % 2 == 0 else -1.0)


class HashTextEncoder:
    """Signed feature hashing of the words of a text, L2-normalised — an
    offline stand-in for a pooled text encoder (E3/E4)."""

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.split = _word_split()
        self.cache: dict = {}

    def _bucket(self, w):
        b = self.cache.get(w)
        if b is None:
            b = token_bucket(w, self.dim)
            if len(self.cache) < 1_000_000:
                self.cache[w] = b
        return b

    def __call__(self, texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for r, t in enumerate(texts):
            if t is None:
                continue
            for w in self.split.split(str(t).lower()):
                if w:
                    b, s = self._bucket(w)
                    out[r, b] += s
        norm = np.sqrt((out ** 2).sum(axis=1, keepdims=True))
        return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def truncated_text(text, max_len: int = 77) -> Column:
    """The words of a text that :func:`tokenize_pad` keeps, joined by spaces."""
    return F.array_join(F.slice(tx.tokens(F.lower(tx.col_(text))), 1, max_len - 2), " ")


def embed_text(df: DataFrame, text_col: str, out_col: str = "text_embedding",
               make_encoder=None, batch_size: int = 32, dim: int = 64, max_len: int | None = 77) -> DataFrame:
    """Batched pooled text features with ``predict_batch_udf``.

    ``make_encoder()`` returns ``f(np.ndarray[str]) -> np.ndarray[rows, d]``;
    it is called once per Python worker.  Default: :class:`HashTextEncoder`.
    The encoder gets the tokens that E1 keeps within ``max_len`` (None: the
    whole text).
    """
    from pyspark.ml.functions import predict_batch_udf

    make = make_encoder or (lambda: HashTextEncoder(dim))

    def make_predict_fn():          # kept per worker by predict_batch_udf itself
        enc = make()

        def predict(texts: np.ndarray) -> np.ndarray:
            return enc(texts)

        return predict

    udf = predict_batch_udf(make_predict_fn, return_type=Ty.ArrayType(Ty.DoubleType()), batch_size=batch_size)
    text = F.col(text_col) if max_len is None else truncated_text(text_col, max_len)
    return spread(df).withColumn(out_col, udf(text))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hashed_sums(tokens: Column, dim: int) -> Column:
    """Signed sums of hashed tokens as an array of ``dim`` longs, in the row.

    A token's code is twice its bucket, plus one for a negative sign.  The
    codes are sorted together with one of each kind, so that the place where
    each code starts follows from one pass, and with it every count.
    """
    def code(h: Column) -> Column:
        bucket = F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % dim
        return (2 * bucket + F.conv(F.substring(h, 9, 2), 16, 10).cast("int") % 2).cast("int")
    codes = F.transform(tokens, lambda w: _bound(F.md5(w), code))

    def counts(c: Column) -> Column:
        starts = F.filter(F.transform(c, lambda x, i: F.when((i == 0) | (x != F.get(c, i - 1)), i)),
                          lambda i: i.isNotNull())
        return _bound(starts, lambda s: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: (
            2 * F.get(s, 2 * j + 1) - F.get(s, 2 * j) - F.get(s, 2 * j + 2)).cast("long")))
    return _bound(F.sort_array(F.concat(codes, F.sequence(F.lit(0), F.lit(2 * dim)))), counts)


def hash_embed(df: DataFrame, key: str, text_col: str, dim: int = 64) -> DataFrame:
    """The same feature hashing as :class:`HashTextEncoder` in column
    functions: words → (bucket, sign) from md5 → signed sums in a fixed array
    of the row → L2 norm.  Nothing is exploded but the result, and nothing is
    shuffled.  Returns sparse rows (key, bucket, value) for non-zero buckets.
    """
    def entries(sums: Column) -> Column:
        norm = F.sqrt(F.aggregate(sums, F.lit(0.0), lambda a, s: a + s.cast("double") * s))
        return _bound(norm, lambda n: F.filter(F.transform(sums, lambda s, j: F.struct(
            j.cast("int").alias("bucket"), F.try_divide(s, n).alias("value"))), lambda e: e["value"] != 0))
    rows = spread(df.select(key, text_col)).select(
        F.col(key), F.explode(_bound(hashed_sums(tx.tokens(F.lower(F.col(text_col))), dim), entries)).alias("e"))
    return rows.select(key, "e.bucket", "e.value")


def dense_from_sparse(sparse: DataFrame, key: str, dim: int, index: str = "bucket",
                      value: str = "value", out: str = "embedding") -> DataFrame:
    """Dense ``array<double>`` per key from (key, index, value) rows; groups
    are bounded by ``dim``."""
    m = sparse.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(index, value))).alias("_m"))
    return m.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                                     lambda i: F.coalesce(F.col("_m")[i], F.lit(0.0))).alias(out))


class PoolImageEncoder:
    """Stand-in for a VAE encoder: ``factor``×``factor`` average pooling per
    channel of a CHW tensor gives the mean; the log-variance is constant."""

    def __init__(self, c: int, h: int, w: int, logvar: float = -4.0, factor: int = 2):
        self.shape, self.logvar, self.f = (c, h, w), logvar, factor

    def __call__(self, x: np.ndarray):
        c, h, w = self.shape
        f = self.f
        t = x.reshape(len(x), c, h // f, f, w // f, f)
        mean = t.mean(axis=(3, 5)).reshape(len(x), -1)
        return mean, np.full_like(mean, self.logvar)


def embed_images(df: DataFrame, key: str, tensor: str, shape, make_encoder=None,
                 batch_size: int = 8) -> DataFrame:
    """E5 (+E8): encoder over batches of image tensors → (key, status,
    error_message, mean, logvar); a failing batch is retried row by row so
    that every input row gets exactly one output row."""
    make = make_encoder or (lambda: PoolImageEncoder(*shape))
    name = model_key("image-encoder", make_encoder, *shape)

    def fn(batch: np.ndarray):
        enc = lazy_model(name, make)
        mean, logvar = enc(batch)
        return [(m, lv) for m, lv in zip(mean, logvar)]

    out = Ty.StructType([Ty.StructField("mean", Ty.ArrayType(Ty.DoubleType())),
                         Ty.StructField("logvar", Ty.ArrayType(Ty.DoubleType()))])
    r = safe_map(df, fn, [key], tensor, out, batch_size=batch_size, stack=True)
    return r.select(key, "status", "error_message", F.col("result.mean").alias("mean"),
                    F.col("result.logvar").alias("logvar"))


class HashTokenEncoder:
    """Stand-in for per-token hidden states: one signed one-hot of size
    ``dim`` per token (E6)."""

    def __init__(self, dim: int = 16):
        self.dim = dim

    def __call__(self, tokens) -> list:
        out = []
        for toks in tokens:
            m = np.zeros((len(toks), self.dim))
            for j, t in enumerate(toks):
                b, s = token_bucket(t, self.dim)
                m[j, b] = s
            out.append(m)
        return out


ENCODE_ROWS = 128              # rows whose hidden states a worker holds


def prompt_embedding(df: DataFrame, key: str, tokens: str, make_encoder=None, dim: int = 16,
                     out_col: str = "hidden") -> DataFrame:
    """Per-token hidden states (tokens × dim), not pooled.

    The encoder gets ``ENCODE_ROWS`` rows at a time, whatever the size of an
    Arrow batch, and their states are one output frame: a worker holds the
    hidden states of so many rows only.
    """
    make = make_encoder or (lambda: HashTokenEncoder(dim))
    name = model_key("token-encoder", make_encoder, dim)
    src = spread(df.select(F.col(key).alias("key"), F.col(tokens).alias("tokens")))

    def run(batches):
        for pdf in batches:
            enc = lazy_model(name, make)
            for start in range(0, len(pdf), ENCODE_ROWS):
                part = pdf.iloc[start:start + ENCODE_ROWS]
                hs = enc(list(part["tokens"]))
                yield pd.DataFrame({"key": part["key"], out_col: [[list(r) for r in m] for m in hs]})

    schema = Ty.StructType([Ty.StructField("key", df.schema[key].dataType),
                            Ty.StructField(out_col, Ty.ArrayType(Ty.ArrayType(Ty.DoubleType())))])
    return src.mapInPandas(run, schema).withColumnRenamed("key", key)


# ------------------------------------------------------------------- E8 --

FRAME_ROWS = 4096              # rows of an output frame
FRAME_VALUES = 1 << 18         # numbers and characters in its results


def n_values(result) -> int:
    """Numbers and characters that a result holds."""
    if isinstance(result, np.ndarray):
        return result.size if result.dtype != object else sum(n_values(v) for v in result.ravel())
    if isinstance(result, (str, bytes, bytearray)):
        return len(result)
    if isinstance(result, dict):
        return sum(n_values(v) for v in result.values())
    if isinstance(result, (list, tuple)):
        return sum(n_values(v) for v in result)
    return 1


def safe_map(df: DataFrame, fn, keys, value_col: str, result_type: Ty.DataType,
             batch_size: int = 32, stack: bool = False) -> DataFrame:
    """Apply ``fn`` to batches of ``value_col`` with error isolation.

    ``fn(values) -> list`` gets a list (or a stacked NumPy array with
    ``stack=True``) and returns one result per value.  If a batch raises, the
    batch is retried value by value; a value that still raises becomes an
    error row.  Output: keys, ``status``, ``error_message``, ``result`` —
    exactly one row per input row, keys carried through (no positional
    re-zipping).  Errors that kill the Python worker stay Spark task retries.

    An output frame holds the rows of many batches: up to ``FRAME_ROWS`` rows,
    and for results of varying size up to ``FRAME_VALUES`` values and the
    batch that passes them.
    """
    keys = list(keys)
    src = spread(df.select(*[F.col(k) for k in keys], F.col(value_col).alias("_v")))
    schema = Ty.StructType([*[df.schema[k] for k in keys],
                            Ty.StructField("status", Ty.StringType()),
                            Ty.StructField("error_message", Ty.StringType()),
                            Ty.StructField("result", result_type)])
    fixed = isinstance(result_type, (Ty.NumericType, Ty.BooleanType, Ty.DatetimeType))
    # integers beside a missing result would become floats
    dtype = object if isinstance(result_type, Ty.IntegralType) else None

    def call(vals):
        arg = np.stack([np.asarray(v, dtype=np.float64) for v in vals]) if stack else list(vals)
        res = list(fn(arg))
        if len(res) != len(vals):
            raise ValueError(f"{len(res)} results for {len(vals)} inputs")
        return res

    def run(batches):
        for pdf in batches:
            vals = list(pdf["_v"])
            begin, held = 0, 0
            status, errors, results = [], [], []
            for start in range(0, len(vals), batch_size):
                chunk = vals[start:start + batch_size]
                try:
                    res = call(chunk)
                    status += ["success"] * len(chunk)
                    errors += [None] * len(chunk)
                    results += res
                except Exception:
                    for v in chunk:
                        try:
                            results.append(call([v])[0])
                            status.append("success")
                            errors.append(None)
                        except Exception as e:
                            results.append(None)
                            status.append("error")
                            errors.append(f"{type(e).__name__}: {e}")
                            held += len(errors[-1])
                end = start + len(chunk)
                if not fixed:
                    held += sum(n_values(r) for r in results[start - begin:])
                if end == len(vals) or end - begin >= FRAME_ROWS or held >= FRAME_VALUES:
                    out = pdf[keys].iloc[begin:end].copy()
                    out["status"], out["error_message"] = status, errors
                    out["result"] = pd.Series(results, index=out.index, dtype=dtype)
                    yield out
                    begin, held = end, 0
                    status, errors, results = [], [], []

    return src.mapInPandas(run, schema)
