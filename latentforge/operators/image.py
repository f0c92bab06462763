"""Image geometry and pixel preparation.

Pixels are flat arrays in row-major HWC order (``h``, ``w``, ``c`` kept as
columns or parameters).  Two equivalent paths:

* column path — index arithmetic in ``transform(sequence(...))``; pure JVM,
  good for small images and as the reference semantics;
* NumPy path (P7) — one ``mapInPandas`` pass per Arrow batch for real image
  sizes (512×512×3), where a per-element lambda would be slow.

Resampling is nearest-neighbour with pixel-centre sampling, in columns and in
P7; :func:`lanczos` and other filters plug into P7 as NumPy functions.  Codecs are not part of this module.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty


def _c(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def letterbox_geometry(w, h, tw: int = 512, th: int = 512) -> Column:
    """struct(scale, new_w, new_h, off_x, off_y, ok).

    scale = min(tw/w, th/h); new = int(dim·scale) (truncated, divide first);
    offset = (target − new) div 2.  ``ok`` is false when a new side is 0 (an
    extreme aspect ratio) or the input size is not positive.
    """
    w, h = _c(w), _c(h)
    valid = (w > 0) & (h > 0)
    scale = F.when(valid, F.least(F.lit(float(tw)) / w, F.lit(float(th)) / h))
    nw = (w * scale).cast("int")
    nh = (h * scale).cast("int")
    return F.struct(scale.alias("scale"), nw.alias("new_w"), nh.alias("new_h"),
                    F.floor((F.lit(tw) - nw) / 2).cast("int").alias("off_x"),
                    F.floor((F.lit(th) - nh) / 2).cast("int").alias("off_y"),
                    (valid & (nw > 0) & (nh > 0)).alias("ok"))


class Img:
    """A lazily composed image: ``at(src, y, x, ch)`` gives the pixel expression.

    Stages (resize, pad, map, channel changes) compose *index maps*; only
    :meth:`hwc` / :meth:`chw` build an array.  The source array is bound
    once per row to a lambda variable, so each output element reads it with
    one ``element_at`` — even when the source is itself a computed array,
    which Catalyst would otherwise inline and re-evaluate per element.
    """

    def __init__(self, h, w, c, at, src):
        self.h, self.w, self.c, self.at, self.src = _c(h), _c(w), _c(c), at, src

    @staticmethod
    def from_hwc(pixels, h, w, c) -> "Img":
        hh, ww, cc = _c(h), _c(w), _c(c)
        return Img(hh, ww, cc, lambda s, y, x, ch: F.element_at(s, ((y * ww + x) * cc + ch + 1).cast("int")),
                   _c(pixels))

    @staticmethod
    def from_chw(pixels, c, h, w) -> "Img":
        hh, ww, cc = _c(h), _c(w), _c(c)
        return Img(hh, ww, cc, lambda s, y, x, ch: F.element_at(s, ((ch * hh + y) * ww + x + 1).cast("int")),
                   _c(pixels))

    def resize(self, new_h, new_w) -> "Img":
        nh, nw, h, w, at = _c(new_h), _c(new_w), self.h, self.w, self.at

        def pick(s, y, x, ch):
            sy = F.least(F.floor((y + F.lit(0.5)) * h / nh), h - 1)
            sx = F.least(F.floor((x + F.lit(0.5)) * w / nw), w - 1)
            return at(s, sy, sx, ch)

        return Img(nh, nw, self.c, pick, self.src)

    def pad(self, th: int, tw: int, off_y, off_x, fill=0) -> "Img":
        oy, ox, h, w, at = _c(off_y), _c(off_x), self.h, self.w, self.at

        def pick(s, y, x, ch):
            inside = (y >= oy) & (y < oy + h) & (x >= ox) & (x < ox + w)
            return F.when(inside, at(s, y - oy, x - ox, ch)).otherwise(F.lit(fill))

        return Img(F.lit(th), F.lit(tw), self.c, pick, self.src)

    def map(self, f) -> "Img":
        at = self.at
        return Img(self.h, self.w, self.c, lambda s, y, x, ch: f(at(s, y, x, ch)), self.src)

    def grey_to_rgb(self) -> "Img":
        at = self.at
        return Img(self.h, self.w, F.lit(3), lambda s, y, x, ch: at(s, y, x, F.lit(0)), self.src)

    def _build(self, index) -> Column:
        h, w, c, at = self.h, self.w, self.c, self.at
        seq = F.sequence(F.lit(0), (h * w * c - 1).cast("int"))
        return F.element_at(F.transform(F.array(self.src),
                                        lambda s: F.transform(seq, lambda k: at(s, *index(k)))), 1)

    def hwc(self) -> Column:
        h, w, c = self.h, self.w, self.c
        return self._build(lambda k: (F.floor(k / (w * c)), F.floor(k / c) % w, k % c))

    def chw(self) -> Column:
        h, w, c = self.h, self.w, self.c
        return self._build(lambda k: (F.floor(k / w) % h, k % w, F.floor(k / (h * w))))


def resize_nearest(pixels, h, w, c, new_h, new_w) -> Column:
    """Nearest-neighbour resize of an HWC array (pixel-centre sampling)."""
    nh, nw = _c(new_h), _c(new_w)
    return F.when((nh > 0) & (nw > 0), Img.from_hwc(pixels, h, w, c).resize(nh, nw).hwc())


def pad_canvas(pixels, h, w, c, th: int, tw: int, off_y, off_x, fill=0) -> Column:
    """Paste an HWC image at (off_y, off_x) on a (th, tw) canvas of ``fill``."""
    return Img.from_hwc(pixels, h, w, c).pad(th, tw, off_y, off_x, fill).hwc()


def _norm(v: Column) -> Column:
    return v / F.lit(127.5) - F.lit(1.0)


def normalize_pixels(pixels) -> Column:
    """x/127.5 − 1 (uint8 range to [-1, 1])."""
    return F.transform(_c(pixels), _norm)


def hwc_to_chw(pixels, h, w, c) -> Column:
    """P5: channel-first order (no batch dimension)."""
    return Img.from_hwc(pixels, h, w, c).chw()


def chw_to_hwc(pixels, c, h, w) -> Column:
    """Inverse of P5."""
    return Img.from_chw(pixels, c, h, w).hwc()


def train_transform(pixels, h, w, c, size: int = 128) -> Column:
    """Resize to size×size ignoring aspect, scale to [0,1], then (x−0.5)/0.5."""
    return Img.from_hwc(pixels, h, w, c).resize(size, size) \
        .map(lambda v: (v / F.lit(255.0) - F.lit(0.5)) / F.lit(0.5)).hwc()


def to_rgb(pixels, mode: str = "L") -> Column:
    """Grey (L) → RGB by repetition; RGBA → RGB by dropping alpha."""
    px = _c(pixels)
    if mode == "L":
        return F.flatten(F.transform(px, lambda v: F.array_repeat(v, 3)))
    if mode == "RGBA":
        return F.filter(px, lambda v, i: i % 4 != 3)
    if mode == "RGB":
        return px
    raise ValueError(f"unsupported mode {mode}")


def image_or_black(pixels, n) -> Column:
    """A missing image becomes n zeros."""
    return F.coalesce(_c(pixels), F.array_repeat(F.lit(0), _c(n).cast("int")))


def _to_uint8(v: Column) -> Column:
    return F.bround(F.least(F.greatest((v + F.lit(1.0)) * F.lit(127.5), F.lit(0.0)), F.lit(255.0)), 0).cast("int")


def denormalize_pixels(pixels, c, h, w) -> Column:
    """P10: [-1,1] CHW floats → 0..255 HWC ints: (x+1)·127.5, clamp, round
    half to even."""
    return Img.from_chw(pixels, c, h, w).map(_to_uint8).hwc()


# ------------------------------------------------------------ NumPy path --

def _nearest_index(n_src: int, n_dst: int) -> np.ndarray:
    return np.minimum(np.floor((np.arange(n_dst) + 0.5) * n_src / n_dst).astype(np.int64), n_src - 1)


def _nearest(img: np.ndarray, nh: int, nw: int) -> np.ndarray:
    h, w = img.shape[:2]
    return img[_nearest_index(h, nh)][:, _nearest_index(w, nw)]


@lru_cache(maxsize=256)
def _lanczos_taps(n_in: int, n_out: int, lobes: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(source places, weights) of each output place along one axis: the
    windowed sinc around its centre, stretched where the axis shrinks, over the
    places that exist, with weights that sum to one."""
    scale = n_in / n_out
    stretch = max(scale, 1.0)
    centre = (np.arange(n_out) + 0.5) * scale
    first = np.maximum((centre - lobes * stretch + 0.5).astype(int), 0)
    last = np.minimum((centre + lobes * stretch + 0.5).astype(int), n_in)
    place = first[:, None] + np.arange((last - first).max())
    x = (place + 0.5 - centre[:, None]) / stretch
    weight = np.where((place < last[:, None]) & (np.abs(x) < lobes), np.sinc(x) * np.sinc(x / lobes), 0.0)
    return np.minimum(place, n_in - 1), weight / weight.sum(axis=1, keepdims=True)


def _along_rows(img: np.ndarray, n_out: int) -> np.ndarray:
    place, weight = _lanczos_taps(img.shape[0], n_out)
    out = np.zeros((n_out, *img.shape[1:]))
    for t in range(place.shape[1]):
        out += img[place[:, t]] * weight[:, t].reshape(-1, *[1] * (img.ndim - 1))
    return np.clip(np.floor(out + 0.5), 0, 255)


def lanczos(img: np.ndarray, nh: int, nw: int) -> np.ndarray:
    """P2 with the original's filter, as a resampler for :func:`prepare_images`:
    columns, then rows, each rounded to 8 bits."""
    across = np.moveaxis(_along_rows(np.moveaxis(img, 1, 0), nw), 0, 1)
    return _along_rows(across, nh)


def prepare_one(img: np.ndarray, tw: int, th: int, resampler=_nearest, out: np.ndarray | None = None) -> np.ndarray:
    """P1–P5 for one HWC image → flat CHW float64 in [-1, 1].

    The normalised canvas is built channel-first directly: filled with the
    value of a black pixel (0/127.5 − 1 = −1), then only the pasted region
    is normalised — no full-size temporaries or transposed copies.  ``out``
    (a reusable float64 buffer of c·th·tw values) avoids an allocation.
    """
    h, w, c = img.shape
    scale = min(tw / w, th / h)
    nw, nh = int(w * scale), int(h * scale)
    if nw <= 0 or nh <= 0:
        raise ValueError(f"letterbox size {nw}x{nh} for a {w}x{h} image")
    if out is None:
        out = np.empty(c * th * tw)
    canvas = out.reshape(c, th, tw)
    canvas.fill(-1.0)
    ox, oy = (tw - nw) // 2, (th - nh) // 2
    if resampler is _nearest:
        # nearest only copies pixels: normalise the (small) source once, then
        # gather straight into the channel-first canvas — same values
        src = np.moveaxis(img / 127.5 - 1.0, 2, 0)
        ys, xs = _nearest_index(h, nh), _nearest_index(w, nw)
        canvas[:, oy:oy + nh, ox:ox + nw] = src[:, ys[:, None], xs[None, :]]
    else:
        region = np.moveaxis(resampler(img, nh, nw), 2, 0)
        canvas[:, oy:oy + nh, ox:ox + nw] = region / 127.5 - 1.0
    return out.reshape(-1)


def prepare_images(df: DataFrame, key: str, pixels: str, h: str, w: str, c: str,
                   tw: int = 512, th: int = 512, resampler=_nearest, dtype: str = "float",
                   out_rows: int = 16) -> DataFrame:
    """Letterbox, resize, pad, normalise and transpose in one NumPy pass.

    Output (key, status, error_message, tensor) with exactly one row per
    input row; an image that fails (zero letterbox side, bad shape) gets an
    error row instead of failing the task.  Select only the needed columns
    before this step — the whole child row is shipped to Python.
    ``dtype`` is the element type of the tensor: ``float`` (as the original
    float32 tensors, half the bytes) or ``double`` (bit-equal to the column
    path).  Output is yielded ``out_rows`` tensors at a time, so a Python
    worker never holds more than that many full-size tensors.
    """
    np_type = np.float32 if dtype == "float" else np.float64
    sp_type = Ty.FloatType() if dtype == "float" else Ty.DoubleType()
    from .parallel import spread

    src = spread(df.select(F.col(key).alias("key"), F.col(pixels).alias("px"), F.col(h).cast("int").alias("h"),
                           F.col(w).cast("int").alias("w"), F.col(c).cast("int").alias("c")))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out_k, out_t, out_s, out_e = [], [], [], []
            for k, px, hh, ww, cc in zip(pdf["key"], pdf["px"], pdf["h"], pdf["w"], pdf["c"]):
                out_k.append(k)
                try:
                    arr = np.asarray(px if not isinstance(px, (bytes, bytearray))
                                     else np.frombuffer(px, dtype=np.uint8), dtype=np.float64)
                    t = prepare_one(arr.reshape(hh, ww, cc), tw, th, resampler)
                    out_t.append(t.astype(np_type))
                    out_s.append("success")
                    out_e.append(None)
                except Exception as e:  # one error row per bad image
                    out_t.append(None)
                    out_s.append("error")
                    out_e.append(f"{type(e).__name__}: {e}")
                if len(out_k) == out_rows:
                    yield pd.DataFrame({"key": out_k, "status": out_s, "error_message": out_e, "tensor": out_t})
                    out_k, out_t, out_s, out_e = [], [], [], []
            if out_k:
                yield pd.DataFrame({"key": out_k, "status": out_s, "error_message": out_e, "tensor": out_t})

    schema = Ty.StructType([Ty.StructField("key", df.schema[key].dataType),
                            Ty.StructField("status", Ty.StringType()),
                            Ty.StructField("error_message", Ty.StringType()),
                            Ty.StructField("tensor", Ty.ArrayType(sp_type))])
    return src.mapInPandas(run, schema).withColumnRenamed("key", key)


def prepare_images_columns(df: DataFrame, pixels: str, h, w, c, tw: int = 512, th: int = 512,
                           grey: bool = False) -> DataFrame:
    """P1→P5 with column expressions only (same result as :func:`prepare_images`).

    The stages are composed as index maps, so each output element reads the
    source once.  ``pixels`` is an HWC array column or an :class:`Img`
    (e.g. decoded in the same projection).  ``grey=True`` takes a
    one-channel source and emits RGB (P8).
    """
    g = letterbox_geometry(w, h, tw, th)
    d = df.withColumn("_g", g)
    img = pixels if isinstance(pixels, Img) else Img.from_hwc(pixels, h, w, c)
    if grey:
        img = img.grey_to_rgb()
    out = img.resize(F.col("_g.new_h"), F.col("_g.new_w")) \
        .pad(th, tw, F.col("_g.off_y"), F.col("_g.off_x")).map(_norm).chw()
    return d.withColumn("tensor", F.when(F.col("_g.ok"), out)) \
        .withColumn("status", F.when(F.col("_g.ok"), F.lit("success")).otherwise(F.lit("error"))).drop("_g")


def prepare_and_encode(df: DataFrame, key: str, pixels: str, h: str, w: str, c: str,
                       tw: int = 512, th: int = 512, make_encoder=None, factor: int = 8,
                       batch_size: int = 8, resampler=_nearest) -> DataFrame:
    """P7 + E5 fused in one Python stage: letterbox/normalise each image,
    encode batches of ``batch_size``, and return only the latent
    distribution (key, status, error_message, mean, logvar).

    Full-size tensors (3 MiB each at 512×512) never go back to the JVM; only
    the small latents do.  A bad image becomes an error row; a failing
    batch is retried image by image, so every input row has one output row.
    """
    from .inference import PoolImageEncoder, lazy_model, model_key
    from .parallel import spread

    make = make_encoder or (lambda: PoolImageEncoder(3, th, tw, factor=factor))
    name = model_key("fused-image-encoder", make_encoder, 3, th, tw, factor)
    src = spread(df.select(F.col(key).alias("key"), F.col(pixels).alias("px"), F.col(h).cast("int").alias("h"),
                           F.col(w).cast("int").alias("w"), F.col(c).cast("int").alias("c")))

    buffers: dict = {}                     # one reusable batch buffer per channel count

    def prep(px, hh, ww, cc, slot):
        arr = np.asarray(px if not isinstance(px, (bytes, bytearray))
                         else np.frombuffer(px, dtype=np.uint8), dtype=np.float64)
        buf = buffers.get(cc)
        if buf is None:
            buf = buffers[cc] = np.empty((batch_size, cc * th * tw))
        return prepare_one(arr.reshape(hh, ww, cc), tw, th, resampler, out=buf[slot])

    def run(batches):
        import pandas as pd

        enc = lazy_model(name, make)
        for pdf in batches:
            rows = list(zip(pdf["key"], pdf["px"], pdf["h"], pdf["w"], pdf["c"]))
            for start in range(0, len(rows), batch_size):
                chunk = rows[start:start + batch_size]
                out = [None] * len(chunk)
                ready = []                       # (index in chunk, tensor view)
                for i, (k, px, hh, ww, cc) in enumerate(chunk):
                    try:
                        ready.append((i, prep(px, hh, ww, cc, len(ready))))
                    except Exception as e:
                        out[i] = ("error", f"{type(e).__name__}: {e}", None, None)
                if ready:
                    try:
                        same = len({t.base is not None and t.base.shape or t.shape for _, t in ready}) == 1
                        base = ready[0][1].base if same else None
                        batch = (base[:len(ready)] if base is not None and base.ndim == 2
                                 else np.stack([t for _, t in ready]))
                        mean, logvar = enc(batch)
                        for (i, _), m, lv in zip(ready, mean, logvar):
                            out[i] = ("success", None, m.astype(np.float32), lv.astype(np.float32))
                    except Exception:
                        for i, t in ready:
                            try:
                                m, lv = enc(t[None, :])
                                out[i] = ("success", None, m[0].astype(np.float32), lv[0].astype(np.float32))
                            except Exception as e:
                                out[i] = ("error", f"{type(e).__name__}: {e}", None, None)
                yield pd.DataFrame({"key": [r[0] for r in chunk], "status": [o[0] for o in out],
                                    "error_message": [o[1] for o in out],
                                    "mean": [o[2] for o in out], "logvar": [o[3] for o in out]})

    schema = Ty.StructType([Ty.StructField("key", df.schema[key].dataType),
                            Ty.StructField("status", Ty.StringType()),
                            Ty.StructField("error_message", Ty.StringType()),
                            Ty.StructField("mean", Ty.ArrayType(Ty.FloatType())),
                            Ty.StructField("logvar", Ty.ArrayType(Ty.FloatType()))])
    return src.mapInPandas(run, schema).withColumnRenamed("key", key)
