"""Toxicity by compression distance with two zstandard dictionaries.

Training picks, from labelled documents, the words and stems that occur in
more toxic documents than ordinary ones, or the other way round, beyond
chance (a likelihood-ratio statistic), and makes one raw zstandard dictionary
of each side.  A window of a text is compressed once with either dictionary;
the bytes that the toxic one saves are its evidence.  Seven figures of a
document's windows go into a logistic calibration, fitted with the true share
of the classes, so that the score is a probability.

Before compression a window is recoded: every prefix of five or more bytes of
a word, and every whole word, becomes one 8-byte code.  A stem or short word
that the dictionary knows then is longer than a sequence costs in a frame,
which it isn't as plain text, where entropy coding hides it.

Only labels of rows outside the held-out fold are read, and of those at most
``SAMPLE`` documents of each class (the ids with the least hashes).  Every
document is scored whole.

Defined results: null and empty texts have one empty window and get the score
of no evidence.  Equal texts get equal scores.  Rows without an id are scored
and never trained on.  Without training documents of both classes the score
is 1 if all are toxic and else 0.  Several labels of one document count as
toxic if one is.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 6_000              # training documents of each class
SEGMENTS = 64               # words and stems in a dictionary
EVIDENCE = 25.0             # least likelihood-ratio statistic of a segment
SEEN = 5                    # least number of training documents with it
STEM = 5                    # least length of a stem
WINDOW = 64                 # codes in a window
NOISE = 4                   # saved bytes below this count as none
CHUNK = 1 << 18             # bytes of a text recoded at once
THRESHOLD = 0.3
N_FEATURES = 7

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SEPARATORS = b" \t\n\r\x0b\x0c.,!?;:\"#*$%&|<>()[]{}"
_IS_SEPARATOR = np.isin(np.arange(256), np.frombuffer(_SEPARATORS, np.uint8))
_TO_SPACE = bytes(32 if _IS_SEPARATOR[c] else c for c in range(256))
_tables: dict = {}


def _powers(base: int) -> np.ndarray:
    if base not in _tables:
        p = np.ones(CHUNK, np.uint64)
        m = 1
        while m < CHUNK:
            p[m:2 * m] = p[:m] * np.uint64(pow(base, m, 1 << 64))
            m *= 2
        _tables[base] = p
    return _tables[base]


def codes(text: bytes) -> np.ndarray:
    """8-byte codes of the stems and words of a text, in order."""
    text, out, at = text.lower(), [], 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):             # cut after a separator if there is one
            found = np.flatnonzero(_IS_SEPARATOR[np.frombuffer(text, np.uint8, end - at, at)])
            end = at + int(found[-1]) + 1 if len(found) else end
        out.append(_codes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _codes(x: np.ndarray) -> np.ndarray:
    n = len(x)
    apart, place = _IS_SEPARATOR[x], np.arange(n)
    first = np.minimum(np.maximum.accumulate(np.where(apart, place + 1, 0)), n - 1)   # start of the word
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _powers(_BASE)[:n], out=sums[1:])
    h = (sums[1:] - sums[first]) * _powers(pow(_BASE, -1, 1 << 64))[first]
    stems = np.flatnonzero(~apart & (place - first >= STEM - 1))
    ends = np.flatnonzero(~apart & np.append(apart[1:], True))
    order = np.argsort(np.concatenate([stems * 2, ends * 2 + 1]), kind="stable")
    v = np.concatenate([h[stems], h[ends] ^ _MIX])[order]
    v = (v ^ (v >> np.uint64(32))) * _MIX
    return v ^ (v >> np.uint64(29))


def dictionary(segments: list) -> bytes:
    """Content of a raw dictionary: the strongest segment last, so nearest."""
    return b"".join(codes(s.encode()).tobytes() for s in reversed(segments)) + bytes(64)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        1, strategy=zstandard.STRATEGY_FAST, min_match=7, window_log=15, hash_log=10, chain_log=10,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=params)


def features(text: bytes, ordinary, toxic) -> tuple:
    """Figures of the bytes that the toxic dictionary saves in each window."""
    data = codes(text).tobytes()
    step = 8 * WINDOW
    saved = np.array([len(ordinary.compress(data[i:i + step])) - len(toxic.compress(data[i:i + step]))
                      for i in range(0, max(1, len(data)), step)])
    hits = saved[saved >= NOISE]
    n, total = len(saved), float(hits.sum())
    return (float(saved.max()), total ** 0.5, total / n, float(np.log1p(len(hits))), float(np.log(n)),
            len(hits) / n, float(np.log1p(total)))


def _value(v) -> bytes:
    return v.as_buffer().to_pybytes() if v.is_valid else b""


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(batches):
    """(word, toxic): distinct words of each training document."""
    for batch in batches:
        words, toxic = [], []
        for text, t in zip(batch.column(0), batch.column(1).to_pylist()):
            own = {w for w in _value(text).lower().translate(_TO_SPACE).split(b" ") if w}
            words += [w.decode("utf-8", "replace") for w in own]
            toxic += [t] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())],
                                         names=["word", "toxic"])


def _segments(sample: DataFrame) -> DataFrame:
    """(segment, toxic, ordinary, g): documents of either class that have a
    stem or word, and the signed likelihood-ratio statistic."""
    words = (sample.select(F.col("text").cast("binary").alias("text"), "toxic")
             .mapInArrow(_words, "word string, toxic int")
             .groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")))
    n = F.length("word")
    stems = F.when(n >= STEM, F.transform(F.sequence(F.lit(STEM), F.least(n, F.lit(32))),
                                          lambda k: F.substring(F.col("word"), F.lit(1), k))) \
        .otherwise(F.array().cast("array<string>"))
    # a whole word is marked by a space at its end
    pieces = words.select("t", (F.col("n") - F.col("t")).alias("o"),
                          F.explode(F.array_append(stems, F.concat("word", F.lit(" ")))).alias("segment"))
    counts = stored(pieces.groupBy("segment").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
                    .where(F.col("t") + F.col("o") >= SEEN), "segments")
    total = words.agg(F.sum("t"), F.sum(F.col("n") - F.col("t"))).first()
    share = total[0] / (total[0] + total[1])
    both = F.col("t") + F.col("o")

    def part(x: str, p: float) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (both * p))).otherwise(0.0)
    g = 2 * (part("t", share) + part("o", 1 - share))
    return counts.withColumn("g", F.when(F.col("t") > both * share, g).otherwise(-g))


def _choose(rows: list) -> list:
    """Segments by evidence; of a stem and its extensions only one, the longest
    with nearly the evidence of the strongest."""
    chosen, used = [], []
    for s, g in rows:
        if len(chosen) == SEGMENTS:
            break
        if any(s.startswith(u) or u.startswith(s) for u in used):
            continue
        used.append(s)
        chosen.append(max((x for x, gx in rows if x.startswith(s) and gx >= 0.8 * g), key=lambda x: (len(x), x)))
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (weight * (y - q)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and calibration from labels outside the held-out fold."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    seen = docs.select("doc_id").distinct()
    known = stored(known.join(seen, "doc_id", "left_semi"), "labelled")
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not size.get(0) or not size.get(1):
        return {"constant": 1.0 if size.get(1) else 0.0}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.where("toxic = 1").orderBy(*order).limit(SAMPLE).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(SAMPLE))
    ids = stored(ids.select(F.col("doc_id").alias("_id"), "toxic"), "sample-ids")
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))   # 2 * SAMPLE
                    .select("text", "toxic").dropDuplicates(), "sample")
    found = _segments(sample).where(F.abs("g") >= EVIDENCE)
    toxic, ordinary = (
        _choose([(r["segment"], r["g"]) for r in found.select("segment", (F.col("g") * sign).alias("g"))
                 .where("g > 0").orderBy(F.desc("g"), "segment").limit(50 * SEGMENTS).collect()])
        for sign in (1, -1))
    model = {"toxic": dictionary(toxic), "ordinary": dictionary(ordinary), "segments": toxic}
    scored = _figures(sample.select(F.col("toxic").cast("long").alias("doc_id"), "text"), model).toPandas()
    x, y = np.array(scored["figures"].tolist(), float).reshape(len(scored), N_FEATURES), scored["doc_id"].to_numpy(float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    drawn = np.bincount(y.astype(int), minlength=2)
    weight = np.where(y == 1, size[1] / drawn[1], size[0] / drawn[0])
    weight *= len(y) / weight.sum()
    b = _logistic(np.c_[np.ones(len(x)), (x - mean) / scale], y, weight)
    slope = b[1:] / scale
    return model | {"intercept": float(b[0] - mean @ slope), "slope": slope.tolist()}


def _figures(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, figures) of whole texts."""
    def figures(batches):
        ordinary, toxic = _compressor(model["ordinary"]), _compressor(model["toxic"])
        for batch in batches:
            rows = [features(_value(t), ordinary, toxic) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(r) for r in rows], pa.list_(pa.float64()))],
                names=["doc_id", "figures"])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        figures, "doc_id long, figures array<double>")


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if "constant" in model:
        return docs.select("doc_id", F.lit(model["constant"]).alias("score"))
    z = F.lit(model["intercept"])
    for k, s in enumerate(model["slope"]):
        z = z + F.get("figures", F.lit(k)) * s
    return _figures(docs, model).select("doc_id", F.round(1 / (1 + F.exp(-z)), 6).alias("score"))
