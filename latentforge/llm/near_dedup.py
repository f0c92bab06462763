"""MinHash near-duplicate detection with odd sketches.

1. Each document's word shingles are hashed; 160 MinHash samples give 32 band
   keys of five samples, and an odd sketch: 512 bits in which every sample
   flips one, so the population count of the XOR of two sketches estimates a
   high similarity closely.
2. Documents with equal shingle sets are one class, stood for by the least id.
   Classes that share a band key are candidates.  At the linking similarity a
   pair shares no band with probability under 1e-8 (at 80 percent near 3e-6).
3. In each band bucket all members are compared with one pivot: first the
   sketches, then the full shingle sets, which decide.  What isn't joined to
   the bucket's largest component by then is compared with all other members
   of the bucket in another component; links inside a component need no test.

No bucket is capped.  A pair is passed over only where it provably can't be
linked: with ``u`` shingles that no other class of the candidates has, the
union of two sets is at least their common part plus both ``u``; two sets that
share different numbers of shingles with the pivot differ by as many; and odd
sketches of whole sets never differ in more bits than the sets in shingles.
Members with the fewest such shingles make the pivots.

Defined results: null and empty texts, and texts without words, have no
shingles and are linked with nothing; neither are rows without an id, whose
component is null and which are kept.  Repeated rows with one id are one
document.  Extra columns are ignored here and carried along by :func:`dedup`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small, stored, unused
from .components import components

SHINGLE = 5
BANDS, BAND_ROWS = 32, 5
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 512
LINK = 85                 # percent of the union that must be common
PARITY_BITS = 1024
CHUNK = 1 << 17           # shingles hashed together
CHUNK_ROWS = 1024         # and texts

_FOLD = np.uint64(0x9E3779B97F4A7C15)
_seeds = np.random.default_rng(20_240_501)
_FACTORS = _seeds.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_FLIPS = _seeds.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)

SIGNATURE = "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"
SETS = "doc_id long, shingles array<long>, parity array<long>"


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at the six ASCII
    white-space characters only, as the definition of words asks.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        x *= _FOLD
        x += h[j:len(h) - k + 1 + j]
    return np.unique(x)


def signatures(sets: list) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (n, BANDS) and odd sketches (n, 8) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), SAMPLES), np.uint64)
    scaled = np.empty_like(flat)
    for i in range(SAMPLES):
        np.multiply(flat, _FACTORS[i], out=scaled)
        least[:, i] = np.minimum.reduceat(scaled, starts)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS)).copy()
    rows = least.reshape(len(sets), BANDS, BAND_ROWS)
    for j in range(BAND_ROWS):
        keys = (keys * _FOLD) ^ (keys >> np.uint64(29))
        keys += rows[:, :, j]
    bit = ((least * _FLIPS) >> np.uint64(64 - 9)).astype(np.int64)
    flips = np.bincount((bit + np.arange(len(sets))[:, None] * SKETCH_BITS).ravel(),
                        minlength=len(sets) * SKETCH_BITS).reshape(len(sets), SKETCH_BITS) & 1
    sketch = np.packbits(flips.astype(np.uint8), axis=1).view(np.int64)
    return keys.view(np.int64), sketch


def parity(shingle_set: np.ndarray) -> np.ndarray:
    """Odd sketch of a whole set: each shingle flips one of PARITY_BITS bits.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    bit = (shingle_set * _FLIPS[0]) >> np.uint64(64 - 10)
    flips = np.bincount(bit.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _lists(values: list, width: int | None = None):
    """Arrow list<int64> from arrays (or a matrix) and places without any."""
    sizes = [len(v) for v in values]
    flat = np.concatenate([np.asarray(v) for v in values]) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + sizes), pa.int32()), pa.array(flat.view(np.int64)))


def _sign(batches):
    none = np.empty(0, np.int64)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at = 0
        while at < len(texts):
            sets, total, first = [], 0, at
            while at < len(texts) and total < CHUNK and at - first < CHUNK_ROWS:
                sets.append(shingles(texts[at].as_py()))
                total += len(sets[-1])
                at += 1
            full = [k for k, s in enumerate(sets) if len(s)]
            bands, sketch = [none] * len(sets), [none] * len(sets)
            if full:
                keys, marks = signatures([sets[k] for k in full])
                for k, b, m in zip(full, keys, marks):
                    bands[k], sketch[k] = b, m
            yield pa.RecordBatch.from_arrays([
                ids.slice(first, at - first), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                _lists(bands), _lists(sketch)], names=["doc_id", "n_shingles", "set_key", "bands", "sketch"])
        pa.default_memory_pool().release_unused()


def _shingle(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at = 0
        while at < len(texts):
            sets, total, first = [], 0, at
            while at < len(texts) and total < 4 * CHUNK and at - first < CHUNK_ROWS:
                sets.append(shingles(texts[at].as_py()))
                total += len(sets[-1])
                at += 1
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, at - first), _lists(sets), _lists([parity(s) for s in sets])],
                names=["doc_id", "shingles", "parity"])
        pa.default_memory_pool().release_unused()


def sketch_distance(a: Column, b: Column) -> Column:
    """Population count of the XOR of two odd sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def sketch_limit(link: int = LINK) -> int:
    """Distance that a pair at the linking similarity exceeds with a probability
    near 1e-8: six standard deviations of the differing samples above the mean."""
    p = 1 - link / 100
    differing = SAMPLES * p + 6 * (SAMPLES * p * (1 - p)) ** 0.5
    flipped = SKETCH_BITS / 2 * (1 - np.exp(-4 * differing / SKETCH_BITS))
    return int(np.ceil(flipped + 6 * (flipped * (1 - flipped / SKETCH_BITS)) ** 0.5 / 2))


def _possible(n_a, u_a, n_b, u_b, link: int):
    """Whether the unshared shingles leave room for a link."""
    common = F.least(n_a - u_a, n_b - u_b)
    return common * 100 >= (common + u_a + u_b) * link


def _side(table: DataFrame, key: str, *cols: str) -> DataFrame:
    return table.select(F.col("doc_id").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in cols])


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with sizes and common shingles of their full sets."""
    both = pairs.join(_side(sets, "a", "shingles"), "a").join(_side(sets, "b", "shingles"), "b")
    return both.select("a", "b", F.size("a_shingles").alias("n_a"), F.size("b_shingles").alias("n_b"),
                       F.size(F.array_intersect("a_shingles", "b_shingles")).alias("common"))


def _linked(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, link: int) -> DataFrame:
    """The pairs (a, b) that are linked: sketches first, full sets decide."""
    near = (pairs.join(_side(sketches, "a", "sketch"), "a").join(_side(sketches, "b", "sketch"), "b")
            .where(sketch_distance(F.col("a_sketch"), F.col("b_sketch")) <= sketch_limit(link)).select("a", "b"))
    return (_common(near, sets).where("common * 100 >= (n_a + n_b - common) * %d" % link)
            .select("a", "b").distinct())


def classes(docs: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    signed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .mapInArrow(_sign, SIGNATURE), "signatures")
    keyed = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # one document with several texts (repeated ids) links their classes
    reps = stored(keyed.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    repeated = keyed.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")) \
        .where("x != y").select("doc_id")

    rep_rows = (keyed.join(reps, "set_key").where("doc_id = rep").dropDuplicates(["set_key"])
                .select("set_key", "doc_id", "n_shingles", "bands", "sketch"))
    rep_rows = stored(rep_rows, "representatives")
    banded = rep_rows.select(F.explode("bands").alias("key"), "doc_id")
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = stored(banded.join(shared, "key"), "buckets")
    needed = stored(members.select("doc_id").distinct(), "candidates")
    sets = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .join(if_small(needed), "doc_id", "left_semi").mapInArrow(_shingle, SETS), "sets")

    # shingles that one candidate alone has; none are counted for an id with several rows
    once = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows = 1").select("doc_id")
    alone = (sets.select("doc_id", F.explode("shingles").alias("s")).groupBy("s")
             .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1")
             .groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("u")).join(once, "doc_id", "left_semi"))
    facts = stored(rep_rows.join(if_small(needed), "doc_id", "left_semi").join(alone, "doc_id", "left")
                   .select("doc_id", F.col("n_shingles").cast("int").alias("n"), F.coalesce("u", F.lit(0)).alias("u"),
                           "sketch"), "facts")
    members = members.join(facts.select("doc_id", "n", "u"), "doc_id")
    least = members.groupBy("key").agg(F.min(F.struct("u", "doc_id", "n")).alias("pivot"))
    members = stored(members.join(least, "key").where(
        _possible(F.col("n"), F.col("u"), F.col("n"), F.col("pivot.u"), link)), "possible")

    tested = (members.where((F.col("doc_id") != F.col("pivot.doc_id"))
                            & _possible(F.col("n"), F.col("u"), F.col("pivot.n"), F.col("pivot.u"), link))
              .select(F.col("pivot.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = stored(_linked(tested, sets, facts, link), "pivot-links")
    label = components(links)
    members = (members.join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left")
               .select("key", "doc_id", "n", "u", F.col("pivot.doc_id").alias("pivot"),
                       F.coalesce("component", "doc_id").alias("label")))
    sizes = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m"), F.count(F.lit(1)).alias("labels")) \
        .where("labels > 1").select("key", F.col("m.label").alias("main"))
    split = stored(members.join(main, "key"), "split")
    # what members share with the pivot; unknown for ids with several sets
    shared_with_pivot = (
        _common(split.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct(), sets)
        .groupBy("a", "b").agg(F.when(F.count(F.lit(1)) == 1, F.min("common")).alias("c"))
        .select(F.col("a").alias("pivot"), F.col("b").alias("doc_id"), "c"))
    sketched = sets.groupBy("doc_id").agg(F.when(F.count(F.lit(1)) == 1, F.min("parity")).alias("parity"))
    split = stored(split.join(shared_with_pivot, ["pivot", "doc_id"]).where("doc_id != pivot")
                   .join(sketched, "doc_id"), "split")
    left = split.where("label != main").select(
        "key", *[F.col(c).alias(f"{c}_x") for c in ("doc_id", "n", "u", "label", "c", "parity")])
    # A linked pair differs in at most this share of its sizes.  It differs in
    # the shingles that one alone has, in those of the pivot that one lacks, and
    # in at least as many as the parity sketches of the whole sets.
    room = (F.col("n_x") + F.col("n")) * (100 - link)
    differs = F.col("u_x") + F.col("u") + F.coalesce(F.abs(F.col("c_x") - F.col("c")), F.lit(0))
    near = (differs * (100 + link) <= room) & F.coalesce(
        sketch_distance(F.col("parity_x"), F.col("parity")) * (100 + link) <= room, F.lit(True))
    rest = (left.join(split, "key")
            .where((F.col("label_x") != F.col("label")) & near
                   & ((F.col("label") == F.col("main")) | (F.col("doc_id_x") < F.col("doc_id")))
                   & _possible(F.col("n_x"), F.col("u_x"), F.col("n"), F.col("u"), link))
            .select(F.least("doc_id_x", "doc_id").alias("a"), F.greatest("doc_id_x", "doc_id").alias("b")).distinct())
    more = stored(_linked(rest, sets, facts, link), "more-links")

    named = keyed.select("doc_id", "set_key").join(repeated, "doc_id", "left_semi").distinct().join(reps, "set_key")
    same_id = (named.join(named.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id")
               .select("a", F.col("rep").alias("b")).where("a != b").distinct())
    final = components(links.union(more).union(same_id))
    owner = reps.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("class_id"))
    return (signed.select("doc_id", "n_shingles", "set_key").join(owner, "set_key", "left")
            .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("component_id"))
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def dedup(docs: DataFrame, link: int = LINK) -> DataFrame:
    """``docs`` without the documents that aren't the first of their component."""
    name = unused(docs, "gone")
    gone = stored(classes(docs, link).where("NOT kept").select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(if_small(gone), F.col("doc_id") == F.col(name), "left_anti")
