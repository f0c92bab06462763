"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier in
the corpus (smaller id, or same document and earlier start) is removed.

*Parse.*  A rolling hash over ``GRAM`` bytes triggers the phrases: a gram is a
trigger if it is least among the grams of some window of ``LENGTH`` bytes
(rightmost of equal ones).  The windows with one trigger are consecutive; the
bytes they cover are a phrase, so that each window lies in exactly one phrase
and equal windows have equal triggers at equal places.

*Dictionary.*  Equal phrases are one entry.  In corpus order the first
occurrence stands for it; every later one is repeated as a whole.  An entry
whose trigger no other entry has shares no window with any.

*Suffixes.*  For the entries that are left, the suffixes of at least
``LENGTH`` bytes are put in groups with equal first ``LENGTH`` bytes — the
runs with a common prefix of that length in the suffix array of dictionary
and parse.  Corpus order inside a run gives its first start; the others are
repeated.  Since only such runs matter, suffixes are partitioned by a hash of
the stretch of bytes that the windows at a place have in common, and sorted
in each partition; a total order of all suffixes isn't needed.  Stretches that
only one entry has are dropped before their suffixes are listed.

Strings are compared by two 64-bit hashes with different bases.

Defined results: null and empty texts have 0 bytes and no removal; matches
never cross documents.  Rows with equal ids are separate documents, in the
order of their texts; null ids come first.  Extra columns are carried along by
:func:`strip`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.positions import with_position
from .common import stored

LENGTH = 100
GRAM = 24
CHUNK = 1 << 20                      # window starts handled at once
_SPAN = LENGTH - GRAM + 1            # grams in a window
_STEPS = ((0, 18), (19, 37), (38, 56), (57, _SPAN - 1))   # bytes of a window before its trigger

_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64((1 << 24) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict = {}


def _power_table(base: int) -> np.ndarray:
    """base^0 .. base^(CHUNK + 512) modulo 2^64, kept per process."""
    if base not in _powers:
        n = CHUNK + 512
        p = np.ones(n, np.uint64)
        m = 1
        while m < n:
            k = min(m, n - m)
            p[m:m + k] = p[:k] * np.uint64(pow(base, m, 1 << 64))
            m += k
        _powers[base] = p
    return _powers[base]


class Hashes:
    """Hashes of any stretch of a byte array, from prefix sums.

    The hash of [i, j) is the sum of (byte + 1) * base^(place - i) modulo 2^64,
    mixed at the end.
    """

    def __init__(self, data: np.ndarray, base: int):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(base)[:len(data)], out=self.sums[1:])
        self.inverse = _power_table(pow(base, -1, 1 << 64))

    def __call__(self, i, j) -> np.ndarray:
        return _mixed((self.sums[j] - self.sums[i]) * self.inverse[i])

    def all_of(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def phrases(data: np.ndarray):
    """(start, end, trigger, gram hash, phrase hash) of a document's phrases.

    ``end`` is exclusive.  Long documents are done in chunks of window starts,
    which may cut a phrase in two but never a window.
    """
    out = []
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[at:at + CHUNK + LENGTH - 1]
        grams = Hashes(part, _BASES[0]).all_of(GRAM)
        keys = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        least, reach = keys, 1
        while 2 * reach <= _SPAN:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if _SPAN > reach:
            rest = _SPAN - reach
            least = np.minimum(least[:-rest], least[rest:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        trigger = (_LOW - (least[first] & _LOW)).astype(np.int64)
        whole = Hashes(part, _BASES[1])(first, last + LENGTH) + (trigger - first).astype(np.uint64)
        out.append((first + at, last + LENGTH + at, trigger + at, grams[trigger], whole))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.empty(0, np.uint8)


def _pack(start, end, trigger):
    """start, length and place of the trigger in one long, ordered by start."""
    return (start << 16) | ((end - start) << 8) | (trigger - start)


def _parse(batches):
    """Phrases of each document; repeats inside a batch are told at once, so a
    text that many rows share is combined before the shuffle."""
    for batch in batches:
        docs, texts = batch.column(0), batch.column(1)
        order = np.argsort(docs.to_numpy(), kind="stable") if pa.types.is_integer(docs.type) and not docs.null_count \
            else None
        held, rows, size = [], [], 0

        def flush():
            gram, whole, at = (np.concatenate([h[k] for h in held]) for k in range(3))
            who = np.repeat(rows, [len(h[0]) for h in held])
            key = gram ^ (whole * _MIX)
            by = np.argsort(key, kind="stable")
            again = np.zeros(len(key), bool)
            same = (gram[by][1:] == gram[by][:-1]) & (whole[by][1:] == whole[by][:-1])
            if order is None:                     # ids without an order here: repeats in one document only
                same &= who[by][1:] == who[by][:-1]
            again[by[1:]] = same
            gram = np.where(again, _mixed(at.astype(np.uint64) ^ (who.astype(np.uint64) << np.uint64(40)) ^ whole), gram)
            return pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), docs.take(pa.array(who)),
                 pa.array(at), pa.array(again)], names=["gram", "whole", "doc", "at", "again"])

        for k in (order if order is not None else range(len(texts))):
            data = _bytes(texts[int(k)])
            found = phrases(data)
            if found is None:
                continue
            start, end, trigger, gram, whole = found
            held.append((gram, whole, _pack(start, end, trigger)))
            rows.append(int(k))
            size += len(gram)
            if size > 1 << 20:
                yield flush()
                held, rows, size = [], [], 0
        if held:
            yield flush()


def suffixes(data: np.ndarray, marks: np.ndarray):
    """(stretch hash, first window, window hashes) of dictionary entries.

    The windows with about the same number of bytes before the trigger share
    a stretch of bytes; its hash is their key.
    """
    start = marks >> 16
    for at in range(0, len(data), CHUNK):
        own = marks[(start >= at) & (start < at + CHUNK)]
        if not len(own):
            continue
        part = data[at:at + CHUNK + 256]
        s = (own >> 16) - at
        last = s + ((own >> 8) & 255) - LENGTH          # last window start
        t = s + (own & 255)
        by_stretch, by_window = Hashes(part, _BASES[0]), Hashes(part, _BASES[1])
        for step, (near, far) in enumerate(_STEPS):
            low, high = np.maximum(s, t - far), np.minimum(last, t - near)
            ok = low <= high
            low, high, tt = low[ok], high[ok], t[ok]
            if not len(low):
                continue
            key = by_stretch(tt - near, tt - far + LENGTH) + np.uint64(step)
            n = high - low + 1
            p = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            yield key, low + at, n, by_window(p, p + LENGTH)


def _list_suffixes(batches):
    for batch in batches:
        docs, texts, marks = batch.column(0), batch.column(1), batch.column(2)
        for k in range(len(docs)):
            parts = list(suffixes(_bytes(texts[k]), np.sort(marks[k].values.to_numpy())))
            if not parts:
                continue
            key, low, n, window = (np.concatenate(x) for x in zip(*parts))
            offsets = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), docs.take(pa.array(np.full(len(key), k))), pa.array(low),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(window.view(np.int64)))],
                names=["stretch", "doc", "low", "windows"])


def covered(n: int, whole: np.ndarray, windows: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which of n bytes are removed: whole phrases and single windows."""
    step = np.zeros(n + 1, np.int32)
    start = whole >> 16
    np.add.at(step, start, 1)
    np.add.at(step, start + ((whole >> 8) & 255), -1)
    for bit in range(20):
        p = windows[(masks >> bit) & 1 == 1] + bit
        np.add.at(step, p, 1)
        np.add.at(step, p + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _remove(batches):
    """Kept bytes, and kept text with only those characters removed whose bytes
    all are."""
    for batch in batches:
        docs, texts = batch.column(0), batch.column(1)
        out: dict = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "kept_text")}
        at = size = 0

        def flush(upto):
            return pa.RecordBatch.from_arrays(
                [docs.slice(at, upto - at), *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")],
                 pa.array(out["kept"], pa.binary()), pa.array(out["kept_text"], pa.string())],
                names=["doc", *out])

        for k in range(len(docs)):
            data = _bytes(texts[k])
            whole, low, mask = (batch.column(c)[k].values.to_numpy() if batch.column(c)[k].is_valid
                                else np.empty(0, np.int64) for c in (2, 3, 4))
            gone = covered(len(data), whole, low, mask)
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            chars = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.append(lead, len(data)))) \
                if len(lead) else gone
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            out["kept"].append(data[~gone].tobytes())
            out["kept_text"].append(data[~chars].tobytes().decode("utf-8") if texts[k].is_valid else None)
            size += 2 * len(data)
            if size > 1 << 24:
                yield flush(k + 1)
                at, size = k + 1, 0
                out = {c: [] for c in out}
        if at < len(docs):
            yield flush(len(docs))


def _with_key(docs: DataFrame) -> DataFrame:
    """Adds ``_doc``, a unique key in corpus order: the id, or the id and a
    running number where ids are missing or occur twice."""
    n, named, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n == distinct:
        return docs.withColumn("_doc", F.col("doc_id").cast("long"))
    placed = with_position(docs, ["doc_id", "text"], pos_col="_copy")
    return placed.withColumn("_doc", F.struct(F.col("doc_id").cast("long").alias("id"),
                                              F.col("_copy").alias("copy"))).drop("_copy")


def _repeats(docs: DataFrame, kind: T.DataType) -> DataFrame:
    """(doc, at, whole): phrases repeated as a whole, and (whole false) first
    occurrences of entries that share a trigger with another entry."""
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("whole", T.LongType()),
                           T.StructField("doc", kind), T.StructField("at", T.LongType()),
                           T.StructField("again", T.BooleanType())])
    parsed = docs.select("doc", F.col("text").cast("binary").alias("text")).mapInArrow(_parse, schema)
    entry = Window.partitionBy("gram", "again")
    ordered = entry.orderBy("whole", "doc", "at")
    return (parsed.repartition("gram")
            .withColumn("before", F.lag("whole").over(ordered))
            .withColumn("low", F.min("whole").over(entry)).withColumn("high", F.max("whole").over(entry))
            .withColumn("later", F.col("again") | F.coalesce(F.col("before") == F.col("whole"), F.lit(False)))
            .where("later OR low != high").select("doc", "at", F.col("later").alias("whole")))


def _shared_windows(docs: DataFrame, entries: DataFrame, kind: T.DataType) -> DataFrame:
    """(doc, low, mask): windows of entries that start earlier elsewhere."""
    schema = T.StructType([T.StructField("stretch", T.LongType()), T.StructField("doc", kind),
                           T.StructField("low", T.LongType()), T.StructField("windows", T.ArrayType(T.LongType()))])
    marks = entries.groupBy("doc").agg(F.collect_list("at").alias("marks"))
    listed = (docs.select("doc", F.col("text").cast("binary").alias("text")).join(marks, "doc")
              .select("doc", "text", "marks").mapInArrow(_list_suffixes, schema).repartition("stretch"))
    shared = listed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("stretch"))).where("n > 1")
    each = shared.select("stretch", "doc", "low", F.posexplode("windows").alias("bit", "window"))
    run = Window.partitionBy("stretch", "window").orderBy("doc", F.col("low") + F.col("bit"))
    return (each.withColumn("nth", F.row_number().over(run)).where("nth > 1")
            .groupBy("stretch", "doc", "low")
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"))
            .select("doc", "low", "mask"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept, kept_text) for every row of
    ``docs``, which has a unique key ``doc``."""
    kind = docs.schema["doc"].dataType
    found = stored(_repeats(docs, kind), "phrases")
    windows = stored(_shared_windows(docs, found.where("NOT whole"), kind), "windows")
    marks = (found.where("whole").select("doc", F.col("at").alias("whole"), F.lit(None).cast("long").alias("low"),
                                         F.lit(None).cast("long").alias("mask"))
             .unionByName(windows.select("doc", F.lit(None).cast("long").alias("whole"), "low", "mask"))
             .groupBy("doc").agg(F.collect_list("whole").alias("whole"), F.collect_list("low").alias("low"),
                                 F.collect_list("mask").alias("mask")))
    schema = T.StructType([T.StructField("doc", kind), *[T.StructField(c, T.LongType()) for c in (
        "n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType()),
        T.StructField("kept_text", T.StringType())])
    return (docs.select("doc", F.col("text").cast("binary").alias("text")).join(marks, "doc", "left")
            .select("doc", "text", "whole", "low", "mask").mapInArrow(_remove, schema))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_text) for every row."""
    out = remove_repeats(_with_key(docs.select("doc_id", "text")).select(F.col("_doc").alias("doc"), "text"))
    key = "doc.id" if isinstance(out.schema["doc"].dataType, T.StructType) else "doc"
    return out.select(F.col(key).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept", "kept_text")


def strip(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` (whole characters
    only); ``n_chars`` follows where it exists.  Documents of which nothing is
    left go; empty ones stay."""
    others = [c for c in docs.columns if c != "text"]
    keyed = _with_key(docs.select("doc_id", "text", F.struct(*others).alias("row")))
    kept = remove_repeats(keyed.select(F.col("_doc").alias("doc"), "text")).select(
        F.col("doc").alias("_doc"), "kept_text", "n_bytes")
    rest = keyed.select("_doc", "row").join(kept, "_doc").where("n_bytes = 0 OR kept_text != ''")

    def column(c: str):
        if c == "text":
            return F.col("kept_text")
        if c == "n_chars":
            return F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        return F.col("row").getField(c)
    return rest.select(*[column(c).alias(c) for c in docs.columns])
