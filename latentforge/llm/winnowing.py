"""Document fingerprints by winnowing (native).

A text is cut into tokens (words; runs of more than 16 code points in parts,
ideographs and kana one by one).  Every run of ``K`` tokens is hashed; of each
window of ``W`` consecutive hashes the least is chosen, the rightmost if
several are equal.  The chosen (hash, position) pairs are the fingerprint:
two texts that share a run of ``W + K - 1`` tokens share at least one chosen
hash, and the positions tell where.  A text with fewer hashes than a window
has the least of them; one with fewer than ``K`` tokens the hash of all.

Everything is built from column functions: a sliding minimum over a window of
eight takes three element-wise steps, each doubling the reach.

Defined results: null and empty texts, and texts of white space, have an empty
fingerprint; two empty fingerprints have likeness 1, an empty and another 0.
Equal texts have equal fingerprints.  :func:`with_next` puts null ids first
and repeated ids in the order of a hash of their texts; the row after the last
is the first, which for a single row is itself.  Extra columns don't matter:
only the id and the text are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, positions

K = 5                   # tokens in a hashed run
W_STEPS = 3             # doublings: a window holds 2 ** W_STEPS hashes
W = 2 ** W_STEPS

_WIDE = r"⺀-鿿豈-﫿"
TOKEN = rf"[{_WIDE}]|[^\x20\x09-\x0D{_WIDE}]{{1,16}}"

BUCKET_ROWS = 1024      # documents ordered together
MAX_BUCKETS = 65_536    # bounds what with_next brings to the driver


def fingerprint(text: Column) -> Column:
    """Chosen minima in text order: array of hash * 2^32 + (2^32 - 1 - position)."""
    low = (1 << 32) - 1

    def chosen(keys: Column) -> Column:
        reach = reduce(lambda m, s: F.zip_with(m, F.slice(m, (1 << s) + 1, F.size(m)), lambda a, b: F.least(a, b)),
                       range(W_STEPS), keys)
        return F.array_distinct(F.slice(reach, 1, F.greatest(F.size(keys) - (W - 1), F.lit(1))))

    def of_hashes(hs: Column) -> Column:
        def key(i: Column) -> Column:
            gram = F.xxhash64(*[F.get(hs, i + j) for j in range(K)])
            return F.shiftleft(F.shiftrightunsigned(gram, 33), 32).bitwiseOR(F.lit(low) - i)
        n = F.greatest(F.size(hs) - (K - 1), F.least(F.size(hs), F.lit(1)))
        return let(F.transform(positions(n), key), chosen)

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), of_hashes)


def as_string(chosen: Column) -> Column:
    """hash:position pairs, comma-joined; hashes in hexadecimal."""
    low = (1 << 32) - 1
    return F.array_join(F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 32))), F.lit(":"), (F.lit(low) - x.bitwiseAND(F.lit(low))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the chosen hashes of two fingerprints."""
    def hashes(x: Column) -> Column:
        return F.array_distinct(F.transform(x, lambda k: F.shiftright(k, 32)))

    def of(x: Column, y: Column) -> Column:
        return let(F.size(F.array_intersect(x, y)), lambda both: F.when(
            F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(both / (F.size(x) + F.size(y) - both)))

    return let(hashes(a), lambda x: let(hashes(b), lambda y: of(x, y)))


def with_next(docs: DataFrame, columns: list, derived: dict | None = None) -> DataFrame:
    """Adds ``next``: a struct of ``columns`` of the row after, by doc_id.

    ``derived`` columns (name: expression) are added on the way, after the
    copies are chosen, so that they are computed once for each row.

    Rows are ordered inside ranges of ids.  The first row of a range is also
    put at the end of the range before (and the first of all at the end of the
    last), so each range knows the row after its own; those copies are dropped
    again.  The driver sees the least id of each range, ``MAX_BUCKETS`` at most.
    """
    spark = docs.sparkSession
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    if lo is None:
        lo = hi = 0
    count = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    width = max(1, -(-(hi - lo + 1) // count))
    bucket = F.coalesce(F.expr(f"(doc_id - {lo}) div {width}"), F.lit(0).cast("long"))
    heads = sorted((r["_b"], r["head"], r["nulls"]) for r in docs.groupBy(bucket.alias("_b")).agg(
        F.coalesce(F.min("doc_id"), F.lit(lo)).alias("head"), F.count_if(F.isnull("doc_id")).alias("nulls")).collect())
    # (id of the copied row, range that it ends); a null id is the head of the first range
    ends = [(None if k == 0 and nulls else head, heads[k - 1][0]) for k, (_, head, nulls) in enumerate(heads)]
    copies = (docs.join(F.broadcast(spark.createDataFrame(ends, "_head long, _b long")),
                        F.col("doc_id").eqNullSafe(F.col("_head")))
              .select(*docs.columns, "_b", F.lit(True).alias("_copy")))
    rows = docs.select(*docs.columns, bucket.alias("_b"), F.lit(False).alias("_copy")).unionByName(copies)
    rows = rows.withColumns(derived) if derived else rows
    order = Window.partitionBy("_b").orderBy("_copy", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return (rows.withColumn("next", F.lead(F.struct(*columns)).over(order))
            .where(~F.col("_copy")).drop("_b", "_copy"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses.

    The edited text has the last half of its code points replaced by the first
    as many of the next document.
    """
    own = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    paired = with_next(own, ["text", "fp"], {"fp": fingerprint(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    return (paired.select("doc_id", n.cast("long").alias("n_chars"), "fp", F.col("next.fp").alias("next_fp"),
                          edited.alias("edited"))
            .withColumn("edited_fp", fingerprint(F.col("edited"))))
