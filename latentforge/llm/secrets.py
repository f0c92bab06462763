"""Secret scans: character Markov models compared by likelihood ratio (native).

Two first-order models over the characters of identifiers are trained from
labelled samples of the corpus itself: values that the base patterns find
(random strings) and other long identifiers (ordinary ones).  A candidate run
of characters is a secret if its mean log-likelihood ratio per transition is
above a threshold.  The base patterns' own matches are always kept.

Prose hardly has the transitions of paths, camel case or constants.  So the
ordinary model gives a part of each row to a back-off: whether the next
character stays in the word, starts one, or is a digit or a separator
(``NEXT``), and in a word the letter pairs of the corpus whatever their case.

The documents that are scanned are also trained on, so identifiers without a
label may be secrets themselves.  A candidate is therefore judged without its
own transitions.  The threshold is never below zero, where both models explain
a string equally well, nor below the ratio that an ordinary identifier exceeds
with the probability ``FALSE_ALARMS`` (by the median and the 10 % quantile,
which a minority of secrets hardly moves), nor below the part ``SHARE`` of the
mean ratio of strings that the random model itself makes.

All distinct identifiers are used.  What reaches the driver is a count for
each pair of characters and two quantiles.

Offsets are code points.  They come from the lengths of the matches and of
the pieces between them, summed by doubling steps, so a text with very many
matches isn't quadratic.

Defined results: null and empty texts have no spans (the digest is that of the
empty string).  Repeated rows are scanned each.  Without labelled samples (an
empty table) there is no model and only base matches are found.  Spans of
different kinds may overlap.  Extra columns are carried along by :func:`scan`
unless they are named ``spans``.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# Runs are maximal, so a least length in the pattern equals a test afterwards.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
IDENTIFIER = r"[A-Za-z0-9+/_-]{12,}={0,2}"

EVEN = 0.8                # share of the even model in that of random strings
BACK_OFF, LEAST = 0.15, 3.0   # share of a row that the back-off has, and transitions at least
FALSE_ALARMS, SHARE = 1e-6, 0.2
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_NONE = "array<struct<start:int,kind:int,end:int>>"


def _running(values: Column, combine) -> Column:
    """Running sum or maximum of an array in log2(n) element-wise steps."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    return F.aggregate(steps, values, lambda acc, s: F.transform(acc, lambda x, i: combine(
        x, F.get(acc, i - F.call_function("shiftleft", F.lit(1), s)))))


def _spans(text: Column, pattern: str, kind: int, accept=None) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end)."""
    def located(found: Column) -> Column:
        def spans(pieces: Column) -> Column:
            lengths = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
            ends = _running(lengths, lambda a, b: a + F.coalesce(b, F.lit(0)))
            every = F.zip_with(ends, found, lambda e, m: F.struct(
                (e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), m.alias("match")))
            kept = every if accept is None else F.filter(every, lambda s: accept(s["match"]))
            return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                        s["end"].alias("end")))
        return F.when(F.size(found) == 0, F.array().cast(_NONE)).otherwise(
            let(F.split(text, pattern, -1), spans))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def _codes() -> Column:
    at = [ALPHABET.find(chr(c)) for c in range(128)]
    return F.from_json(F.lit(json.dumps(at)), "array<int>")


def _characters(token: Column) -> Column:
    """Indexes in the alphabet of a token's characters."""
    codes = _codes()
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.get(codes, F.ascii(c)))


def _pairs(token: Column) -> Column:
    """Transitions of a token as sorted numbers; those outside the alphabet are left out."""
    size = len(ALPHABET)
    return F.array_sort(F.filter(let(_characters(token), lambda c: F.zip_with(
        F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.size(c)),
        lambda a, b: F.when((a >= 0) & (b >= 0), a * size + b))), lambda x: x.isNotNull()))


def _ratio(model: tuple, token: Column) -> Column:
    """Mean log-likelihood ratio of the transitions of a token.

    The token's own transitions don't count as ordinary ones, else a key in the
    training text would vouch for itself.  Equal transitions are next to each
    other, so the work is one sort.
    """
    size = len(ALPHABET)
    log_rand, plain, rows, back, mass = (_table(t) for t in model[:5])

    def mean(pairs: Column) -> Column:
        first = F.filter(F.transform(pairs, lambda x, i: F.when((i == 0) | (x != F.get(pairs, i - 1)), i)),
                         lambda i: i.isNotNull())

        counted = let(first, lambda f: F.transform(f, lambda i, j: F.struct(
            F.get(pairs, i).alias("x"), (F.coalesce(F.get(f, j + 1), F.size(pairs)) - i).alias("own"))))

        def total(counted: Column) -> Column:
            def part(c: Column, trained: Column) -> Column:
                less = F.when(trained, c["own"]).otherwise(F.lit(0))
                row = F.floor(c["x"] / size).cast("int")
                q = (F.get(plain, c["x"]) - less + F.get(back, c["x"])) / (F.get(rows, row) - less + F.get(mass, row))
                return c["own"] * (F.get(log_rand, c["x"]) - F.log(q))
            return let(F.forall(counted, lambda c: F.get(plain, c["x"]) >= c["own"]), lambda trained: F.aggregate(
                F.transform(counted, lambda c: part(c, trained)), F.lit(0.0), lambda acc, x: acc + x))
        return F.when(F.size(pairs) > 0, let(counted, total) / F.size(pairs)).otherwise(F.lit(0.0))
    return let(_pairs(token), mean)


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct identifiers of all rows with their labels (token, random)."""
    body = F.coalesce(F.col(text), F.lit(""))
    values = F.filter(F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= 12)
    tokens = docs.select(values.alias("v"), F.regexp_extract_all(body, F.lit(IDENTIFIER), F.lit(0)).alias("t")) \
        .select(F.explode(F.concat(
            F.transform("v", lambda x: F.struct(x.alias("token"), F.lit(True).alias("valued"))),
            F.transform("t", lambda x: F.struct(x.alias("token"), F.lit(False).alias("valued"))))).alias("x")) \
        .select("x.token", "x.valued")
    return tokens.groupBy("token").agg(F.max("valued").alias("valued")).select(
        "token", (F.col("valued") | F.rlike("token", F.lit(HEX)) | F.rlike("token", F.lit(ACCESS))).alias("random"))


# What follows a character in an ordinary identifier, if counts don't tell:
# class -> shares of a letter of either case, a digit, a separator, another sign.
NEXT = {
    "lower": {"lower": 0.78, "upper": 0.06, "digit": 0.05, "sep": 0.10, "sign": 0.01},
    "upper": {"lower": 0.45, "upper": 0.40, "digit": 0.04, "sep": 0.10, "sign": 0.01},
    "digit": {"lower": 0.03, "upper": 0.02, "digit": 0.66, "sep": 0.28, "sign": 0.01},
    "sep": {"lower": 0.60, "upper": 0.15, "digit": 0.15, "sep": 0.09, "sign": 0.01},
    "sign": {"lower": 0.20, "upper": 0.20, "digit": 0.20, "sep": 0.20, "sign": 0.20},
}


def _class(c: str) -> str:
    return ("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit()
            else "sep" if c in "/_-" else "sign")


def back_off(plain: list) -> list:
    """Probabilities of all pairs from the counts of ordinary pairs: classes by
    ``NEXT``, letters of a word by pairs of letters without case, letters that
    start a word by single letters."""
    pairs, starts = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for x, n in enumerate(plain):
        a, b = ALPHABET[x // len(ALPHABET)].lower(), ALPHABET[x % len(ALPHABET)].lower()
        if a.isalpha() and b.isalpha():
            pairs[a, b] += n
            starts[b] += n
    kinds = {k: [c for c in ALPHABET if _class(c) == k] for k in NEXT}
    out = []
    for a in ALPHABET:
        for b in ALPHABET:
            here, there = _class(a), _class(b)
            within = a.isalpha() and b.isalpha() and not (here == "lower" and there == "upper")

            def weight(c: str) -> float:
                return pairs[a.lower(), c.lower()] if within else starts[c.lower()] if c.isalpha() else 1.0
            out.append(NEXT[here][there] * weight(b) / sum(map(weight, kinds[there])))
    return out


def train(docs: DataFrame, text: str = "text") -> tuple | None:
    """(log probabilities of random pairs, counts of ordinary pairs, their sums
    by first character, back-off in transitions by pair, its sums, threshold),
    or None.

    The model of random strings is mixed mostly with an even one over the alphabet,
    since any character may follow any other in a key.
    """
    size = len(ALPHABET)
    tokens = stored(labelled(docs, text), "identifiers")
    counts = {True: [0.0] * size * size, False: [0.0] * size * size}
    pairs = tokens.select("random", F.explode(_pairs(F.col("token"))).alias("pair"))
    for r in pairs.groupBy("random", "pair").count().collect():   # 2 * 67^2 at most
        counts[r["random"]][r["pair"]] = float(r["count"])
    if not any(counts[True]) or not any(counts[False]):
        return None
    log_rand, rows = [], []
    for a in range(size):
        rand, plain = (counts[k][a * size:(a + 1) * size] for k in (True, False))
        rows.append(sum(plain))
        log_rand += [round(math.log((1 - EVEN) * (r + 1.0) / (sum(rand) + size) + EVEN / size), 6) for r in rand]
    mass = [LEAST + BACK_OFF * n for n in rows]
    # Six digits, not six decimals: a pair that no identifier has must not become zero in a large corpus.
    back = [float(f"{p * mass[x // size]:.6g}") for x, p in enumerate(back_off(counts[False]))]
    model = (log_rand, counts[False], rows, back, mass)
    low, middle = (tokens.where("NOT random").select(_ratio(model, F.col("token")).alias("r"))
                   .agg(F.percentile_approx("r", [0.1, 0.5], F.lit(10_000))).first()[0])
    spread = (middle - low) / -NormalDist().inv_cdf(0.1)
    alarm = middle + spread * NormalDist().inv_cdf(1 - FALSE_ALARMS)
    made = sum(math.exp(p) * (p - math.log((counts[False][x] + back[x]) / (rows[x // size] + mass[x // size])))
               for x, p in enumerate(log_rand)) / size
    return *model, max(0.0, alarm, SHARE * made)


def _table(table: list) -> Column:
    return F.from_json(F.lit(json.dumps(table)), "array<double>")


def scan(docs: DataFrame, model: tuple | None, text: str = "text") -> DataFrame:
    """Adds ``spans``: array of (start, kind, end) by start, then kind; kind is
    an index into ``KINDS``."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = [
        _spans(body, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 12),
        _spans(body, ACCESS, 1),
        _spans(body, HEX, 2),
    ]
    if model is not None:
        found.append(_spans(body, CANDIDATE, 3, lambda m: _ratio(model, m) > model[-1]))
    return docs.withColumn("spans", F.sort_array(F.concat(*found)))


def as_string(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: tuple | None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Texts with every span, or group of overlapping spans, replaced by ``mark``."""
    found = scan(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text")), model)
    body = F.col("text")

    def rebuilt(spans: Column) -> Column:
        def pieces(done: Column) -> Column:       # done: furthest end so far
            def piece(s: Column, i: Column) -> Column:
                before = F.coalesce(F.get(done, i - 1), F.lit(0))
                return F.when(s["start"] >= before, F.concat(
                    F.substring(body, before + 1, s["start"] - before), F.lit(mark))).otherwise(F.lit(""))
            return F.concat(F.array_join(F.transform(spans, piece), ""),
                            F.substring(body, F.element_at(done, -1) + 1, F.length(body)))
        return let(_running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), pieces)

    clean = F.when(F.size("spans") == 0, body).otherwise(let(F.col("spans"), rebuilt))
    return found.select(*[(clean if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
