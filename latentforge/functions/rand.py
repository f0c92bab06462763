"""Deterministic, partition-independent randomness.

``uniform(seed, key, i)`` hashes the text ``seed|key|i`` with MD5 and maps the
first 32 bits into (0, 1).  Unlike ``rand(seed)`` the value depends only on
the row's key, so it is stable under repartitioning, AQE coalescing, task
retries and lost executors — a recomputed partition draws the same numbers.
Normal values use Box–Muller on two such draws.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_

TWO_POW_32 = 4294967296.0


def _as_text(p) -> Column:
    if isinstance(p, Column):
        return p.cast("string")
    if isinstance(p, str):
        return F.col(p).cast("string")
    return F.lit(str(p))


def hash_hex(seed, *parts) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_as_text(p) for p in parts]))


def hash_u32(seed, *parts) -> Column:
    """First 32 bits of the MD5 as a non-negative long."""
    return F.conv(F.substring(hash_hex(seed, *parts), 1, 8), 16, 10).cast("long")


def uniform(seed, *parts) -> Column:
    """u in (0, 1): (first 32 bits + 0.5) / 2^32."""
    return (hash_u32(seed, *parts).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_32)


def _draw(digest: Column, k: int) -> Column:
    """The k-th of the four uniform draws in an MD5 digest."""
    word = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("double")
    return (word + F.lit(0.5)) / F.lit(TWO_POW_32)


def _pair(digest: Column, k: int) -> tuple[Column, Column]:
    """Two standard normals (Box-Muller) from draws 2k and 2k + 1."""
    radius = F.sqrt(F.lit(-2.0) * F.log(_draw(digest, 2 * k)))
    angle = F.lit(2.0 * math.pi) * _draw(digest, 2 * k + 1)
    return radius * F.cos(angle), radius * F.sin(angle)


def normal(seed, key, i) -> Column:
    """The i-th standard normal of (seed, key): number i mod 4 of the four that
    the digest of (seed, key, i div 4) yields."""
    i = col_(i) if isinstance(i, (str, Column)) else F.lit(i)
    digest = hash_hex(seed, key, F.floor(i / 4).cast("long"))
    return F.get(F.array(*_pair(digest, 0), *_pair(digest, 1)), (i % 4).cast("int"))


def normal_array(seed, key, n) -> Column:
    """Array of n standard normals for one row (D7's noise), four a digest."""
    n = col_(n) if isinstance(n, (str, Column)) else F.lit(n)
    digests = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 4).cast("int")),
                          lambda q: hash_hex(seed, key, q.cast("long")))
    fours = F.transform(digests, lambda h: F.array(*_pair(h, 0), *_pair(h, 1)))
    return F.slice(F.flatten(fours), F.lit(1), n.cast("int"))


def randint(seed, key, upper: int, *extra) -> Column:
    """Uniform integer in [0, upper) — ``floor(u * upper)``."""
    return F.floor(uniform(seed, key, *extra) * F.lit(upper)).cast("int")


# ------------------------------------------------------------- permutations --

PRIME = 2_147_483_647
ROUNDS = 4                # each changes both halves
WALK = 24


def round_keys(seed) -> list[list[int]]:
    """Eight numbers below ``PRIME`` for each round, from digests of the seed."""
    out = []
    for j in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}|round|{j}".encode()).digest()
        out.append([int.from_bytes(digest[4 * k:4 * k + 4], "big") % (PRIME - 1) + 1 for k in range(8)])
    return out


def with_permuted(df: DataFrame, pos: str, n: str, seed, out: str) -> DataFrame:
    """``df`` with the place of ``pos`` in a pseudo-random permutation of 0 .. n-1.

    A Feistel network over pairs (left, right) of the least rectangle
    ``a * b >= n`` with ``a`` near the root of ``n``: each half in turn is moved
    by a function of the other, which can be undone, so the pairs are permuted.
    A result of ``n`` or more is sent through again until it is below; fewer
    than ``a`` pairs lie there, so one pass is nearly always enough, and
    ``WALK`` more are proved to be for n up to 576 and beyond that fail with a
    probability under 1e-30 (an error then, never a wrong place).

    Only arithmetic on the row itself: no sort, no shuffle, and the same
    numbers in any engine.  Each half-round becomes a projection of its own,
    so that generated code computes it once.  Needs n below 2^60.
    """
    def mixed(x: str, k: list) -> str:
        one, two = (f"(({x} * {k[2 * j]} + {k[2 * j + 1]}) % {PRIME})" for j in (0, 1))
        return f"{one} * {two} % {PRIME}"

    def half(moved: str, by: str, k: list, size: str) -> str:
        return f"({moved} + {mixed(by, k)}) % {size}"

    keys = [[f"{k}L" for k in ks] for ks in round_keys(seed)]
    a, b = "_lf_a", "_lf_b"
    steps = [f"CAST(ceil(sqrt(CAST(`{n}` AS DOUBLE))) AS BIGINT) AS {a}", f"(`{n}` + {a} - 1) div {a} AS {b}",
             f"`{pos}` div {b} AS _lf_l0", f"`{pos}` % {b} AS _lf_r0"]
    for j, k in enumerate(keys):
        steps.append(half(f"_lf_l{j}", f"_lf_r{j}", k[:4], a) + f" AS _lf_l{j + 1}")
        steps.append(half(f"_lf_r{j}", f"_lf_l{j + 1}", k[4:], b) + f" AS _lf_r{j + 1}")
    steps.append(f"_lf_l{ROUNDS} * {b} + _lf_r{ROUNDS} AS _lf_p")

    # the walk, for the few results beyond n: a round's keys are an array there
    table = "array(" + ", ".join(f"array({', '.join(k)})" for k in keys) + ")"
    k = [f"k[{j}]" for j in range(8)]
    turn = (f"transform(array({half('s.l', 's.r', k[:4], a)}), "
            f"left -> named_struct('l', left, 'r', {half('s.r', 'left', k[4:], b)}))[0]")
    once = (f"transform(array(aggregate({table}, named_struct('l', x div {b}, 'r', x % {b}), (s, k) -> {turn})), "
            f"t -> t.l * {b} + t.r)[0]")
    walked = f"aggregate(sequence(1, {WALK}), _lf_p, (x, i) -> CASE WHEN x < `{n}` THEN x ELSE {once} END)"
    ended = (f"transform(array({walked}), x -> CASE WHEN x < `{n}` THEN x ELSE "
             f"CAST(raise_error('the permutation did not end') AS BIGINT) END)[0]")
    # A filter on the result would be moved below the projections and repeat
    # them all in one expression; it stays above one that isn't deterministic.
    zero = "CAST(spark_partition_id() * 0 AS BIGINT)"
    rows = df.selectExpr("*", *steps)
    kept = [f"`{c}`" for c in df.columns if c != out]
    return rows.selectExpr(*kept, f"{zero} + CASE WHEN _lf_p < `{n}` THEN _lf_p ELSE {ended} END AS `{out}`")
