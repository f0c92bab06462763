"""Connected components of a table of links by alternating star steps.

A large star links every larger neighbour of a node to the least id around the
node; a small star does so with the smaller neighbours.  Repeated in turn they
turn each component into a star around its least id, in a number of rounds
that grows with the logarithm of the path lengths.  Minima are pre-aggregated
in each task, and the joins on a node with very many links are split by
adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _toward_least(pairs: DataFrame, keep) -> DataFrame:
    """pairs (u, v): each kept v is linked to the least id of u's group."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (pairs.where(keep).join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    large = _toward_least(both, F.col("v") > F.col("u")).distinct()
    down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    small = down.join(least, "u")
    return (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(least.select("u", "m")).where("a != b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b) but the least of each
    component, which is its own."""
    edges = stored(links.select("a", "b").where("a != b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_round(edges), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
