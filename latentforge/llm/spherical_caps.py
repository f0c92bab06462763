"""Near duplicates among vectors by spherical-cap filters.

1. Filter directions are random product codes: the space is cut into blocks,
   each block has its own random unit vectors, and a direction takes one of
   each block.  A vector belongs to every direction whose inner product with it
   exceeds a threshold; list decoding finds these block by block and drops a
   partial choice when even the best rest can't reach the threshold.  Threshold
   and number of directions follow from the number of vectors, so that a cap
   has about ``CAP_ROWS`` vectors of an even spread and a pair at the linking
   cosine shares ``SHARED`` caps in the mean.
2. Joined on caps, vectors are compared as 8-bit vectors with proven error
   bounds first; what these don't decide is compared in double precision.
3. Copies don't become pairs.  Equal vectors are one node.  In a crowded cap a
   pivot is elected, and nodes within half the linking angle of a pivot make a
   ball, in which all are linked with each other by the triangle inequality.
   Caps then hold balls.  Two balls are linked as a whole, or not at all,
   where the angles between and in them prove it; the others are compared in
   blocks of bounded size, which return counts, not pairs.  A cap with many
   balls is cut into parts that meet in tasks of their own.

Links are found with a probability, not for certain; those found are exact:
none has a cosine below ``LINK``.

Defined results: vectors that are null, empty or zero or have null or
non-finite components have no links and are components of their own, as are
rows without an id, whose component is null.  Rows without an id don't take
part.  Rows that share an id are vectors of their own; ``component_id`` is
the least id of the component.  Vectors of different lengths aren't linked.
An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache, partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_position
from .common import stored
from .components import components

LINK = 0.9
CAP_ROWS = 32
SHARED = 20.0             # caps that a pair at the linking cosine has in common, in the mean
BLOCKS, BLOCK_DIMS = 2, 8 # blocks of a code, each of at least so many dimensions
CODES = 32                # codes, each turned its own way
CROWDED = 4 * CAP_ROWS    # nodes of a cap that elects a pivot
PART = 512                # balls of a cap that are compared in one piece
BLOCK = 256               # nodes of a ball that are compared in one piece
CHUNK = 1024              # vectors decoded together
MARGIN = 1e-9             # radians kept clear of the linking angle in proofs
SEED = 20_250_113


# ----------------------------------------------------------- codes and caps --

def _tail(dim: int, t: np.ndarray) -> np.ndarray:
    """Share of the unit sphere whose inner product with a direction exceeds t."""
    if dim == 1:
        return np.where(t <= -1, 1.0, np.where(t < 1, 0.5, 0.0))
    angle = np.arccos(np.clip(t, -1, 1))
    grid = np.linspace(0, math.pi, 20_001)
    density = np.sin(grid) ** (dim - 2)
    area = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return np.interp(angle, grid, area / area[-1])


@lru_cache(maxsize=64)
def plan(n: int, dim: int, link: float = LINK) -> tuple[float, int]:
    """(threshold, directions) for n vectors."""
    share = min(0.25, CAP_ROWS / max(n, 1))
    low, high = 0.0, math.sqrt((1 + link) / 2) * 0.9     # no cap narrower than a pair needs
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _tail(dim, np.array(middle)) > share else (low, middle)
    alpha = low
    # chance that both ends of a pair at the linking cosine are in a cap
    grid = np.linspace(alpha, 1, 2001)[:-1]
    weight = -np.diff(np.append(_tail(dim, grid), 0.0))
    rest = (alpha - link * grid) / (math.sqrt(1 - link * link) * np.sqrt(1 - grid * grid))
    both = float((weight * _tail(max(dim - 1, 1), rest)).sum())
    return alpha, max(1, math.ceil(SHARED / both))


@lru_cache(maxsize=2 * CODES)
def _code(dim: int, k: int, per_block: int) -> tuple[np.ndarray, list]:
    """(rotation, unit vectors of each block) of the k-th code."""
    rng = np.random.default_rng([SEED, dim, k])
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    blocks = []
    for part in np.array_split(np.arange(dim), max(1, min(BLOCKS, dim // BLOCK_DIMS))):
        words = rng.normal(size=(per_block, len(part)))
        words *= math.sqrt(len(part) / dim) / np.linalg.norm(words, axis=1, keepdims=True)
        blocks.append((part, words))
    return turn, blocks


def decode(units: np.ndarray, alpha: float, directions: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cap) for every direction whose inner product exceeds ``alpha``."""
    dim = units.shape[1]
    m = max(1, min(BLOCKS, dim // BLOCK_DIMS))
    per_block = max(1, math.ceil((directions / CODES) ** (1 / m)))
    rows, caps = [], []
    for k in range(CODES):
        turn, blocks = _code(dim, k, per_block)
        turned = units @ turn
        inner = [turned[:, part] @ words.T for part, words in blocks]
        rest = np.cumsum([x.max(axis=1) for x in inner[::-1]], axis=0)[::-1]
        row, cap, total = np.arange(len(units)), np.full(len(units), k, np.int64), np.zeros(len(units))
        for j, x in enumerate(inner):
            # choices whose sum can still exceed the threshold
            sums = total[:, None] + x[row]
            need = alpha - (rest[j + 1][row] if j + 1 < len(inner) else 0.0)
            at, word = np.nonzero(sums > np.broadcast_to(need, len(row))[:, None])
            row, cap, total = row[at], cap[at] * per_block + word, sums[at, word]
        rows.append(row)
        caps.append(cap * CODES + k)
    return np.concatenate(rows), np.concatenate(caps)


# ------------------------------------------------------------------ vectors --

def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(lists: pa.Array):
    """(places, matrix) of the vectors of each length."""
    sizes = lists.value_lengths().to_numpy()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        for k in range(0, len(at), CHUNK):
            some = at[k:k + CHUNK]
            yield some, flat[(ends[some] - dim)[:, None] + np.arange(dim)].astype(np.float64)


def _list_caps(batches, n: int, link: float):
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        for at, x in _by_dim(batch.column(1)):
            row, cap = decode(_units(x), *plan(n, x.shape[1], link))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(row), x.shape[1], np.int32)), pa.array(cap), pa.array(nodes[at][row])],
                names=["dim", "cap", "node"])


def quantize(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit vectors, their scales, and bounds of what rounding changed."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(units - q * scale[:, None], axis=1) + 1e-12


def _round(batches):
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        for at, x in _by_dim(batch.column(1)):
            q, scale, slack = quantize(_units(x))
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[at]), pa.array([v.tobytes() for v in q], pa.binary()), pa.array(scale),
                pa.array(slack)], names=["node", "q", "scale", "slack"])


def _angles(cosine: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the angle from a cosine and a bound of its error."""
    return np.arccos(np.clip(cosine + error, -1, 1)), np.arccos(np.clip(cosine - error, -1, 1))


def _bytes(column: pa.Array) -> list:
    return [np.frombuffer(b, np.int8) for b in column.to_pylist()]


def _near_pivots(batches, radius: float):
    """(node, pivot, angle) where 8-bit vectors prove the angle at most ``radius``."""
    for batch in batches:
        node, pivot, s, e, ps, pe = (batch.column(c).to_numpy() for c in (
            "node", "pivot", "scale", "slack", "p_scale", "p_slack"))
        dots = np.array([int(a.astype(np.int32) @ b.astype(np.int32))
                         for a, b in zip(_bytes(batch.column("q")), _bytes(batch.column("p_q")))], np.float64)
        most = _angles(dots * s * ps, e + (1 + e) * pe)[1]
        near = most <= radius
        yield pa.RecordBatch.from_arrays([pa.array(x[near]) for x in (node, pivot, most)],
                                         names=["node", "pivot", "angle"])


# ---------------------------------------------------------------- cap joins --

_CELL = ["dim", "cap", "low", "high"]


def _compare(cell: dict, link: float):
    """(a, b, sure) of the balls of one piece of a cap that may be linked."""
    q = np.stack([np.frombuffer(b, np.int8) for b in cell["q"]]).astype(np.float64)
    ball, scale, slack, radius, part = (np.array(cell[c]) for c in ("ball", "scale", "slack", "radius", "part"))
    low, high = cell["low"][0], cell["high"][0]
    i = np.flatnonzero(part == low)
    j = i if low == high else np.flatnonzero(part == high)
    near, far = _angles((q[i] * scale[i, None]) @ (q[j] * scale[j, None]).T,
                        slack[i, None] + (1 + slack[i, None]) * slack[None, j])
    both = radius[i, None] + radius[None, j]
    limit = math.acos(link)
    x, y = np.nonzero(near - both <= limit + MARGIN)
    sure = (far + both)[x, y] <= limit - MARGIN
    a, b = ball[i[x]], ball[j[y]]
    keep = a < b if low == high else a != b
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep], sure[keep]


def _compare_cells(batches, link: float):
    """Streams rows sorted by cell; one cell of bounded size is held at a time."""
    names = (*_CELL, "ball", "part", "q", "scale", "slack", "radius")
    held: dict = {c: [] for c in names}
    found: list = []

    def flush():
        a, b, sure = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(np.stack([a, b, sure.astype(np.int64)], axis=1), axis=0)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                                           pa.array(pairs[:, 2] > 0)], names=["a", "b", "sure"])

    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in names}
        keys = list(zip(*(columns[c] for c in _CELL)))
        start = 0
        for k in range(1, len(keys) + 1):
            if k < len(keys) and keys[k] == keys[start]:
                continue
            if held["cap"] and tuple(held[c][0] for c in _CELL) != keys[start]:
                found.append(_compare(held, link))
                held = {c: [] for c in names}
            for c in names:
                held[c] += columns[c][start:k]
            start = k
        if sum(len(f[0]) for f in found) > 1 << 16:
            yield flush()
    if held["cap"]:
        found.append(_compare(held, link))
    if found:
        yield flush()


def _is_linked(x: np.ndarray, y: np.ndarray, link: float) -> np.ndarray:
    """Links between two sets of vectors, in double precision."""
    cosine = _units(x) @ _units(y).T
    linked = cosine >= link
    for i, j in np.argwhere(np.abs(cosine - link) < 1e-12):      # sums that don't depend on their order
        a, b = (v / np.abs(v).max() for v in (x[i], y[j]))
        linked[i, j] = math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b))) >= link
    return linked


def _count_links(batches, link: float):
    """(a, b, node, links): rows of two blocks of balls a and b, and how many
    vectors of the other ball each node is linked with."""
    for batch in batches:
        for r in range(batch.num_rows):
            one, two = (batch.column(c)[r].values for c in ("left", "right"))
            nodes, weights, x = [], [], []
            for side in (one, two):
                nodes.append(side.field("node").to_numpy())
                weights.append(side.field("m").to_numpy())
                x.append(side.field("x").flatten().to_numpy().reshape(len(side), -1).astype(np.float64))
            linked = _is_linked(x[0], x[1], link)
            links = np.concatenate([linked @ weights[1], linked.T @ weights[0]])
            some = links > 0
            a, b = batch.column("a")[r].as_py(), batch.column("b")[r].as_py()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(some.sum(), a)), pa.array(np.full(some.sum(), b)),
                pa.array(np.concatenate(nodes)[some]), pa.array(links[some])], names=["a", "b", "node", "links"])


# ------------------------------------------------------------------- driver --

def _keyed(rows: DataFrame) -> DataFrame:
    """(key, vec_id, x) of all rows with an id; ``key`` is unique and ascends
    with the id.  ``x`` is null for vectors that link with nothing."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) \
        & F.exists(x, lambda c: c != 0)
    out = rows.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(F.coalesce(fit, F.lit(False)), x).alias("x"))
    n, distinct = out.agg(F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    if n == distinct:
        return out.withColumn("key", F.col("vec_id"))
    return with_position(out.withColumn("h", F.xxhash64("x")), ["vec_id", "h"], pos_col="key").drop("h")


def _balls(nodes: DataFrame, cells: DataFrame, rounded: DataFrame, link: float) -> DataFrame:
    """(node, ball, angle): each node's ball and its angle to the ball's pivot."""
    pivots = (cells.groupBy("dim", "cap").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("k"))
              .where(F.col("k") > CROWDED).drop("k"))
    near = (cells.join(pivots, ["dim", "cap"]).where("node != pivot").select("node", "pivot").distinct()
            .join(rounded, "node")
            .join(rounded.select(F.col("node").alias("pivot"), *[F.col(c).alias(f"p_{c}") for c in (
                "q", "scale", "slack")]), "pivot")
            .mapInArrow(partial(_near_pivots, radius=math.acos(link) / 2 - MARGIN),
                        "node long, pivot long, angle double"))
    # a pivot may be nearer to an earlier one; its own ball still has it at its centre
    own = near.select(F.col("pivot").alias("node"), "pivot", F.lit(0.0).alias("angle")).distinct()
    head = near.union(own).groupBy("node").agg(F.min(F.struct("pivot", "angle")).alias("h"))
    return nodes.select("node", "m").join(head, "node", "left").select(
        "node", "m", F.coalesce("h.pivot", "node").alias("ball"), F.coalesce("h.angle", F.lit(0.0)).alias("angle"))


def _ball_pairs(cells: DataFrame, heads: DataFrame, balls: DataFrame, rounded: DataFrame, link: float) -> DataFrame:
    """(a, b, sure): balls that share a cap and may be linked."""
    held = stored(cells.join(heads.select("node", "ball"), "node").select("dim", "cap", "ball").distinct(), "caps")
    parts = (held.groupBy("dim", "cap").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
             .select("dim", "cap", F.ceil(F.col("k") / PART).cast("int").alias("parts")))
    centres = balls.select("ball", "radius").join(rounded.withColumnRenamed("node", "ball"), "ball")
    part = F.pmod(F.xxhash64("ball"), F.col("parts")).cast("int")
    dealt = (held.join(parts, ["dim", "cap"]).withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("dim", "cap", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                     "part", "ball").join(centres, "ball"))
    pairs = (dealt.repartition(*_CELL).sortWithinPartitions(*_CELL)
             .mapInArrow(partial(_compare_cells, link=link), "a long, b long, sure boolean"))
    return stored(pairs.groupBy("a", "b").agg(F.max("sure").alias("sure")), "ball-pairs")


def _blocks(nodes: DataFrame, heads: DataFrame, balls: DataFrame) -> DataFrame:
    """(ball, block, members): the vectors of a ball in pieces of about ``BLOCK``."""
    parts = balls.select("ball", F.ceil(F.col("n_nodes") / BLOCK).alias("blocks"))
    return (heads.select("node", "ball").join(parts, "ball").join(nodes, "node")
            .groupBy("ball", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
            .agg(F.collect_list(F.struct("node", "m", "x")).alias("members")))


def link_vectors(rows: DataFrame, link: float = LINK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    keyed = stored(_keyed(rows), "vectors")
    nodes = stored(keyed.where("x IS NOT NULL").groupBy("x")
                   .agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("m")).select("node", "m", "x"), "nodes")
    n = nodes.count()
    vectors = nodes.select("node", "x")
    cells = stored(vectors.mapInArrow(partial(_list_caps, n=n, link=link), "dim int, cap long, node long"), "cells")
    rounded = stored(vectors.mapInArrow(_round, "node long, q binary, scale double, slack double"), "rounded")
    heads = stored(_balls(nodes, cells, rounded, link), "heads")
    balls = stored(heads.groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("m").alias("weight"),
                                             F.count(F.lit(1)).alias("n_nodes"), F.min("node").alias("first")), "balls")
    pairs = _ball_pairs(cells, heads, balls, rounded, link)

    blocks = stored(_blocks(nodes, heads, balls), "blocks")
    unsure = pairs.where("NOT sure").select("a", "b")
    counted = stored(
        unsure.join(blocks.select(F.col("ball").alias("a"), F.col("members").alias("left")), "a")
        .join(blocks.select(F.col("ball").alias("b"), F.col("members").alias("right")), "b")
        .mapInArrow(partial(_count_links, link=link), "a long, b long, node long, links long"), "counts")
    sure = pairs.where("sure").select("a", "b")
    both = sure.union(sure.select("b", "a"))
    weight = balls.select(F.col("ball").alias("b"), "weight")
    ball_links = both.join(weight, "b").groupBy("a").agg(F.sum("weight").alias("whole")) \
        .withColumnRenamed("a", "ball")
    node_links = counted.groupBy("node").agg(F.sum("links").alias("some"))

    label = components(sure.union(counted.select("a", "b").distinct()))
    labelled = balls.join(label.withColumnRenamed("id", "ball"), "ball", "left") \
        .withColumn("component", F.coalesce("component", "ball"))
    least = labelled.groupBy("component").agg(F.min("first").alias("first_key"))
    of_ball = (labelled.join(least, "component").join(ball_links, "ball", "left")
               .select("ball", "first_key", (F.col("weight") - 1 + F.coalesce("whole", F.lit(0))).alias("inside")))
    of_node = (heads.select("node", "ball").join(of_ball, "ball").join(node_links, "node", "left")
               .select("node", "first_key", (F.col("inside") + F.coalesce("some", F.lit(0))).alias("n_links")))
    of_node = of_node.join(nodes.select("node", "x"), "node").select("x", "first_key", "n_links")
    ids = keyed.select(F.col("key").alias("first_key"), F.col("vec_id").alias("component_id"))
    linked = (keyed.where("x IS NOT NULL").join(of_node, "x").select("vec_id", "n_links", "first_key")
              .join(ids, "first_key").select("vec_id", "n_links", "component_id"))
    alone = keyed.where("x IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    nameless = rows.where(F.col("vec_id").isNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("component_id"))
    return linked.union(alone).union(nameless).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
