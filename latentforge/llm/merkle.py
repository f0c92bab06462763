"""Merkle manifest of a dataset with octopus multiproofs.

1. Every row is a leaf: the SHA-256 of its fields.  Rows of one language make
   a tree, in which two consecutive nodes (or a lone last one) are hashed into
   their parent; the trees' roots are the leaves of a last tree.
2. Trees grow by rounds.  A round takes blocks of ``2 ** LEVELS`` consecutive
   nodes, hashes each block up to its top, and leaves one node of each block
   for the next round; so a language that a third of the rows have is spread
   over as many tasks as it has blocks.  All nodes are stored as
   (tree, level, idx, hash).
3. To prove leaves, each partition (one block of positions) works out the
   smallest set of nodes that it can't derive from its own leaves, fetches
   these once, derives the interiors that its leaves share, and reads every
   single proof from them.

Positions come from the library's numbering, which sorts ranges and never all
rows of a language in one task.

Defined results: a null field is hashed as ``-``, so null and empty texts
differ.  Rows ascend by id, null ids first, and rows with one id by their leaf;
equal rows are leaves of their own.  An empty table has no nodes and no
proofs.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.positions import with_position
from .common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 12                        # a block has 2 ** LEVELS nodes
ROOTS = "/"                        # name of the tree over the trees' roots

NODES = "tree string, level int, idx long, hash string, n long"


def field(value: Column) -> Column:
    """A field as it is hashed: byte count and value, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: dict) -> Column:
    return F.sha2(F.concat(*[field(fields[c]) for c in FIELDS]), 256)


def tree_name(lang: Column) -> Column:
    """Name of a language's tree; names sort as the languages do, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def _height(n: Column) -> Column:
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def leaves(docs: DataFrame, **claims: Column) -> DataFrame:
    """(doc_id, tree, leaf, pos, n) of every row, and for each claim (a mapping
    of changed fields under a name) the leaf that the changed row would have."""
    own = {c: F.col(c) for c in FIELDS}
    rows = docs.select(F.col("doc_id"), tree_name(F.col("lang")).alias("tree"), digest(own).alias("leaf"),
                       *[digest({**own, **changed}).alias(name) for name, changed in claims.items()])
    return with_position(rows, ["doc_id", "leaf"], partition_by=["tree"], size_col="n")


def parents(hashes: list) -> list:
    """Hashes of the runs of two consecutive nodes."""
    return [sha256("".join(hashes[k:k + 2]).encode()).hexdigest() for k in range(0, len(hashes), 2)]


def _grow(level: int):
    def block(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        table = table.sort_by("idx")
        first = table.column("idx")[0].as_py()
        hashes = table.column("hash").to_pylist()
        out: dict = {"level": [], "idx": [], "hash": []}
        for up in range(level + 1, min(level + LEVELS, (n - 1).bit_length()) + 1):
            hashes, first = parents(hashes), first >> 1
            out["level"] += [up] * len(hashes)
            out["idx"] += range(first, first + len(hashes))
            out["hash"] += hashes
        size = len(out["idx"])
        return pa.table([pa.array([table.column("tree")[0].as_py()] * size, pa.string()),
                         pa.array(out["level"], pa.int32()), pa.array(out["idx"], pa.int64()),
                         pa.array(out["hash"], pa.string()), pa.array([n] * size, pa.int64())],
                        names=["tree", "level", "idx", "hash", "n"])
    return block


def grow(bottom: DataFrame) -> DataFrame:
    """All nodes (tree, level, idx, hash, n) above and with the leaves
    (tree, idx, hash, n); ``n`` is the number of leaves of the tree."""
    nodes = bottom.select("tree", F.lit(0).alias("level"), "idx", "hash", "n")
    most = bottom.agg(F.max("n")).first()[0] or 0
    current, level = nodes, 0
    while (most - 1).bit_length() > level and most:
        blocks = current.where(_height(F.col("n")) > level) \
            .withColumn("block", F.floor(F.col("idx") / (1 << LEVELS)))
        grown = stored(blocks.groupBy("tree", "block").applyInArrow(_grow(level), NODES), "nodes")
        nodes, level = nodes.union(grown), level + LEVELS
        current = grown.where(F.col("level") == level)
    return nodes


def manifest(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all nodes, trees) of placed leaves (tree, pos, n, leaf).

    ``trees`` has each tree's place ``at`` among the ``trees`` roots.
    """
    lower = stored(grow(placed.select("tree", F.col("pos").alias("idx"), F.col("leaf").alias("hash"), "n")), "trees")
    roots = lower.where(F.col("level") == _height(F.col("n"))).select("tree", "hash")
    trees = stored(with_position(roots, ["tree"], pos_col="at", size_col="trees"), "roots")
    upper = grow(trees.select(F.lit(ROOTS).alias("tree"), F.col("at").alias("idx"), "hash",
                              F.col("trees").alias("n")))
    return lower.union(stored(upper, "upper")), trees


def missing(idx: np.ndarray, n: int) -> tuple[list, list]:
    """(levels, indexes) of the nodes that a proof of all leaves ``idx`` of a
    tree of ``n`` needs and that can't be derived from these leaves."""
    known, levels, out = np.unique(idx), [], []
    for level in range((n - 1).bit_length()):
        beside = known ^ 1
        need = beside[(beside < -(-n >> level)) & ~np.isin(beside, known, assume_unique=True)]
        levels += [level] * len(need)
        out += need.tolist()
        known = np.unique(known >> 1)
    return levels, out


def _requests(table: pa.Table) -> pa.Table:
    tree, block, n, at, trees = (table.column(c)[0].as_py() for c in ("tree", "block", "n", "at", "trees"))
    levels, idx = missing(table.column("pos").to_numpy(), n)
    top_levels, top = missing(np.array([at]), trees)
    names = [tree] * len(idx) + [ROOTS] * len(top)
    return pa.table([pa.array([tree] * len(names), pa.string()), pa.array([block] * len(names), pa.int64()),
                     pa.array(names, pa.string()), pa.array(levels + top_levels, pa.int32()),
                     pa.array(idx + top, pa.int64())], names=["for_tree", "block", "tree", "level", "idx"])


def derive(known: dict, n: int, fetched: dict) -> list:
    """Nodes by level, as dicts index -> hash, from some leaves of a tree and
    the fetched nodes {(level, idx): hash}."""
    out = []
    for level in range((n - 1).bit_length() + 1):
        here = dict(known)
        here.update((i, h) for (l, i), h in fetched.items() if l == level)
        out.append(here)
        last = -(-n >> level) - 1
        known = {i >> 1: sha256((here[i & ~1] + (here[i | 1] if i | 1 <= last else "")).encode()).hexdigest()
                 for i in known}
    return out


def _paths(nodes: list, idx: np.ndarray) -> list:
    """Siblings of each index level by level; None where the run is one node."""
    return [[level.get(i >> k ^ 1) for i in idx.tolist()] for k, level in enumerate(nodes[:-1])]


def _expand(table: pa.Table, fetched: pa.Table) -> pa.Table:
    if not len(table):
        return None
    n, at, trees = (table.column(c)[0].as_py() for c in ("n", "at", "trees"))
    found: dict = {}
    for name, level, i, h in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx", "hash"))):
        found.setdefault(name == ROOTS, {})[level, i] = h
    pos = table.column("pos").to_numpy()
    own = derive(dict(zip(pos.tolist(), table.column("leaf").to_pylist())), n, found.get(False, {}))
    top = derive({at: own[-1][0]}, trees, found.get(True, {}))
    columns = _paths(own, pos) + [[h] * len(pos) for (h,) in _paths(top, np.array([at]))]
    proofs = list(zip(*columns)) if columns else [()] * len(pos)
    out = table.append_column("subroot", pa.array([own[-1][0]] * len(pos), pa.string()))
    out = out.append_column("root", pa.array([top[-1][0]] * len(pos), pa.string()))
    return out.append_column("proof", pa.array(proofs, pa.list_(pa.string())))


def prove(wanted: DataFrame, nodes: DataFrame, trees: DataFrame) -> DataFrame:
    """``wanted`` placed leaves (tree, pos, n, leaf, ...) with ``subroot``,
    ``root`` and ``proof``, the siblings from the leaf to the root; an entry is
    null where a node has none.  ``at`` and ``trees`` give the tree's place."""
    placed = (wanted.join(trees.select("tree", "at", "trees"), "tree")
              .withColumn("block", F.floor(F.col("pos") / (1 << LEVELS))))
    asked = stored(placed.select("tree", "block", "pos", "n", "at", "trees").groupBy("tree", "block").applyInArrow(
        _requests, "for_tree string, block long, tree string, level int, idx long"), "asked")
    least = asked.agg(F.min("level")).first()[0] or 0
    fetched = (asked.join(nodes.where(F.col("level") >= least).select("tree", "level", "idx", "hash"),
                          ["tree", "level", "idx"])
               .select("for_tree", "block", "tree", "level", "idx", "hash"))
    schema = T.StructType([*placed.schema.fields, T.StructField("subroot", T.StringType()),
                           T.StructField("root", T.StringType()),
                           T.StructField("proof", T.ArrayType(T.StringType()))])
    return placed.groupBy("tree", "block").cogroup(fetched.groupBy("for_tree", "block")) \
        .applyInArrow(_expand, schema).drop("block")


def fold(leaf: Column, proof: Column = None) -> Column:
    """Root that a leaf gives with the siblings of its proof; which side a
    sibling is on follows from ``pos`` in the tree and from ``at`` above."""
    proof = F.col("proof") if proof is None else proof
    height = _height(F.col("n"))
    steps = F.transform(proof, lambda h, k: F.struct(h.alias("h"), F.pmod(F.when(
        k < height, F.call_function("shiftright", F.col("pos"), k)).otherwise(
        F.call_function("shiftright", F.col("at"), k - height)), F.lit(2)).alias("right")))
    return F.aggregate(steps, leaf, lambda done, s: F.sha2(
        F.when(s["h"].isNull(), done).when(s["right"] == 1, F.concat(s["h"], done))
        .otherwise(F.concat(done, s["h"])), 256))
