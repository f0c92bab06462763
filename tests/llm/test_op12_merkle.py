import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.llm import merkle
from latentforge.llm.oracle import ORACLES
from latentforge.llm.queries import QUERIES

COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, text, lang, source, n):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    return [((row[i >> k ^ 1] if i >> k ^ 1 < len(row) else ""), i >> k & 1) for k, row in enumerate(tree[:-1])]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf(*r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (d, own, r) in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, at)
            claim = own
            if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 and r[4] is not None:
                claim = leaf(*r[:4], r[4] + 1)
            for s, right in steps:
                claim = h(s, claim) if right else h(claim, s)
            root = top[-1][0]
            out.append((d, own, trees[g][-1][0], root, h(*[s for s, _ in steps]), claim, claim == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


def save(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_equals_brute_force_and_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    mine = got(QUERIES["op12_octopus_manifest"](spark, sf))
    assert mine == brute([tuple(r) for r in docs.collect()])
    assert 0 < sum(not r[-1] for r in mine) < len(mine) / 4
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert mine == sorted(con.sql(f"SELECT {', '.join(COLS)} FROM ({ORACLES['op12_octopus_manifest']})").fetchall(),
                          key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 33, 150])
def test_small_blocks_of_every_size(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)           # several rounds
    rng = random.Random(n)
    rows = [(d, f"t{d}", rng.choice(["en", "en", "en", "de", None, "ü"]), "s", d) for d in rng.sample(range(10_000), n)]
    assert got(QUERIES["op12_octopus_manifest"](spark, save(spark, rows, tmp_path))) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(7, None, None, None, None), (7, "", "", "", 0), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1),
            (3, "a:b-é\U0001f600", "en", None, None), (3, "a", "en", "s", None), (3, "a", "en", "s", None),
            (-14, "long " * 50_000, "en", "s", 2 ** 63 - 1), (0, "-", "-", "-", 0)]
    path = save(spark, [r + ("x", 1) for r in rows], tmp_path, SCHEMA + ", leaf string, pos int")
    want = [r for r in brute(rows) if r[0] != -14]
    mine = got(QUERIES["op12_octopus_manifest"](spark, path))
    assert [r for r in mine if r[0] != -14] == want and len(mine) == len(rows)


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_octopus_manifest"](spark, save(spark, [], tmp_path)).count() == 0


def test_proofs_of_a_few_leaves(spark, monkeypatch):
    """Leaves of any subset are proved with the nodes that they miss only."""
    monkeypatch.setattr(merkle, "LEVELS", 3)
    rows = [(d, f"t{d}", "de" if d % 3 else "en", "s", d) for d in range(77)]
    placed = merkle.leaves(spark.createDataFrame(rows, SCHEMA)).checkpoint()
    nodes, trees = merkle.manifest(placed)
    some = [0, 1, 5, 40, 41, 75, 76]
    proved = merkle.prove(placed.where(F.col("doc_id").isin(some)), nodes, trees)
    out = proved.select("doc_id", "root", merkle.fold(F.col("leaf")).alias("folded")).collect()
    assert sorted(r["doc_id"] for r in out) == some
    assert {r["root"] for r in out} == {r["folded"] for r in out} == {brute(rows)[0][3]}


def test_the_missing_nodes_are_the_fewest():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 40)
        idx = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
        coords = list(zip(*merkle.missing(np.array(idx), n)))
        tree = levels([h(str(i)) for i in range(n)])
        have = {(0, i) for i in idx} | set(coords)
        for k, row in enumerate(tree[:-1]):
            for i in range(len(row)):
                if (k, i) in have and (i ^ 1 >= len(row) or (k, i ^ 1) in have):
                    have.add((k + 1, i >> 1))
        assert (len(tree) - 1, 0) in have
        # none of them is an ancestor of a leaf that is proved or can be derived from others
        ancestors = {(k, i >> k) for i in idx for k in range(len(tree))}
        assert not ancestors & set(coords) and len(set(coords)) == len(coords)
        assert all((k, i ^ 1) in ancestors for k, i in coords)
