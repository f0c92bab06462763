import math

import duckdb
import numpy as np
import pytest

from latentforge.llm import spherical_caps as sc
from latentforge.llm.oracle import ORACLES
from latentforge.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, link=0.9):
    """Every pair, in double precision: (id, links, component, kept) by row."""
    ids = [r[0] for r in rows]
    fit = [k for k, (i, e) in enumerate(rows) if i is not None and e and any(e)
           and all(c is not None and math.isfinite(c) for c in e)]
    x = {k: np.array(rows[k][1], np.float32).astype(float) for k in fit}
    root = {k: k for k in range(len(rows))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    links = [0] * len(rows)
    for size in {len(x[k]) for k in fit}:
        some = [k for k in fit if len(x[k]) == size]
        m = np.stack([x[k] / np.linalg.norm(x[k]) for k in some])
        for i, j in np.argwhere(np.triu(m @ m.T >= link, 1)):
            links[some[i]] += 1
            links[some[j]] += 1
            root[find(some[i])] = find(some[j])
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = [(i, links[k], least.get(find(k)), i is None or least[find(k)] == i) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def near(rng, centre, cosine):
    """A vector with the given cosine to a unit vector."""
    z = rng.normal(size=len(centre))
    z -= (z @ centre) * centre
    return cosine * centre + math.sqrt(1 - cosine * cosine) * z / np.linalg.norm(z)


def unit(rng, dim=64):
    v = rng.normal(size=dim)
    return v / np.linalg.norm(v)


def frame(spark, vectors, ids=None):
    rows = [(i, [float(np.float32(c)) for c in v] if v is not None else None)
            for i, v in zip(ids or range(len(vectors)), vectors)]
    return rows, spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "'x' AS ball", "2 AS m", "3 AS node")


def test_query_equals_brute_force_and_sql(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    mine = got(QUERIES["op13_spherical_caps"](spark, sf))
    assert mine == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert mine == sorted(con.sql(f"SELECT vec_id, n_links, component_id, kept FROM ({ORACLES['op13_spherical_caps']})"
                                  ).fetchall(), key=str)


def test_copies_near_copies_and_chains(spark, monkeypatch):
    monkeypatch.setattr(sc, "PART", 16)
    monkeypatch.setattr(sc, "BLOCK", 8)
    rng = np.random.default_rng(1)
    v = [unit(rng) for _ in range(200)]
    v += [v[0] * k for k in (1, 1, 2, 0.5)]                              # copies, also of other lengths
    for c in (0.999, 0.98, 0.97, 0.955):                                 # groups from tight to loose
        centre = unit(rng)
        v += [near(rng, centre, c) for _ in range(200)]
    chain = unit(rng)
    for _ in range(12):                                                  # each near the one before only
        chain = near(rng, chain, 0.93)
        v.append(chain)
    rows, df = frame(spark, v, [int(x) for x in rng.permutation(len(v)) * 3])
    mine, want = got(sc.link_vectors(df)), brute(rows)
    assert mine == want
    assert len({r[2] for r in want}) < len(v) - 700


def test_links_at_the_limit_are_found_with_a_high_recall(spark):
    rng = np.random.default_rng(2)
    v = [unit(rng) for _ in range(1500)]
    v += [near(rng, x, 0.9005) for x in v[:1500]]
    rows, df = frame(spark, v)
    want, mine = dict((r[0], r[1]) for r in brute(rows)), dict((r[0], r[1]) for r in got(sc.link_vectors(df)))
    assert all(mine[k] <= want[k] for k in want)
    assert sum(mine.values()) >= 0.99 * sum(want.values()) > 2900


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    a = unit(rng)
    v = [None, [], [0.0] * 64, [nan] + [1.0] * 63, [inf] * 64, [None] + [1.0] * 63, list(a), list(a * 1e30), list(-a),
         [1.0], [2.0], [-1.0], [1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1.0] * 3, [1.0, 1.0, 0.9], list(a * 1e-30)]
    rows = [(i, None if x is None else [None if c is None else float(np.float32(c)) for c in x]) for i, x in enumerate(v)]
    assert got(sc.link_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(4)
    a, b, c = (unit(rng) for _ in range(3))
    v = [a, a, near(rng, a, 0.97), b, b, near(rng, b, 0.97), c, a]
    rows, df = frame(spark, v, [5, 5, 9, 5, 7, 3, None, None])
    assert got(sc.link_vectors(df)) == brute(rows)


def test_empty_table(spark):
    assert sc.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("dim", [1, 2, 5, 16, 20, 64])
def test_decoding_lists_all_exceeding_directions(dim):
    rng = np.random.default_rng(dim)
    u = np.stack([unit(rng, dim) for _ in range(40)])
    alpha, directions = sc.plan(2000, dim)
    got_ = set(zip(*(x.tolist() for x in sc.decode(u, alpha, directions))))
    m = max(1, min(sc.BLOCKS, dim // sc.BLOCK_DIMS))
    per = max(1, math.ceil((directions / sc.CODES) ** (1 / m)))
    for k in range(sc.CODES):
        turn, blocks = sc._code(dim, k, per)
        for cap in range(per ** m):
            words = [cap // per ** (m - 1 - j) % per for j in range(m)]
            d = np.concatenate([w[i] for (_, w), i in zip(blocks, words)])
            assert abs(np.linalg.norm(d) - 1) < 1e-9
            label = k
            for w in words:
                label = label * per + w
            want = set(np.flatnonzero((u @ turn) @ d > alpha).tolist())
            assert {r for r in range(40) if (r, label * sc.CODES + k) in got_} == want


def test_bounds_of_rounding_hold():
    rng = np.random.default_rng(6)
    u = np.stack([unit(rng) for _ in range(100)])
    q, scale, slack = sc.quantize(u)
    v = q * scale[:, None]
    assert (np.abs(v @ v.T - u @ u.T) <= slack[:, None] + (1 + slack[:, None]) * slack[None]).all()
