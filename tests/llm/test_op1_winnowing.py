import hashlib
import re

import pytest
from pyspark.sql import functions as F

from latentforge.llm import winnowing as wn
from latentforge.llm.queries import QUERIES


def edited(text, nxt):
    n = len(text)
    return text[:n - n // 2] + nxt[:n // 2]


def chosen(spark, texts):
    """Brute force over token hashes taken from Spark's own hash function."""
    token = re.compile(wn.TOKEN)
    toks = [token.findall(t) for t in texts]
    grams = sorted({tuple(ts[i:i + wn.K]) for ts in toks for i in range(max(1, len(ts) - wn.K + 1)) if ts})
    df = spark.createDataFrame([(list(g),) for g in grams], "g array<string>")
    hashed = {tuple(r[0]): r[1] for r in df.select("g", F.shiftrightunsigned(
        F.xxhash64(*[F.xxhash64(F.get("g", F.lit(j))) if False else F.when(
            F.size("g") > j, F.xxhash64(F.get("g", F.lit(j)))) for j in range(wn.K)]), 33)).collect()}
    out = []
    for ts in toks:
        hs = [hashed[tuple(ts[i:i + wn.K])] for i in range(max(1, len(ts) - wn.K + 1))] if ts else []
        picks = []
        for s in range(max(1, len(hs) - wn.W + 1) if hs else 0):
            win = hs[s:s + wn.W]
            p = s + max(i for i, h in enumerate(win) if h == min(win))
            if not picks or picks[-1] != (hs[p], p):
                picks.append((hs[p], p))
        out.append(picks)
    return out


def as_text(picks):
    return ",".join(f"{h:x}:{p}" for h, p in picks)


def like(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def check(spark, rows, result):
    texts = [t or "" for _, t in rows]
    eds = [edited(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    fps = chosen(spark, texts + eds)
    got = {r["doc_id"]: r for r in result.collect()}
    assert len(got) == len(rows)
    for i, (d, _) in enumerate(rows):
        r, own, ed = got[d], fps[i], fps[len(texts) + i]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(eds[i].encode()).hexdigest()
        assert r["fingerprint"] == as_text(own)
        assert r["edited_fingerprint"] == as_text(ed)
        assert r["near_edited"] == pytest.approx(like(own, ed))
        assert r["near_next"] == pytest.approx(like(own, fps[(i + 1) % len(texts)]))


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
            .orderBy("doc_id").collect()]
    check(spark, rows, QUERIES["op1_winnowing"](spark, sf))


@pytest.mark.parametrize("bucket", [1, 2, 1024])
def test_odd_texts_over_ranges(spark, tmp_path, monkeypatch, bucket):
    monkeypatch.setattr(wn, "BUCKET_ROWS", bucket)
    rows = [(-5, None), (1, ""), (2, "one"), (3, " \t\n"), (4, "a b c d e f g h i j k l m n " * 50),
            (90, "same same same same same same same same same same same same same"), (91, "\U0001f600" * 40),
            (1000, "漢字かな交じり文の長い列" * 3), (1001, "x" * 200_000)]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS fp", "2 AS next").write.parquet(f"{path}/documents.parquet")
    check(spark, rows, QUERIES["op1_winnowing"](spark, path))


def test_empty_table_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "d")
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{path}/documents.parquet")
    assert QUERIES["op1_winnowing"](spark, path).count() == 0
    rows = spark.createDataFrame([(None, "b"), (None, "b"), (2, "c d")], "doc_id long, text string")
    nxt = wn.with_next(rows, ["text"]).collect()
    assert len(nxt) == 3 and {(r["doc_id"], r["next"]["text"]) for r in nxt} == {(None, "b"), (None, "c d"), (2, "b")}
