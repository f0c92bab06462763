import hashlib
import random

from pyspark.sql import functions as F

from latentforge.llm import suffix_dedup as sd
from latentforge.llm.queries import QUERIES


def brute(rows, length=100):
    """First start of every string of ``length`` bytes, in corpus order."""
    seen, out = set(), []
    for d, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()),
                  key=lambda r: (r[0] is not None, r))


def test_query_equals_brute_force(spark, sf):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(map(tuple, QUERIES["op4_prefix_free_parsing"](spark, sf).collect()))
    assert got == brute(rows)


def corpus(seed):
    """Low-entropy texts with passages of about the window length in common."""
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefgh é", "x"])
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.choice([60, 85, 99, 100, 101, 130, 300])))
                for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(0, 7)):
            parts.append(rng.choice(passages) if rng.random() < 0.6
                         else "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(0, 90))))
        texts.append("".join(parts))
    texts += ["é" * 130, "é" * 131, "a" * 99, "a" * 100, "a" * 101, "ab" * 400, "", texts[0], texts[1], texts[1]]
    return list(enumerate(texts))


def test_random_corpora(spark):
    for seed in range(4):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS doc").repartition(3)
        assert result(sd.judge(df)) == sorted(brute(rows))


def test_text_longer_than_a_chunk(spark):
    rng = random.Random(5)
    unit = "".join(rng.choice("abcdefghijklmnop") for _ in range(700_000))
    rows = [(1, unit + "q" * 3000 + unit[:500_000]), (2, unit[600_000:] + unit[:10_000]), (3, unit[5:300])]
    assert result(sd.judge(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_missing_and_equal_ids(spark):
    x, y = "0123456789" * 15, "abcdefghij" * 3 + "".join(map(str, range(60)))
    rows = [(None, x), (None, None), (3, x), (3, y), (3, y), (4, "")]
    got = result(sd.judge(spark.createDataFrame(rows, "doc_id long, text string")))
    order = [(None, None), (None, x), (3, x), (3, y), (3, y), (4, "")]
    assert got == sorted(brute(order), key=lambda r: (r[0] is not None, r))


def test_empty_table(spark):
    assert sd.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_strip_keeps_whole_characters_and_columns(spark):
    text = "é" * 40 + "".join(chr(0x4E00 + i) for i in range(60))
    df = spark.createDataFrame([(1, "a" + text, 5, "de"), (2, "bc" + text + "tail", 6, None), (3, text, 1, "x"),
                                (4, "", 0, "y"), (5, None, None, "z")],
                               "doc_id long, text string, n_chars long, doc string")
    out = {r["doc_id"]: r for r in sd.strip(df).collect()}
    assert set(out) == {1, 2, 4, 5} and out[1]["text"] == "a" + text and out[4]["text"] == ""
    assert out[2]["text"] == "bctail" and out[2]["n_chars"] == 6 and out[1]["doc"] == "de" and out[5]["text"] is None
