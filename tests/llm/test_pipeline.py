import random
import re

import pytest

import corpus_pipeline as cp
from latentforge.llm import near_dedup, packing, quality_rules, secrets, suffix_dedup
from tests.llm.test_op2_secrets import base as base_secrets
from tests.llm.test_op3_near_dedup import brute as near_brute
from tests.llm.test_op5_op6_op8 import check_packing


def strip_brute(rows, length=100):
    """Cut strings that start earlier, whole characters only."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        b = text.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        at, kept = 0, []
        for c in text:
            n = len(c.encode())
            if not all(gone[at:at + n]):
                kept.append(c)
            at += n
        if kept or not text:
            out[d] = "".join(kept)
    return out


@pytest.fixture(scope="module")
def staged(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], sf).checkpoint())
    return out


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_dedup", "suffix_dedup", "secret_scan", "best_fit_packing"]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_each_stage_against_brute_force(spark, staged):
    for df in staged[1:-1]:
        assert df.columns == staged[0].columns and df.dtypes == staged[0].dtypes
    t = [texts(df) for df in staged[:-1]]
    kept = {r["doc_id"] for r in quality_rules.judge(staged[0]).where("kept").collect()}
    assert t[1] == {d: x for d, x in t[0].items() if d in kept}
    firsts = {d for d, (_, _, first) in near_brute(list(t[1].items()), cp.LINK).items() if first}
    assert t[2] == {d: x for d, x in t[1].items() if d in firsts}
    assert t[3] == strip_brute(list(t[2].items()))
    assert set(t[4]) == set(t[3])
    for d, x in t[4].items():
        assert not base_secrets(x)
        plain = t[3][d]
        if x != plain:
            gaps = [re.escape(p) for p in x.split("[SECRET]")]
            assert re.fullmatch(".+".join(gaps), plain, re.S)
    assert sum(x != t[3][d] for d, x in t[4].items()) >= sum(bool(base_secrets(x)) for x in t[3].values()) > 0
    check_packing(list(t[4].items()), staged[-1].collect(), packing.CAPACITIES)


def test_n_chars_follows_the_text(staged):
    for df in staged[1:-1]:
        assert all(r["n_chars"] == len(r["text"]) for r in df.collect())


def test_run_gives_the_same_rows(spark, sf, staged):
    a, b = (sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length").collect())
            for df in (cp.run(spark, sf), staged[-1]))
    assert a == b


def test_empty_and_null_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    path = str(tmp_path / "d")
    spark.createDataFrame([], schema).write.parquet(f"{path}/documents.parquet")
    assert cp.run(spark, path).count() == 0
    path = str(tmp_path / "e")
    good = "The words of the text are in the order of " + " ".join(f"word{i} and the" for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (3, good, "en", "s", len(good)), (3, good, "en", "s", 1),
            (None, good + " token = abcdefabcdefabcdef", None, None, 9)]
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    assert cp.run(spark, path).count() > 0


def test_near_duplicates_from_four_fifths_on(spark):
    def text(group, own, n):
        return " ".join([f"g{group}w{i}" for i in range(104)] + [f"g{group}{own}{i}" for i in range(n)])
    rows = [(1, text(1, "a", 10)), (2, text(1, "b", 10)),        # 100 common of 120 shingles
            (3, text(2, "a", 12)), (4, text(2, "b", 13)),        # 100 of 125
            (5, text(3, "a", 13)), (6, text(3, "b", 13))]        # 100 of 126
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in cp.near_duplicates(spark, docs, "").collect()) == [1, 3, 5, 6]
    assert {d for d, (_, _, first) in near_brute(rows, 80).items() if first} == {1, 3, 5, 6}


def test_near_duplicates_of_the_table_against_brute_force(staged):
    before, after = texts(staged[1]), texts(staged[2])
    firsts = {d for d, (_, _, first) in near_brute(list(before.items()), 80).items() if first}
    assert after == {d: x for d, x in before.items() if d in firsts}


def test_stages_carry_columns_of_any_name(spark):
    """Extra columns that are named like the operators' own stay as they are."""
    names = ["_kept", "_bytes", "_doc", "_copy", "row", "kept_text", "n_bytes", "gone", "_gone", "spans", "_measures",
             "kept", "n_words", "component_id", "set_key", "doc"]
    good = "The words of the text are in the order of " + " ".join(f"word{i} and the" for i in range(60))
    rows = [(1, good), (2, good), (3, good[::-1] + " token = abcdefabcdefabcdef"), (None, None), (3, "")]
    docs = spark.createDataFrame([r + tuple(f"{r[0]}-{n}" for n in names) for r in rows],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))

    def extras(df):
        assert df.columns == docs.columns
        return {(r["doc_id"], *(r[n] for n in names)) for r in df.collect()}
    every = extras(docs)
    for out in (suffix_dedup.strip(docs), near_dedup.dedup(docs), secrets.redact(docs, secrets.train(docs)),
                quality_rules.keep_good(docs)):
        assert extras(out) <= every
    judged = quality_rules.judge(docs)
    assert {(r["doc_id"], r["_measures"], r["spans"]) for r in judged.collect()} == {
        (d, f"{d}-_measures", f"{d}-spans") for d, _ in rows}


def test_secret_stage_of_many_identifiers_without_a_letter(spark):
    """No identifier has a ``j``: the model's least probabilities are under 1e-6, not zero."""
    rng = random.Random(5)
    letters, signs = "abcdefghiklmnopqrstuvwxyz", "abcdefghiklmnopABCDEFGHIKLMNOP0123456789"
    texts = [" ".join("".join(rng.choices(letters, k=41)) for _ in range(50)) for _ in range(100)]
    keys = ["token=" + "".join(rng.choices(signs, k=32)) for _ in range(50)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts + keys)],
                                 "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.secret_scan(spark, docs, "").collect()}
    assert [out[i] for i in range(100, 150)] == [("[SECRET]", 8)] * 50
    assert len(out) == 150
