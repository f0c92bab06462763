import hashlib
import re

import numpy as np
import pytest

from latentforge.llm import pii
from latentforge.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(ds):
    s = 0
    for i, d in enumerate(ds[::-1]):
        s += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return s % 10 == 0


def base(text):
    t = text or ""
    return ([("email", *m.span()) for m in EMAIL.finditer(t)]
            + [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
            + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15])


ODD = [None, "", "@", "a@b", "a@b.c@d.e_f@g.h.i", "é.x@y-z.co.uk, 1.2.3.4.5.6.7.8 and 256.1.1.1 0001.2.3.04",
       "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112", "+1 (017) 555-7713 +49 30 1234567. +1+2+3 +12",
       "\U0001f600 +1 234 567 8901", "1" * 50_000, "a" * 50_000 + "@", "a.b@c." * 2000, "1.1.1.1 " * 3000, "+1 " * 5000,
       "user%+x@host.example.com.", "..@..", "5.5.5 .5 12.34.56.78.", "x [at] host.org (at) 123-45-6789 DE89 3704 0044 0532 0130 00"]


def check(rows, result):
    got = {r["doc_id"]: r for r in result.collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        want, r = base(text), got[d]
        text_of = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(text_of.encode()).hexdigest(), (d, text_of[:200], r["spans"][:200])
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(x[0] == k for x in want) for k in ("email", "ip", "card", "phone")]
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        more = [(int(s), int(e)) for k, s, e in spans if k == "other"]
        assert [(k, int(s), int(e)) for k, s, e in spans if k != "other"] == want and more == sorted(more)
        assert all(e1 <= s2 for (_, e1), (s2, _) in zip(more, more[1:]))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op10_boosted_pii"](spark, sf))


def test_odd_texts(spark, tmp_path):
    rows = list(enumerate(ODD))
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans").write.parquet(
        f"{path}/documents.parquet")
    check(rows, QUERIES["op10_boosted_pii"](spark, path))


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    assert QUERIES["op10_boosted_pii"](spark, path).count() == 0


def test_trees_learn_a_rule_and_find_other_spellings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = pii.boost(x[:3000], y[:3000])
    assert ((pii.probability(model, x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    trees = pii.train(docs)
    texts = ["call (017) 555-7713 now", "write to jane.roe [at] mail7.example.com please", "Version 2.0. of 2024",
             "ordinary words and nothing else", "token 123 and 4567"]
    found = pii.added(texts, [pii.base_spans(t) for t in texts], trees)
    assert [len(f) for f in found] == [1, 1, 0, 0, 0]


def test_commoner_spans_than_base_matches_are_found_in_the_trained_table(spark):
    rng = np.random.default_rng(2)

    def d(n):
        return "".join(map(str, rng.integers(0, 10, n)))
    base_rows = [f"call +1 ({d(3)}) 555-{d(4)} now" for _ in range(30)] + [f"write to u{d(5)}@h{d(2)}.org please" for _ in range(30)]
    planted = [x for _ in range(150) for x in (
        ("call ", f"({d(3)}) 555-{d(4)}"), ("write to ", f"u{d(5)} [at] h{d(2)}.org"),
        ("pay to ", f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)}"))
        if not pii.base_spans(x[1])]           # an account whose digits pass for a card is one already
    ordinary = [f"key 0{d(9)}abcdef" for _ in range(100)] + [f"number 9{d(24)} here" for _ in range(100)]
    texts = [a + b + " now" for a, b in planted] + ordinary
    docs = spark.createDataFrame(list(enumerate(base_rows + texts)), "doc_id long, text string")
    found = pii.added(texts, [pii.base_spans(t) for t in texts], pii.train(docs))
    assert [[(s, e) for _, s, e in f] for f in found[:len(planted)]] == [[(len(a), len(a + b))] for a, b in planted]
    assert not any(found[len(planted):])


PLAIN = ["the city has 8 336 817 people", "from 1990-1991 2000 on", "on 2024-01-05 it rained", "mix 100/200/300 parts",
         "a sum of 12.345.678 was paid", "isbn 978-3-16-148410-0 is out", "version 10.2.3.44.5 came",
         "between 1914-1918 and later", "rows 10 20 30 40 in all", "5 000 000 000 years ago", "on 05.11.1989 the wall fell",
         "count of 1234567 items", "there were 25000000 of them", "see 1999/2000 for more", "in 2001 2005 2009 again",
         "at 2024-01-05 12.30 sharp", "page 12-13 of 4567890", "1 000 000 copies sold", "dated 31/12/1999 here"]
PERSONAL = ["call (017) 555-7713 now", "write to jane.roe [at] mail7.example.com please",
            "reach me at (030) 555 1234 today", "phone: 017 555-7713 ask", "jane.roe(at)host.org",
            "pay to DE89 3704 0044 0532 0130 now"]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_ordinary_numbers_are_no_personal_data(spark, sf):
    """Dates, amounts, spans, lists and counts in the trained table are left
    alone, and personal data beside them is found."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    own = spark.createDataFrame([(10 ** 12 + k, t) for k, t in enumerate(PLAIN + PERSONAL)], "doc_id long, text string")
    trees = pii.train(docs.union(own))

    def found(texts):
        return [[t[a:b] for _, a, b in x] for t, x in zip(texts, pii.added(texts, [pii.base_spans(t) for t in texts], trees))]
    assert sum(map(len, found(PLAIN))) == 0
    assert [x[0] if x else None for x in found(PERSONAL)] == [
        "(017) 555-7713", "jane.roe [at] mail7.example.com", "(030) 555 1234", "017 555-7713", "jane.roe(at)host.org",
        "DE89 3704 0044 0532 0130"]


def test_a_long_name_before_a_written_out_at_is_whole(spark):
    text = "x " + "a" * 5000 + " [at] host.org " + "b" * 400 + "(at)other.net"
    assert {text[a:b] for a, b in pii.candidates(text)} >= {"a" * 5000 + " [at] host.org", "b" * 400 + "(at)other.net"}
