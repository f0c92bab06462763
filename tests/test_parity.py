"""Parity with the original Python semantics on random inputs.

The original ran Python ``re`` (Unicode word rules), ``datetime.strptime``
and ``str(timedelta)``; these tests implement those behaviours directly in
Python and compare them with the Spark expressions on seeded random strings.
"""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from latentforge.functions import durations as du
from latentforge.functions import lexicon as lx
from latentforge.functions import text as tx

WORDS = ["child", "kid", "kids", "baby", "toddler", "teen", "teenager", "adolescent", "adult", "grown",
         "up", "grownup", "old", "older", "elderly", "senior", "man", "woman", "person", "people",
         "walking", "playing", "skiing", "surfing", "riding", "ñ", "é", "cold", "bold", "the"]
SEPS = [" ", "  ", "-", ".", ",", "\n", "\t", "_", "'", "é", "ñ", "1", ""]


def random_caption(rng: random.Random) -> str:
    return "".join(rng.choice(WORDS) + rng.choice(SEPS) for _ in range(rng.randint(0, 6))).lower()


def spark_values(spark, values, expr_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s string")
    return [r[0] for r in df.orderBy("id").select(expr_fn(F.col("s"))).collect()]


def test_age_regexes_match_python_re(spark):
    rng = random.Random(7)
    caps = [random_caption(rng) for _ in range(3000)]
    for group, pattern in lx.AGE_PATTERNS.items():
        want = [re.search(pattern, c) is not None for c in caps]
        got = spark_values(spark, caps, lambda c, g=group: tx.age_flags(c)[g])
        assert got == want, group


def test_activity_findall_matches_python_re(spark):
    rng = random.Random(11)
    caps = [random_caption(rng) for _ in range(3000)]
    want = [re.findall(lx.ACTIVITY_PATTERN, c) for c in caps]
    got = spark_values(spark, caps, lambda c: tx.find_terms(c, lx.ACTIVITY_TERMS))
    assert got == want


def test_space_terms_and_group_class_match_python(spark):
    rng = random.Random(5)
    caps = [random_caption(rng) + rng.choice(["group", "crowd", "pair", "couple", "repair", ""]) for _ in range(2000)]
    for g, terms in lx.GENDER_TERMS.items():
        want = [any(f" {t} " in f" {c} " for t in terms) for c in caps]
        assert spark_values(spark, caps, lambda c, t=terms: tx.space_term_match(c, t)) == want

    def cls(c):
        if "group" in c or "crowd" in c:
            return "group/crowd"
        if any(w in c for w in ["couple", "pair"]):
            return "pair"
        return "single"
    assert spark_values(spark, caps, tx.group_size_class) == [cls(c) for c in caps]


def python_seconds(s: str) -> int:
    for fmt, f in (("%H:%M:%S", lambda t: t.hour * 3600 + t.minute * 60 + t.second),
                   ("%M:%S", lambda t: t.minute * 60 + t.second)):
        try:
            return f(datetime.strptime(s, fmt))
        except ValueError:
            continue
    return 0


def test_parse_duration_matches_strptime(spark):
    rng = random.Random(3)
    alphabet = "0123456789:::x "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(5000)]
    texts += [f"{rng.randint(0, 30)}:{rng.randint(0, 70):02d}:{rng.randint(0, 70):02d}" for _ in range(2000)]
    texts += [f"{rng.randint(0, 70)}:{rng.randint(0, 70)}" for _ in range(2000)]
    want = [python_seconds(t) for t in texts]
    assert spark_values(spark, texts, du.parse_duration) == want


def test_format_duration_matches_timedelta(spark):
    rng = random.Random(9)
    vals = [rng.uniform(-200000, 500000) for _ in range(3000)] + [0.0, 59.99, 86399.9, 86400.0, 172800.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = [r[0] for r in df.orderBy("id").select(du.format_duration("v")).collect()]
    assert got == [str(timedelta(seconds=int(v))) for v in vals]


def test_results_do_not_depend_on_partitioning(spark, sf):
    from latentforge.operators import aggregates as agg
    from latentforge.operators import inference as inf
    from latentforge.operators import sampling as smp
    from latentforge.sources import views as vw

    base = vw.dataset(spark, sf).cache()
    outs = []
    for parts in (1, 7, 32):
        d = base.repartition(parts)
        demo = sorted(map(tuple, agg.demographics(d, lexicon=lx.TEST).collect()))
        emb = sorted((r.id, r.bucket, round(r.value, 12)) for r in inf.hash_embed(d, "id", "caption", 16).collect())
        pick = sorted(map(tuple, smp.epoch_shuffle(d.select("id"), "id", 3).collect()))
        outs.append((demo, emb, pick))
    assert outs[0] == outs[1] == outs[2]
    base.unpersist()
