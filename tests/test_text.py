"""Caption functions and demographics (F1, X1–X10, A2–A7) on hand rows."""

from pyspark.sql import functions as F

from latentforge.functions import durations as du
from latentforge.functions import lexicon as lx
from latentforge.functions import text as tx
from latentforge.operators import aggregates as agg
from latentforge.operators import filters as flt


def one_col(spark, values, name="caption"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, {name} string")


def flags(spark, values, expr_fn):
    df = one_col(spark, values)
    return [r[0] for r in df.orderBy("id").select(expr_fn(tx.lower_text("caption"))).collect()]


def test_people_filter_is_substring(spark):
    df = one_col(spark, ["Many cars", "A SKIDding car", "a red car", None])
    kept = [r.caption for r in flt.keyword_filter(df, "caption").collect()]
    assert sorted(kept) == ["A SKIDding car", "Many cars"]


def test_people_filter_token_mode(spark):
    df = one_col(spark, ["Many cars", "a man walks"])
    kept = [r.caption for r in flt.keyword_filter(df, "caption", match="token").collect()]
    assert kept == ["a man walks"]


def test_space_delimited_terms(spark):
    got = flags(spark, ["a man walks", "a man.", "man", "a man\nwalks"],
                lambda c: tx.space_term_match(c, ["man"]))
    assert got == [True, False, True, False]


def test_age_flags(spark):
    def age(values, group):
        return flags(spark, values, lambda c: tx.age_flags(c)[group])

    assert age(["kids play", "skid"], "child") == [True, False]
    assert age(["ñteen", "a teenager"], "teen") == [False, True]
    assert age(["grown-up", "grown up", "grownups", "adults", "grown  up"], "adult") == [True] * 4 + [False]
    assert age(["an old cat", "oldman", "old.", "older", "cold", "seniors", "oldmanly"], "elderly") == \
        [True, True, True, False, False, False, False]


def test_group_size_class(spark):
    got = flags(spark, ["a couple in a crowd", "repair shop", "a dog"], lambda c: tx.group_size_class(c))
    assert got == ["group/crowd", "pair", "single"]


def test_find_terms_repeats(spark):
    got = flags(spark, ["walking walking man."], lambda c: tx.find_terms(c, lx.ACTIVITY_TERMS))
    assert got == [["walking", "walking"]]


def test_parse_duration(spark):
    df = one_col(spark, ["0:04:59", "05:23", "99:99", "24:00:00", "0:4:61", ""], "t")
    assert [r[0] for r in df.orderBy("id").select(du.parse_duration("t")).collect()] == [299, 323, 0, 0, 0, 0]


def test_format_duration(spark):
    df = spark.createDataFrame([(0, 299.9), (1, 90061.0), (2, 200000.0), (3, 0.0)], "id long, s double")
    got = [r[0] for r in df.orderBy("id").select(du.format_duration("s")).collect()]
    assert got == ["0:04:59", "1 day, 1:01:01", "2 days, 7:33:20", "0:00:00"]


def test_percent_null_at_zero_total(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "n long, t long")
    assert [r[0] for r in df.orderBy(F.desc("n")).select(tx.percent("n", "t")).collect()] == [33.33, None]


def test_demographics_shapes(spark):
    df = one_col(spark, ["a man and a woman walking", "kids playing in a group", "a red car", None])
    d = {(r.dimension, r.category): r.n for r in agg.demographics(df).collect()}
    assert d[("gender_distribution", "male")] == 1
    assert d[("gender_distribution", "female")] == 1
    assert d[("gender_distribution", "neutral")] == 0          # genders always present
    assert d[("age_groups", "child")] == 1
    assert ("age_groups", "teen") not in d                      # zero groups absent
    assert d[("group_sizes", "group/crowd")] == 1
    assert d[("group_sizes", "single")] == 3                    # NULL caption counts as single
    assert d[("activities", "walking")] == 1 and d[("activities", "playing")] == 1


def test_demographics_no_hits(spark):
    df = one_col(spark, ["zzz", "yyy"])
    g = {r.category: r.n for r in agg.gender_counts(df).collect()}
    assert g == {"male": 0, "female": 0, "neutral": 0}
    assert agg.age_counts(df).count() == 0


def test_empty_input(spark):
    df = one_col(spark, [])
    g = {r.category: r.n for r in agg.gender_counts(df).collect()}
    assert g == {"male": 0, "female": 0, "neutral": 0}
    assert agg.activity_counts(df).count() == 0
    s = agg.distribution_summary(df).collect()
    assert all(r.pct is None for r in s)


def test_split_predicate_runs_costly_only_on_rest(spark):
    df = one_col(spark, ["Is it", "a man", "nothing", None])
    cheap = tx.any_substring(tx.lower_text("caption"), ["man"])
    out = flt.fallback_predicate(df, cheap, flt.gazetteer_person(["Is"]), "caption")
    assert sorted(r.caption for r in out.collect()) == ["Is it", "a man"]


def test_patterns_equal_fixed_values():
    for g, spec in lx.AGE_GROUPS.items():
        assert tx.age_pattern(spec) == "(?U)" + lx.AGE_PATTERNS[g]
    assert tx.terms_pattern(lx.ACTIVITY_TERMS) == "(?U)" + lx.ACTIVITY_PATTERN
