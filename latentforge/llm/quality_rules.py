"""Quality rules: a threshold table compiled into one projection (native).

``RULES`` names a metric and the range in which it is accepted.
:func:`compile_rules` turns the table into column expressions, so a corpus is
judged in one scan without shuffle or user function.  Metrics are lengths and
ratios: characters per word, symbols per word, exclamation marks per word,
stop words per word, words with a letter, repeated lines and words in
repeated three-word windows.

Defined results: null and empty texts have no words; every count is 0, all
ratios are null, ``base_failed`` is true and ``kept`` false.  A null ratio
never fails a rule by itself.  Repeated rows are judged alike and all stay in
the output.  Extra columns are carried along by :func:`judge` unless they
have the name of an output column; those are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, positions, unused, words

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "be",
    # German
    "der", "die", "das", "und", "ist", "nicht", "mit", "von", "den", "ein", "auf", "zu",
    # French
    "le", "la", "les", "des", "est", "et", "que", "une", "un", "dans", "pour", "de", "du",
    # Spanish
    "el", "los", "las", "que", "en", "y", "por", "con", "una", "del", "se",
)


@dataclass(frozen=True)
class Rule:
    """A document fails if ``metric`` is below ``least`` or above ``most``."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "mean_word_chars", least=2.0, most=20.0),
    Rule("symbols", "symbol_ratio", most=0.25),
    Rule("exclamations", "exclamation_ratio", most=0.5),
    Rule("letters", "letter_word_ratio", least=0.6),
    Rule("stop_words", "stop_word_ratio", least=0.005),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def repeat_words(ws: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more.

    Windows are compared by a 64-bit hash inside one document.  Only texts
    whose hashes aren't all distinct go on; there the hashes are sorted with
    their positions, so equal ones are neighbours.  No step is quadratic in
    the length of the text.
    """
    mask = (1 << 20) - 1

    def repeated(hs: Column) -> Column:
        # The high bits of a hash and its position share one long, so that
        # equal windows are neighbours after a sort of longs; neighbours with
        # equal high bits are then compared in full.
        keys = F.sort_array(F.transform(hs, lambda h, i: F.shiftleft(F.shiftright(h, 20), 20).bitwiseOR(i.cast("long"))))

        def neighbours(s: Column) -> Column:
            near = F.array_compact(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(
                a.bitwiseXOR(b).between(0, mask), F.array(a.bitwiseAND(F.lit(mask)).cast("int"),
                                                          b.bitwiseAND(F.lit(mask)).cast("int")))))
            return F.flatten(F.filter(near, lambda p: F.get(hs, F.get(p, F.lit(0))) == F.get(hs, F.get(p, F.lit(1)))))
        return F.when(F.size(hs) > 1, let(keys, neighbours)).otherwise(F.array().cast("array<int>"))

    def repeated_long(hs: Column) -> Column:
        # texts with 2^20 windows or more: hash and position side by side
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return let(pairs, lambda s: F.array_compact(F.transform(s, lambda x, i: F.when(
            (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["p"]))))

    def covered(p: Column) -> Column:
        return F.size(F.array_distinct(F.concat(
            p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2))))

    hashes = F.transform(positions(F.size(ws) - 2),
                         lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(let(
        F.when(F.size(hs) < 1 << 20, repeated(hs)).otherwise(repeated_long(hs)), covered)))


def _measures(text: Column) -> Column:
    """One struct with all counts of a text."""
    with_word = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))

    def of_words(ws: Column) -> Column:
        return let(with_word, lambda lines: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.concat_ws("", ws)).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(ws).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
            (F.size(ws) - F.regexp_count(
                F.concat(F.lit(" "), text), F.lit(rf"{SPACE}[^\x20\x09-\x0D\p{{L}}]+(?![^\x20\x09-\x0D])")))
            .cast("long").alias("n_letter_words"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
        ))

    return let(words(text), of_words)


# Ratios as (numerator, denominator) of the counts.
METRICS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "exclamation_ratio": ("n_exclamations", "n_words"),
    "letter_word_ratio": ("n_letter_words", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def _failed(rule: Rule, metric: Column) -> Column:
    tests = [t for t in (metric < rule.least if rule.least is not None else None,
                         metric > rule.most if rule.most is not None else None) if t is not None]
    bad = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return F.coalesce(bad, F.lit(False))


def compile_rules(m: Column, rules=RULES) -> tuple[Column, Column]:
    """(base_failed, names of the failed rules) over a struct of counts."""
    base = (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)
    failed = F.array_compact(F.array(*[
        F.when(_failed(r, F.try_divide(m[METRICS[r.metric][0]], m[METRICS[r.metric][1]])), F.lit(r.name))
        for r in rules]))
    return base, failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed_rules``, ``kept``."""
    out = (*COUNTS, "base_failed", "failed_rules", "kept")
    own = unused(docs, "_measures")
    m = F.col(own)
    base, failed = compile_rules(m, rules)
    rest = [c for c in docs.columns if c not in out]
    return (docs.select(*rest, _measures(F.coalesce(F.col(text), F.lit(""))).alias(own))
            .select(*rest, *[m[c].alias(c) for c in COUNTS],
                    base.alias("base_failed"), failed.alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass, with the columns of ``docs`` only.

    The verdict is one expression in which the counts are bound once; a filter
    on the columns of :func:`judge` would be pushed below them and compute the
    counts again for every use.
    """
    def verdict(m: Column) -> Column:
        base, failed = compile_rules(m, rules)
        return ~base & (F.size(failed) == 0)
    return docs.where(let(_measures(F.coalesce(F.col(text), F.lit(""))), verdict))
