"""Caption column expressions.

All functions build JVM-side Column expressions: they stay inside
whole-stage codegen (``contains``, ``CASE``) or run as a single compiled
Java regex per row (``rlike``, ``regexp_extract_all``).  Regular expressions
use the ``(?U)`` flag so that ``\\b`` and ``\\w`` follow Unicode word rules.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx

# Word characters for tokenising: letters, digits, underscore.
NON_WORD = r"[^\p{L}\p{N}_]+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c) -> Column:
    return F.lower(col_(c))


def default_text(c, default: str = "") -> Column:
    """A missing caption becomes ``default``."""
    return F.coalesce(col_(c), F.lit(default))


def image_path(root: str, split: str, file_name) -> Column:
    """``root/split/split/file_name``."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit(split), F.lit(split), col_(file_name))


def any_substring(text_lower: Column, terms) -> Column:
    """True if any term occurs anywhere in the (already lower-cased) text."""
    terms = list(terms)
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [text_lower.contains(t) for t in terms])


def space_term_match(text_lower: Column, terms) -> Column:
    """``' term ' in ' text '`` for any term — only space-delimited hits."""
    padded = F.concat(F.lit(" "), text_lower, F.lit(" "))
    return any_substring(padded, [f" {t} " for t in terms])


def age_pattern(spec: dict, elderly_suffixes=lx.ELDERLY_SUFFIXES) -> str:
    """Java regex of one age group (prefix words, or whole words with suffix)."""
    if "prefixes" in spec:
        return r"(?U)\b(" + "|".join(spec["prefixes"]) + r")\w*\b"
    words = "|".join(spec["words"])
    suffixes = "|".join(elderly_suffixes)
    return r"(?U)\b(" + words + r")\s*(" + suffixes + r")?\b"


def _literal(alternative: str) -> str:
    """The leading literal of a regex alternative (``grown[-\\s]?up`` → ``grown``)."""
    m = re.match(r"[^\\\[\](){}?*+|^$.]*", alternative)
    return m.group(0) if m else ""


def _guard(text_lower: Column, alternatives) -> Column | None:
    """A substring test that must hold for any alternative to match, or None."""
    lits = [_literal(a) for a in alternatives]
    if not lits or any(not x for x in lits):
        return None
    return any_substring(text_lower, lits)


def age_flags(text_lower: Column, lexicon: lx.Lexicon = lx.DEFAULT) -> dict[str, Column]:
    """One boolean column per age group.

    Each Unicode regex is guarded by a plain substring test of its literal
    words (byte search inside codegen), so the regex only runs on texts that
    can match; the result is the same.
    """
    out = {}
    for g, spec in lexicon.age.items():
        rx = text_lower.rlike(age_pattern(spec, lexicon.elderly_suffixes))
        guard = _guard(text_lower, spec.get("prefixes") or spec.get("words"))
        out[g] = rx if guard is None else (guard & rx)
    return out


def group_size_class(text_lower: Column, lexicon: lx.Lexicon = lx.DEFAULT) -> Column:
    """First matching class by substring, else the default class."""
    expr = None
    for name, terms in lexicon.group_sizes:
        cond = any_substring(text_lower, terms)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(lexicon.group_default) if expr is None else expr.otherwise(F.lit(lexicon.group_default))


def terms_pattern(terms) -> str:
    return r"(?U)\b(" + "|".join(re.escape(t) for t in terms) + r")\b"


def find_terms(text_lower: Column, terms) -> Column:
    """Every non-overlapping whole-word hit, in text order, with repeats
    (the regex runs only when some term occurs as a substring)."""
    hits = F.regexp_extract_all(text_lower, F.lit(terms_pattern(terms)), F.lit(1))
    guard = _guard(text_lower, [re.escape(t) for t in terms])
    if guard is None:
        return hits
    return F.when(guard, hits).when(text_lower.isNotNull(), F.array().cast("array<string>"))


def count_term(hits: Column, term: str) -> Column:
    """Occurrences of one term in an array of hits."""
    return F.size(F.filter(hits, lambda x: x == F.lit(term)))


def tokens(text_lower: Column) -> Column:
    """Words of a text: split on non-word characters, empty pieces dropped."""
    return F.filter(F.split(text_lower, NON_WORD), lambda t: F.length(t) > 0)


def percent(n, total, digits: int = 2) -> Column:
    """``n/total*100`` rounded; NULL when the total is 0."""
    n, total = col_(n), col_(total)
    return F.when(total != 0, F.round(F.lit(100.0) * n / total, digits))
