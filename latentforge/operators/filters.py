"""Filters, predicates and limits."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from .positions import with_position

# Above this many rows a prefix is taken by position, not by a top-k merge in
# one task.
TOPK_ROWS = 10_000


def keyword_filter(df: DataFrame, col: str, terms=lx.PEOPLE_KEYWORDS, match: str = "substring") -> DataFrame:
    """keep rows whose lower-cased text contains any term.

    ``match='substring'`` is the original behaviour (``man`` hits ``many``);
    ``match='token'`` requires whole words.  The predicate is a JVM
    expression, so Catalyst keeps it in whole-stage codegen.
    """
    lc = tx.lower_text(col)
    if match == "token":
        return df.where(F.lower(F.col(col)).rlike(tx.terms_pattern(terms)))
    return df.where(tx.any_substring(lc, terms))


def fallback_predicate(df: DataFrame, cheap: Column, costly, text: str | Column) -> DataFrame:
    """``cheap OR costly(text)`` in one pass, where ``costly`` (a Python
    UDF that maps NULL to NULL without work) decides only the rows that the
    cheap test doesn't accept.

    Spark evaluates Python UDFs for every input row of their operator, even
    inside ``OR``/``CASE``; so the UDF gets NULL instead of the text of the
    rows that the cheap test accepts.
    """
    text = F.col(text) if isinstance(text, str) else text
    hit = F.coalesce(cheap, F.lit(False))
    verdict = costly(F.when(~hit, text))
    return df.where(hit | F.coalesce(verdict, F.lit(False)))


def gazetteer_person(names) -> "callable":
    """Stand-in for the NER test of F2: true when any word of the text is in
    ``names`` (case-sensitive).  Arrow-batched pandas UDF."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    names = frozenset(names)

    @pandas_udf("boolean")
    def has_person(texts: pd.Series) -> pd.Series:
        import regex

        split = regex.compile(r"[^\p{L}\p{N}_]+")
        return texts.map(lambda t: None if t is None else
                         any(w in names for w in split.split(t) if w))

    return has_person


def drop_failed(df: DataFrame, content_col: str = "content") -> DataFrame:
    """drop images that did not load."""
    return df.where(F.col(content_col).isNotNull())


def take_prefix(df: DataFrame, n: int | None, order) -> DataFrame:
    """the first ``n`` rows in ``order``; ``n`` of 0/None means all rows.

    ``order`` takes column names and ascending or descending columns of any
    orderable type; the rows come in no particular order.  Small ``n`` uses
    ``orderBy().limit()`` (a per-task top-k, then a merge of at most n rows
    per task).  Large ``n`` filters on a distributed position so that no
    single task receives n rows.  The result is the same.
    """
    if not n:
        return df
    if n <= TOPK_ROWS:
        return df.orderBy(*order).limit(n)
    return with_position(df, order, pos_col="_lf_pos").where(F.col("_lf_pos") < n).drop("_lf_pos")


def status_filter(df: DataFrame, status: str, col: str = "status") -> DataFrame:
    """F5."""
    return df.where(F.col(col) == status)


def every_n(df: DataFrame, col: str, n: int, offset: int = 0) -> DataFrame:
    """rows where ``(col + offset) % n == 0``."""
    return df.where((F.col(col) + offset) % n == 0)


def eval_cap(df: DataFrame, batch_col: str, batch_size: int, num_samples: int) -> DataFrame:
    """batches started before ``num_samples`` rows (the last may overshoot)."""
    return df.where(F.col(batch_col) * batch_size < num_samples)
