"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def concat_results(dfs) -> DataFrame:
    """Bag union of chunk results (duplicates kept), matched by name."""
    return reduce(lambda a, b: a.unionByName(b), list(dfs))


def union_records(ok: DataFrame, err: DataFrame) -> DataFrame:
    """Success and error records with different fields in one table;
    missing fields are NULL."""
    return ok.unionByName(err, allowMissingColumns=True)
