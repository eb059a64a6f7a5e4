"""Ordered results that come out the same on every run and every cluster.

Sort keys are column names: "Rich" ascending with NULL first, "-Rich" descending with NULL
last, as Spark orders by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The requested keys, then every other column, so that only equal rows tie."""
    named = {key.removeprefix("-") for key in keys}
    requested = [F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in keys]
    return [*requested, *(F.asc(c) for c in df.columns if c not in named)]


def top_k(df: DataFrame, n: int, *keys: str, keep: Sequence[str] | None = None) -> DataFrame:
    """First `n` rows by `keys`, returning only the columns in `keep` if given.

    Plans as TakeOrderedAndProject: each task keeps n rows, only those reach the last
    one. Ties are broken by the remaining columns.
    """
    best = df.orderBy(*total_order(df, keys)).limit(n)
    return best.select(*keep) if keep else best


def sorted_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Whole result in order. The tie columns also let the range exchange split a key
    that many rows share (a third of all schools in one state, say) over many tasks."""
    return df.orderBy(*total_order(df, keys))
