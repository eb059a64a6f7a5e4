"""Integrity checks. Each returns violations or one row of counts, never raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.operators.joins import without_parent


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows, non-null keys and distinct keys, and whether the key identifies a row."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(key).alias("key_values"),
        F.count_distinct(key).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("total_rows") == F.col("distinct_keys"))


def name_counts(df: DataFrame, key: str = "NAME") -> DataFrame:
    """Distinct keys next to all entries, as the staging checks report them."""
    return df.agg(
        F.count_distinct(key).alias("Distinct_Name"), F.count("*").alias("Total_Entries")
    )


def null_count(df: DataFrame, column: str) -> DataFrame:
    """How many rows lack the column. Counts rows: counting the column itself gives 0."""
    return df.where(F.col(column).isNull()).agg(F.count("*").alias("null_rows"))


def wrong_length(df: DataFrame, column: str, longer_than: int | None = None,
                 shorter_than: int | None = None) -> DataFrame:
    """Rows whose code is too long or too short."""
    size = F.length(column)
    bad = F.lit(False)
    if longer_than is not None:
        bad = bad | (size > longer_than)
    if shorter_than is not None:
        bad = bad | (size < shorter_than)
    return df.where(bad)


def missing_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key violations: child rows with no parent row."""
    return without_parent(child, parent, key)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, value (as text), rows: how often each value of the columns occurs, NULL included.

    All columns are counted by one shuffle, combined map-side first, so a value that many
    rows share is one row per task. Any number of key checks follow from these counts.
    """
    pairs = ", ".join(f"struct('{c}' AS field, CAST(`{c}` AS STRING) AS value)" for c in columns)
    return df.selectExpr(f"inline(array({pairs}))").groupBy("field", "value").agg(
        F.count(F.lit(1)).alias("rows"))


def rows_where(field: str, condition: str = "true") -> str:
    """Over value counts: rows whose value of `field` meets the condition."""
    return f"coalesce(sum(rows) FILTER (WHERE field = '{field}' AND {condition}), 0)"


def values_where(field: str, condition: str = "value IS NOT NULL") -> str:
    """Over value counts: distinct values of `field` that meet the condition."""
    return f"count_if(field = '{field}' AND {condition})"


def orphan_rows(counts: DataFrame, field: str, parent: DataFrame, key: str) -> DataFrame:
    """The value counts of one field whose value is NULL or not among the parent's keys: the child
    is not read again, and a value that many child rows share meets the parent once."""
    own = counts.where(F.col("field") == field)
    keys = parent.select(F.col(f"`{key}`").cast("string").alias("value"))
    return without_parent(own, keys, "value")


def as_report(df: DataFrame, subject: str, measures: dict[str, str]) -> DataFrame:
    """Evaluate all measures (SQL aggregates) in one pass; one result row per measure."""
    one_row = df.agg(*(F.expr(f"CAST({m} AS BIGINT)").alias(name) for name, m in measures.items()))
    pairs = F.explode(
        F.array(*(F.struct(F.lit(name).alias("check_name"), F.col(name).alias("value"))
                  for name in measures))
    )
    return one_row.select(F.lit(subject).alias("table_name"), pairs.alias("r")).select(
        "table_name", "r.check_name", "r.value"
    )
