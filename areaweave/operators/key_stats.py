"""Key statistics: which keys of a stored table are frequent, and how many rows they have.

They are counted once, when a job has stored the table, and kept beside that very version of it, so a
join can deal out the rows of frequent keys without counting anything. A key is listed from
`SLOT_ROWS` rows on, so there are at most (rows of the table) / `SLOT_ROWS` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.sources import published

SLOT_ROWS = 100_000
"""Rows of one key that a single task may get."""


def frequent_keys(df: DataFrame, key: str, more_than: int = SLOT_ROWS) -> DataFrame:
    """key, rows: the keys with more rows than that, counted exactly, combined map-side."""
    counts = df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(
        F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > more_than)


def _name(version: str, key: str) -> str:
    return f"{version}__keys_{key.lower()}"


def store_key_statistics(spark: SparkSession, table: str, key: str,
                         more_than: int = SLOT_ROWS) -> DataFrame:
    """Count the keys of a published table's current version and keep the frequent ones with it.
    Only the key column is read. Safe to repeat."""
    version = published.current(spark, table)
    if version is None:
        raise ValueError(f"{table} is no published table")
    rows = frequent_keys(spark.table(published.quoted(spark, version)), key, more_than)
    rows.write.mode("overwrite").saveAsTable(_name(version, key))
    return spark.table(_name(version, key))


def key_statistics(spark: SparkSession, table: str, key: str) -> DataFrame | None:
    """What was kept with the version the name stands for now; None if nothing was."""
    version = published.current(spark, table)
    name = version and _name(version, key)
    return spark.table(name) if name and spark.catalog.tableExists(name) else None
