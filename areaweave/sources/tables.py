"""Namespaces, stored tables and views, and the reads that feed the row jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaweave.fixed_values import SAMPLE_ROWS
from areaweave.operators.ranking import top_k
from areaweave.sources.field_lists import losses
from areaweave.sources.published import Approval, publish


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists; safe to repeat."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def read_query(
    source: DataFrame, columns: Sequence[str] | None = None, where: str | None = None
) -> DataFrame:
    """Filter (a SQL condition) and prune a source; both reach a Parquet scan."""
    kept = source.where(where) if where else source
    return kept.select(*columns) if columns else kept


def read_sample(source: DataFrame, key: str, n: int = SAMPLE_ROWS,
                ordered: bool = True, keyless: bool = False) -> DataFrame:
    """`n` rows that have a key, for the dry run before a full one: the first by key, whatever the
    layout, or any, for which every task stops reading after `n`. With `keyless` rows without a
    key are read as well, and are the first."""
    named = source if keyless else source.where(F.col(f"`{key}`").isNotNull())
    return top_k(named, n, key) if ordered else named.limit(n)


def create_table(df: DataFrame, name: str) -> DataFrame:
    """Store a new table; fails if it exists."""
    df.write.mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, layout: Sequence[str] = (),
                  approve: Approval | None = None) -> DataFrame:
    """Store the next version of a table, optionally laid out in key order, and let its name
    stand for it; see `published.publish`."""
    return publish(df, name, layout, approve=approve)


def truncate_table(df: DataFrame, name: str, schema: T.StructType | str,
                   key: str | None = None, buckets: int | None = None,
                   approve: Approval | None = None) -> DataFrame:
    """Replace a table's rows, writing the declared columns, by name, in declared types;
    bucketed by `key` if a number of buckets is given (for tables whose key identifies a row).
    Fails if a column is missing or left over, or if its values might not fit."""
    return publish(to_declared(df, schema), name, key=key, buckets=buckets, approve=approve)


def to_declared(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if problems := losses(declared, df.schema):
        raise ValueError("not as declared: " + "; ".join(map(str, problems)))
    return df.selectExpr(*(
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in declared.fields))


def dump_rows(df: DataFrame, folder: str) -> str:
    """Write rows as sharded text, one JSON object per line, for inspection. Every row names all its
    fields, so the text is compressed."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(folder, compression="gzip")
    return folder


def store_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view kept in the catalog, planned anew at each read; `query` reads stored tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)
