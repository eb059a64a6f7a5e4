"""Landing a delimited extract once: its text is stored column by column and its types are found on
the way, by one scan of the raw files.

Each value has a kind (whole number, number, date, ...), a bit. The bits of a column are combined by OR
while the text is written, an aggregate that can be merged in any order and repeated without harm.
A column's type is the narrowest that holds all kinds seen; mixed kinds are text. The schema found
is kept beside the rows, so later readers neither infer nor read the extract again, and what
changed between two landings can be told from the two schemas.

NULLs (empty fields, the load's null marker) say nothing about the type; a column of nothing
else is text. Numbers are plain digits with an optional sign, point and exponent; numbers beyond
64 bits become doubles.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaweave.sources.csv_files import CsvLoad, text_rows

INT, LONG, NUMBER, TRUTH, DAY, TIME, TEXT = (1 << i for i in range(7))

# Types from the narrowest on, with the kinds each can hold.
_HOLDS = [
    (T.IntegerType(), INT),
    (T.LongType(), INT | LONG),
    (T.DoubleType(), INT | LONG | NUMBER),
    (T.BooleanType(), TRUTH),
    (T.DateType(), DAY),
    (T.TimestampType(), DAY | TIME),
]
_ROWS = "rows"


def kind_of(c: str) -> str:
    """The bit of one text value; 0 for NULL."""
    day, clock = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
    return (
        f"CASE WHEN `{c}` IS NULL THEN 0 "
        f"WHEN `{c}` RLIKE '^[+-]?[0-9]+$' THEN CASE "
        f"WHEN try_cast(`{c}` AS INT) IS NOT NULL THEN {INT} "
        f"WHEN try_cast(`{c}` AS BIGINT) IS NOT NULL THEN {LONG} ELSE {NUMBER} END "
        f"WHEN `{c}` RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' THEN {NUMBER} "
        f"WHEN lower(`{c}`) IN ('true', 'false') THEN {TRUTH} "
        f"WHEN `{c}` RLIKE '^{day}$' AND try_cast(`{c}` AS DATE) IS NOT NULL THEN {DAY} "
        f"WHEN `{c}` RLIKE '^{day}[ T]{clock}$' AND try_cast(`{c}` AS TIMESTAMP) IS NOT NULL "
        f"THEN {TIME} ELSE {TEXT} END"
    )


def type_of(kinds: int) -> T.DataType:
    """The narrowest type that holds all kinds of a column."""
    fits = (kind for kind, holds in _HOLDS if kinds and kinds & ~holds == 0)
    return next(fits, T.StringType())


def land(spark: SparkSession, path: str, load: CsvLoad, folder: str) -> T.StructType:
    """Store the extract's text under `folder` and return, and keep there, the schema found."""
    rows = text_rows(spark, path, load)
    seen = Observation()
    kinds = [F.expr(f"bit_or({kind_of(c)})").alias(f"k{i}") for i, c in enumerate(rows.columns)]
    rows.observe(seen, F.count(F.lit(1)).alias(_ROWS), *kinds).write.parquet(
        f"{folder}/rows", compression="zstd")
    found = seen.get
    schema = T.StructType([
        T.StructField(c, type_of(found[f"k{i}"] or 0)) for i, c in enumerate(rows.columns)])
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.text(
        f"{folder}/schema")
    return schema


def landed_schema(spark: SparkSession, folder: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(f"{folder}/schema").first().value))


def landed(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a landing in their found types, or in those of a `schema` of the same columns."""
    wanted = schema or landed_schema(spark, folder)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    return spark.read.schema(text).parquet(f"{folder}/rows").selectExpr(*(
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wanted))
