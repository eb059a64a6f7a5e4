"""Loading delimited extracts.

A `CsvLoad` says how one extract is written: fixed or inferred types, the text that
means NULL, line breaks inside quotes, rows of uneven length. Empty fields are NULL.
`read_csv` without a schema reads the files twice, once to infer it; `landing.land` reads them
once. Quoted line breaks, which have to be asked for, keep a file from being split over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from areaweave.sources.scratch import shuffles_released

MALFORMED = "_malformed"


@dataclass(frozen=True)
class CsvLoad:
    schema: T.StructType | None = None
    null_marker: str | None = None
    quoted_newlines: bool = False
    ragged: bool = False
    header: bool = True


SURVEY_LOAD = CsvLoad(null_marker="(X)", quoted_newlines=True)
WORK_LOAD = CsvLoad(null_marker="null", quoted_newlines=True)
CROSSWALK_LOAD = CsvLoad(null_marker="No ZCTA", quoted_newlines=True)
RESOURCE_LOAD = CsvLoad(quoted_newlines=True, ragged=True)
PLAIN_LOAD = CsvLoad()


def _reader(spark: SparkSession, load: CsvLoad) -> DataFrameReader:
    reader = (
        spark.read.option("header", load.header)
        .option("multiLine", load.quoted_newlines)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if load.ragged else "FAILFAST")
        # Parse whole rows even when few columns are used, or uneven rows go unnoticed.
        .option("columnPruning", False)
    )
    return reader if load.null_marker is None else reader.option("nullValue", load.null_marker)


def text_rows(spark: SparkSession, path: str, load: CsvLoad) -> DataFrame:
    """One extract with every column as text; only its first line is read for the names."""
    return _reader(spark, load).option("inferSchema", False).csv(path)


def read_csv(spark: SparkSession, path: str, load: CsvLoad, keep_malformed: bool = False) -> DataFrame:
    """Read one extract.

    A row of the wrong length fails the load, unless the load is `ragged`: then missing
    trailing fields are NULL and surplus ones are dropped. `keep_malformed` (ragged loads
    with a schema) adds a column holding the text of each uneven row, NULL for the rest.
    """
    reader = _reader(spark, load)
    if load.schema is None:
        return reader.option("inferSchema", True).csv(path)
    schema = load.schema
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, load: CsvLoad) -> str:
    """Write rows the way `load` reads them back, blanks included; one file per task, compressed."""
    writer = df.write.mode("overwrite").option("header", load.header).option("escape", '"')
    writer = writer.option("compression", "gzip")
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    if load.null_marker is not None:
        writer = writer.option("nullValue", load.null_marker)
    with shuffles_released(df.sparkSession):
        writer.csv(path)
    return path
