"""Schemas from files: JSON field lists, sink type strings, and what drifted from them. Driver-side
metadata only.

The package declares every extract and every job's result in `areaweave/schemas`; a field list of
anyone's own is read from any path Spark can read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cache
from importlib import resources

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SPARK_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}
WIDER = {"int": ("bigint", "double"), "bigint": ("double",), "date": ("timestamp",)}
"""Types a value can be stored in besides its own and text, and be told again."""


def schema_from_json(text: str) -> T.StructType:
    """[{"name", "type", "mode", "description"}, ...] -> schema, in list order."""
    fields = []
    for entry in json.loads(text):
        field_type = SPARK_TYPES.get(entry["type"].upper())
        if field_type is None:
            raise ValueError(f"unsupported type {entry['type']!r} of field {entry['name']!r}")
        nullable = entry.get("mode", "NULLABLE").upper() != "REQUIRED"
        notes = {"comment": entry["description"]} if entry.get("description") else {}
        fields.append(T.StructField(entry["name"], field_type, nullable, notes))
    return T.StructType(fields)


def schema_from_sink(text: str) -> T.StructType:
    """'NAME:STRING,Rich:FLOAT' -> schema; blanks around entries are ignored."""
    pairs = (entry.split(":") for entry in text.replace("\n", "").split(","))
    return T.StructType(
        [T.StructField(name.strip(), SPARK_TYPES[kind.strip().upper()]) for name, kind in pairs]
    )


def _declared(name: str) -> str:
    return resources.files("areaweave.schemas").joinpath(name).read_text(encoding="utf-8")


@cache
def sink_schemas() -> dict[str, T.StructType]:
    """The declared result of every row job, by its name."""
    lines = (line.split(":", 1) for line in _declared("sinks.txt").splitlines()
             if line.strip() and not line.startswith("#"))
    return {name: schema_from_sink(columns) for name, columns in lines}


@cache
def school_field_list(table: str) -> str:
    """The declared JSON field list of a school location file."""
    return _declared(f"{table}.json")


def school_fields(table: str) -> list[str]:
    return schema_from_json(school_field_list(table)).names


def read_field_list(spark: SparkSession, path: str) -> T.StructType:
    """The schema of a field list kept anywhere Spark can read."""
    rows = spark.read.text(path, wholetext=True).take(2)
    if len(rows) != 1:
        raise ValueError(f"{path} is not one field list")
    return schema_from_json(rows[0].value)


@dataclass(frozen=True)
class Drift:
    """How a column found differs from what was declared: missing, extra, type or order."""

    column: str
    problem: str
    declared: str | None = None
    found: str | None = None

    def __str__(self) -> str:
        return f"{self.column}: {self.problem} (declared {self.declared}, found {self.found})"


def drift(declared: T.StructType, found: T.StructType) -> list[Drift]:
    """Column names are compared as Spark does, without regard to case."""
    ours = {f.name.lower(): f for f in declared}
    theirs = {f.name.lower(): f for f in found}
    problems = [Drift(f.name, "missing", f.dataType.simpleString())
                for key, f in ours.items() if key not in theirs]
    problems += [Drift(f.name, "extra", None, f.dataType.simpleString())
                 for key, f in theirs.items() if key not in ours]
    for key, field in ours.items():
        if key in theirs and field.dataType != theirs[key].dataType:
            problems.append(Drift(field.name, "type", field.dataType.simpleString(),
                                  theirs[key].dataType.simpleString()))
    both = [key for key in theirs if key in ours]
    wanted = [key for key in ours if key in theirs]
    if both != wanted:
        first = next(i for i, (a, b) in enumerate(zip(wanted, both, strict=True)) if a != b)
        problems.append(Drift(ours[wanted[first]].name, "order", wanted[first], both[first]))
    return problems


def losses(declared: T.StructType, found: T.StructType) -> list[Drift]:
    """The drift that storing `found` as declared would not survive: columns that are missing or
    would be left out, and types that do not fit. Other order and wider types do."""
    return [d for d in drift(declared, found)
            if d.problem in ("missing", "extra")
            or d.problem == "type" and d.declared not in ("string", *WIDER.get(d.found, ()))]
