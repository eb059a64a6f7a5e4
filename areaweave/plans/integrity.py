"""Integrity reports: every check of a table from one count of its key values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from areaweave.fixed_values import ZIP_LENGTH
from areaweave.operators.checks import (
    as_report, orphan_rows, rows_where, value_counts, values_where,
)


def _key(name: str) -> dict[str, str]:
    return {f"{name}_values": rows_where(name, "value IS NOT NULL"),
            f"{name}_distinct": values_where(name)}


def _too_short(name: str) -> dict[str, str]:
    return {f"{name}_too_short": rows_where(name, f"length(value) < {ZIP_LENGTH}")}


def school_report(table: str, modeled: DataFrame, transformed: DataFrame) -> DataFrame:
    """Key counts before the row job; keys, missing and overlong ZIPs after it."""
    keys = ["SCHOOLID", "ZIPCODE"]
    before = {**_key("SCHOOLID"), **_key("ZIPCODE")}
    after = {
        **_key("SCHOOLID"),
        "ZIPCODE_missing": rows_where("ZIPCODE", "value IS NULL"),
        "ZIPCODE_too_long": rows_where("ZIPCODE", f"length(value) > {ZIP_LENGTH}"),
    }
    return as_report(value_counts(modeled, keys), f"{table} modeled", before).unionByName(
        as_report(value_counts(transformed, keys), f"{table} transformed", after)
    )


def crosswalk_report(modeled: DataFrame, transformed: DataFrame, income: DataFrame) -> DataFrame:
    names = ["ZIPCODE", "ZCTA5"]
    keys = {**_key("ZIPCODE"), **_key("ZCTA5")}
    counts = value_counts(transformed, names)
    orphans = orphan_rows(counts, "ZCTA5", income, "ZCTA5")
    return (
        as_report(value_counts(modeled, names), "zip_to_zcta5 modeled", keys)
        .unionByName(as_report(counts, "zip_to_zcta5 transformed",
                               {**keys, **_too_short("ZIPCODE"), **_too_short("ZCTA5")}))
        .unionByName(as_report(orphans, "zip_to_zcta5 transformed",
                               {"ZCTA5_without_income": rows_where("ZCTA5")}))
    )


def resource_report(modeled: DataFrame, transformed: DataFrame, crosswalk: DataFrame) -> DataFrame:
    keys = {"rows": rows_where("MID"), "MID_distinct": values_where("MID")}
    counts = value_counts(transformed, ["MID", "ZIPCODE"])
    orphans = orphan_rows(counts, "ZIPCODE", crosswalk, "ZIPCODE")
    return (
        as_report(value_counts(modeled, ["MID"]), "public_resources modeled", keys)
        .unionByName(as_report(counts, "public_resources transformed",
                               {**keys, **_too_short("ZIPCODE")}))
        .unionByName(as_report(orphans, "public_resources transformed",
                               {"ZIPCODE_without_area": rows_where("ZIPCODE")}))
    )
