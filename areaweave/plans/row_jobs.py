"""The row jobs: one modelled table in, one transformed table out, no shuffle.

A `RowJob` is data (source table, key rule, columns, classifier, filters); `transform`
turns it into one projection. In full form areas are keyed by ZCTA5; the sample form
works on the first 50 rows and keeps the source key, as a dry run.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaweave import fixed_values as fv
from areaweave.functions.classes import (
    class_sums,
    largest_label,
    nth_label,
    ranked_labels,
    weighted_index,
)
from areaweave.functions.cleaning import area_code, five_digit_zip, or_zero, pad_code
from areaweave.plans.modeled import AREA_TABLES
from areaweave.sources.field_lists import sink_schemas
from areaweave.sources.tables import dump_rows, read_query, read_sample, truncate_table


def _with(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr("*", *(f"{text} AS {name}" for name, text in columns.items()))


def _with_once(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds columns as generated ones. A later filter on a plain expression makes the
    optimizer copy it, with all it is made of, into that filter; a generated column is
    worked out once per row."""
    fields = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return df.selectExpr("*", f"inline(array(struct({fields})))")


def income_classes(df: DataFrame) -> DataFrame:
    """Class percentages, the predominant class and the 0-100 income index."""
    brackets = list(fv.INCOME.values())
    return _with(
        _with_once(df, class_sums(brackets, fv.INCOME_CLASSES)),
        {
            "Predominant_Class": largest_label(list(fv.INCOME_CLASSES)),
            "Average": weighted_index(brackets, fv.INCOME_MIDPOINTS, fv.INCOME_SCALE),
        },
    )


def value_classes(df: DataFrame) -> DataFrame:
    """Low, middle and high house value percentages."""
    return _with_once(df, class_sums(list(fv.HOUSING_VALUE.values()), fv.VALUE_CLASSES))


def top_industries(df: DataFrame) -> DataFrame:
    """The three industries with most people; their ranking is sorted once per row."""
    labels = list(fv.INDUSTRY.values())
    ranked = _with_once(df, {"ranked": ranked_labels(labels)})
    names = {out: nth_label("ranked", rank) for rank, out in enumerate(fv.TOP_INDUSTRIES)}
    return _with(ranked, names).drop("ranked")


@dataclass(frozen=True)
class RowJob:
    """`columns` are renamed and null-filled; without them, `recode` changes fields in place."""

    source: str
    key: str
    columns: Mapping[str, str] | None = None
    classify: Callable[[DataFrame], DataFrame] | None = None
    recode: Mapping[str, Callable[[str], str]] | None = None
    full_filter: str | None = None
    sample_filter: str | None = None
    counts_as_double: bool = False

    def sink_type(self, code: str) -> str:
        text = code.endswith("PE") or code in fv.TEXT_MEASURES or self.counts_as_double
        return "double" if text else "bigint"


def _survey(source: str, **options) -> RowJob:
    return RowJob(source, "NAME", columns=AREA_TABLES[source].columns, **options)


_INCOME_FILTER = "DP03_0052PE > 10 AND DP03_0056PE > 10 AND DP03_0059PE IS NOT NULL"

ROW_JOBS = {
    "income": _survey("Income", classify=income_classes, full_filter=_INCOME_FILTER,
                      sample_filter=_INCOME_FILTER),
    "industry": _survey("Labor_In_Industry", classify=top_industries, counts_as_double=True,
                        sample_filter="DP03_0033E > 10 AND DP03_0034E > 10"),
    "housing_value": _survey("Housing_Value", classify=value_classes),
    "labor_force": _survey("Labor_Force_Stats"),
    "commute": _survey("Commute"),
    "work_stats": _survey("Work_Stats"),
    "hours": _survey("Working_Hours_Per_Week"),
    "weeks": _survey("Working_Weeks_Per_Year"),
    "housing_status": _survey("Housing_Unit_Status"),
    "housing_unit": _survey("Housing_Unit"),
    "built_year": _survey("Built_Year"),
    "enrollment": _survey("General_School_Enrollment"),
    "pubpriv": _survey("PrivatePublic_School_Enrollment"),
    "zipmap": RowJob("zip_to_zcta5", "ZIPCODE", recode={"ZIPCODE": pad_code, "ZCTA5": pad_code}),
    "resources": RowJob("public_resources", "MID", recode={"ZIPCODE": pad_code}),
    "private_school": RowJob("private_school", "SCHOOLID", recode={"ZIPCODE": five_digit_zip}),
    "public_school": RowJob("public_school", "SCHOOLID", recode={"ZIPCODE": five_digit_zip}),
    "postsecondary": RowJob("postsecondary_school", "SCHOOLID", recode={"ZIPCODE": five_digit_zip}),
}

def null_filled(df: DataFrame, job: RowJob, key: str) -> DataFrame:
    """NULL as zero in the job's columns, under their codes."""
    filled = (f"{or_zero(c, job.sink_type(c))} AS {c}" for c in job.columns)
    return df.selectExpr(key, *filled)


def relabelled(df: DataFrame, job: RowJob, key: str) -> DataFrame:
    """Codes to labels; all other columns are dropped."""
    return df.selectExpr(key, *(f"{c} AS {label}" for c, label in job.columns.items()))


def transform(df: DataFrame, job: RowJob, keep_key: bool = False) -> DataFrame:
    """Apply a job to rows of its source table. Consecutive projections collapse into one."""
    if job.recode:
        changed = {c: f"{job.recode[c](c)} AS {c}" for c in job.recode}
        return df.selectExpr(*(changed.get(c, c) for c in df.columns))
    key = job.key if keep_key else f"{area_code(job.key)} AS ZCTA5"
    labelled = relabelled(null_filled(df, job, key), job, job.key if keep_key else "ZCTA5")
    return job.classify(labelled) if job.classify else labelled


def full(source: DataFrame, job: RowJob, filtered: bool = True) -> DataFrame:
    """The whole table. `filtered=False` leaves out the job's source filter."""
    return transform(read_query(source, where=job.full_filter if filtered else None), job)


def sample(source: DataFrame, job: RowJob, keyless: bool = False) -> DataFrame:
    """The dry run: 50 rows with a key, which is kept as it is, or with `keyless` the first 50 of
    all rows, those without a key included."""
    rows = read_sample(read_query(source, where=job.sample_filter), job.key, keyless=keyless)
    return transform(rows, job, keep_key=True)


def sink_schema(name: str, dry_run: bool = False) -> T.StructType:
    """The declared result of a job; a dry run keeps the source's key under its name."""
    declared, job = sink_schemas()[name], ROW_JOBS[name]
    if not (dry_run and job.columns):
        return declared
    return T.StructType([T.StructField(job.key, T.StringType()), *declared.fields[1:]])


def run(source: DataFrame, name: str, target: str, audit_folder: str | None = None,
        dry_run: bool = False, buckets: int | None = None, inputs: str | None = None) -> DataFrame:
    """Transform a stored source table into a stored target table, whole or as a dry run.

    The result is written in the types declared for the job. `buckets` stores an area table
    bucketed by ZCTA5, which spares reports their shuffles. `inputs` is kept with the result.

    Rows read, rows without a key, rows chosen and rows made are counted while the result is written
    and kept with it; if they do not add up, the job fails and the target stays as it was.

    With an audit folder the rows before and after are dumped as well: the first from the
    (pruned) source scan, the second from the stored result, so nothing is computed twice
    and nothing has to be cached.
    """
    job = ROW_JOBS[name]
    used = [job.key, *job.columns] if job.columns else source.columns
    condition = job.sample_filter if dry_run else job.full_filter
    read, chosen, made = Observation(), Observation(), Observation()
    counted = F.count(F.lit(1)).alias("rows")
    seen = [counted, F.count_if(F.col(job.key).isNull()).alias("nameless")]
    whole = read_query(source, used)
    picked = read_query(whole, where=condition)
    # A sample is sorted, for which rows can be read twice; those are counted on their own.
    picked = read_sample(picked, job.key) if dry_run else picked
    if audit_folder:
        dump_rows(picked, f"{audit_folder}/input")
    rows = picked if dry_run else read_query(whole.observe(read, *seen), where=condition)
    result = transform(rows.observe(chosen, counted), job, keep_key=dry_run).observe(made, counted)

    def approve(stored: DataFrame) -> dict[str, str]:
        total = whole.agg(*seen).first().asDict() if dry_run else read.get
        counts = {**total, "chosen": chosen.get["rows"], "made": made.get["rows"],
                  "stored": stored.count()}
        if counts["stored"] != counts["made"]:
            # Tasks of a shuffle that had to run again counted their rows again.
            counts["chosen"] = counts["made"] = picked.count()
        check_counts(name, counts)
        return {"counts": json.dumps(counts), **({"inputs": inputs} if inputs else {})}

    stored = truncate_table(result, target, sink_schema(name, dry_run), "ZCTA5",
                            None if dry_run else buckets, approve)
    if audit_folder:
        dump_rows(stored, f"{audit_folder}/output")
    return stored


def check_counts(name: str, counts: Mapping[str, int]) -> None:
    """A row job makes one row of each it chooses, and all of them are stored."""
    if not counts["rows"] >= counts["chosen"] == counts["made"] == counts["stored"]:
        raise ValueError(f"rows of {name} do not add up: {dict(counts)}")
