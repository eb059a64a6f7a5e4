"""The staged job: load, model and transform one dataset in a single application."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.operators.key_stats import key_statistics, store_key_statistics
from areaweave.plans import modeled, reporting, row_jobs
from areaweave.sources import csv_files, published
from areaweave.sources.csv_files import CsvLoad, read_csv
from areaweave.sources.field_lists import school_field_list, schema_from_json
from areaweave.sources.landing import land, landed
from areaweave.sources.published import Approval
from areaweave.sources.scratch import drop_path, run_folder, scratch_path, shuffles_released
from areaweave.sources.tables import create_namespace, replace_table


@dataclass(frozen=True)
class Branch:
    """One file's way through the job; branches of a dataset do not depend on each other."""

    table: str
    load: CsvLoad
    model: Callable[[DataFrame], DataFrame]
    layout: tuple[str, ...]
    row_job: str
    counted: tuple[str, ...] = ()
    """Keys of the finished table whose statistics are stored with it."""


def _school(table: str, row_job: str) -> Branch:
    load = CsvLoad(schema=schema_from_json(school_field_list(table)))
    return Branch(table, load, modeled.school_table, ("ZIPCODE", "SCHOOLID"), row_job)


DATASETS = {
    "edge": [
        _school("postsecondary_school", "postsecondary"),
        _school("public_school", "public_school"),
        _school("private_school", "private_school"),
    ],
    "uds": [Branch("zip_to_zcta5", csv_files.CROSSWALK_LOAD, modeled.crosswalk_table,
                   ("ZIPCODE",), "zipmap", ("ZCTA5",))],
    "iml": [Branch("public_resources", csv_files.RESOURCE_LOAD, modeled.resource_table,
                   (), "resources", ("ZIPCODE",))],
}


TUTORIAL_EXTRACTS = {
    "classes": csv_files.PLAIN_LOAD,
    "current_students": csv_files.PLAIN_LOAD,
    "new_students": csv_files.PLAIN_LOAD,
}

SURVEY_EXTRACTS = {
    "economics": csv_files.SURVEY_LOAD,
    "housing": csv_files.SURVEY_LOAD,
    "school_enrollment": csv_files.SURVEY_LOAD,
    "work": csv_files.WORK_LOAD,
}


def extract_of(table: str) -> str:
    """The survey extract a modelled table is cut from; industries are in `economics`."""
    name = modeled.AREA_TABLES[table].staging
    return "economics" if name == "economics_industry" else name


def _namespaces(spark: SparkSession, namespace: str, location: str | None) -> tuple[str, str]:
    names = f"{namespace}_staging", f"{namespace}_modeled"
    for name in names:
        create_namespace(spark, name, f"{location}/{name}" if location else None)
    return names


def files_mark(spark: SparkSession, path: str) -> str:
    """Changes when any file below `path` does: names, sizes and times, not contents, are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)), F.sum("length"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38, 0)"))).first()
    return " ".join(map(str, found))


@dataclass(frozen=True)
class Run:
    """One start of a job. With `resume`, a step whose stored result was made from the same input is
    not run again, so after a failure a job goes on where it broke off."""

    spark: SparkSession
    staging: str
    modeled: str
    resume: bool
    audit: str | None

    def step(self, target: str, inputs: str, make: Callable[[Approval], DataFrame]) -> DataFrame:
        """`make` stores the target; `inputs` stands for all it depends on."""
        if self.resume and published.notes(self.spark, target).get("inputs") == inputs:
            return self.spark.table(target)
        return make(lambda stored: {"inputs": inputs})

    def load(self, table: str, path: str, load: CsvLoad) -> DataFrame:
        """The staging table: with a schema read as that, else landed, which reads the files once."""
        target = f"{self.staging}.{table}"

        def make(approve: Approval) -> DataFrame:
            if load.schema:
                return replace_table(read_csv(self.spark, path, load), target, approve=approve)
            folder = scratch_path(self.spark, f"landed-{table}")
            schema = land(self.spark, path, load, folder)
            stored = replace_table(landed(self.spark, folder, schema), target, approve=approve)
            drop_path(self.spark, folder)
            return stored

        return self.step(target, f"{files_mark(self.spark, path)} {load}", make)

    def model(self, table: str, source: str, rows: Callable[[DataFrame], DataFrame],
              layout: tuple[str, ...] = ()) -> DataFrame:
        target, version = f"{self.modeled}.{table}", published.current(self.spark, source)
        return self.step(target, str(version), lambda approve: replace_table(
            rows(self.spark.table(version)), target, layout, approve))

    def transform(self, table: str, job: str, buckets: int | None = None,
                  counted: tuple[str, ...] = ()) -> DataFrame:
        source, target = f"{self.modeled}.{table}", f"{self.modeled}.{table}_ready"
        version = published.current(self.spark, source)
        inputs = f"{version} {buckets}"
        folder = f"{self.audit}/{table}" if self.audit else None
        ready = self.step(target, inputs, lambda _: row_jobs.run(
            self.spark.table(version), job, target, folder, buckets=buckets, inputs=inputs))
        for key in counted:
            if key_statistics(self.spark, target, key) is None:
                store_key_statistics(self.spark, target, key)
        return ready


def _start(spark: SparkSession, namespace: str, location: str | None, resume: bool,
           audit_root: str | None) -> Run:
    return Run(spark, *_namespaces(spark, namespace, location), resume,
               run_folder(audit_root) if audit_root else None)


def _counted(df: DataFrame, table: str, stage: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(table).alias("table_name"), F.lit(stage).alias("stage"), "row_count"
    )


def _side_by_side(step: Callable[..., list[DataFrame]], parts: list) -> list[DataFrame]:
    """Start the steps together; Spark shares the cluster among their jobs. One that fails
    lets the others end before it is reported."""
    with ThreadPoolExecutor(len(parts)) as pool:
        return [df for found in pool.map(step, parts) for df in found]


def job_staged(spark: SparkSession, dataset: str, in_dir: str, namespace: str,
               location: str | None = None, load: CsvLoad | None = None, resume: bool = True,
               audit_root: str | None = None) -> DataFrame:
    """Run a dataset's branches; `<in_dir>/<table>` holds the extract of each.

    Creates `<namespace>_staging` and `<namespace>_modeled`, and in the latter the modelled
    table and `<table>_ready`. Every step reads the version the step before stored and
    publishes its own, so the job can be repeated, and a lost executor costs one step at
    most. Finished steps are kept with a mark of their input and not run again; `resume=False`
    runs all. `audit_root`: dump the rows before and after each row job below it, in a folder
    named by the time. Returns table names and row counts. `load` replaces how the files are
    read, for example to give an otherwise inferred extract a schema.
    """
    run = _start(spark, namespace, location, resume, audit_root)

    def branch(b: Branch) -> list[DataFrame]:
        staged = run.load(b.table, f"{in_dir}/{b.table}", load or b.load)
        clean = run.model(b.table, f"{run.staging}.{b.table}", b.model, b.layout)
        ready = run.transform(b.table, b.row_job, counted=b.counted)
        return [_counted(staged, b.table, "staging"), _counted(clean, b.table, "modeled"),
                _counted(ready, b.table, "ready")]

    with shuffles_released(spark):
        return reduce(DataFrame.unionByName, _side_by_side(branch, DATASETS[dataset]))


def job_load(spark: SparkSession, in_dir: str, namespace: str, loads: Mapping[str, CsvLoad],
             location: str | None = None, resume: bool = True) -> list[str]:
    """Load extracts, `<in_dir>/<name>` each, as tables of `<namespace>_staging`; returns their
    full names."""
    run = _start(spark, namespace, location, resume, None)
    with shuffles_released(spark):
        _side_by_side(lambda name: [run.load(name, f"{in_dir}/{name}", loads[name])], list(loads))
    return [f"{run.staging}.{name}" for name in loads]


def job_survey(spark: SparkSession, in_dir: str, namespace: str, location: str | None = None,
               schemas: dict[str, CsvLoad] | None = None, buckets: int | None = None,
               resume: bool = True, audit_root: str | None = None) -> DataFrame:
    """Load the four survey extracts and make all modelled and transformed area tables.

    Same layout, repeatability and result as `job_staged`; `schemas` replaces how single
    extracts are read, `buckets` stores the transformed tables bucketed by area.
    """
    run = _start(spark, namespace, location, resume, audit_root)

    def load(name: str) -> list[DataFrame]:
        how = {**SURVEY_EXTRACTS, **(schemas or {})}[name]
        return [_counted(run.load(name, f"{in_dir}/{name}", how), name, "staging")]

    def make(job: str) -> list[DataFrame]:
        table = row_jobs.ROW_JOBS[job].source
        clean = run.model(table, f"{run.staging}.{extract_of(table)}", lambda staged: (
            modeled.area_table(staged, modeled.AREA_TABLES[table])))
        ready = run.transform(table, job, buckets)
        return [_counted(clean, table, "modeled"), _counted(ready, table, "ready")]

    with shuffles_released(spark):
        counts = _side_by_side(load, list(SURVEY_EXTRACTS)) + _side_by_side(make, SURVEY_JOBS)
    return reduce(DataFrame.unionByName, counts)


SURVEY_JOBS = [name for name, job in row_jobs.ROW_JOBS.items() if job.columns]


def audit(spark: SparkSession, namespace: str, jobs: Sequence[str]) -> DataFrame:
    """What was counted while the results of row jobs were written: rows read, of these without a
    key, chosen, made and stored. One row per job, from what is kept with the tables."""
    rows = []
    for name in jobs:
        table = f"{namespace}_modeled.{row_jobs.ROW_JOBS[name].source}_ready"
        counts = json.loads(published.notes(spark, table)["counts"])
        rows.append((name, *(counts[c] for c in ("rows", "nameless", "chosen", "made", "stored"))))
    return spark.createDataFrame(rows, (
        "job STRING, rows_read BIGINT, rows_without_key BIGINT, rows_chosen BIGINT, "
        "rows_made BIGINT, rows_stored BIGINT"))


def job_views(spark: SparkSession, namespace: str, tables: Mapping[str, str] | None = None,
              location: str | None = None) -> list[str]:
    """Keep the published views in `<namespace>_reporting`, over the tables the jobs stored in
    `<namespace>_modeled`, or over `tables` (row job -> table). Safe to repeat."""
    stored = tables or {name: f"{namespace}_modeled.{job.source}_ready"
                        for name, job in row_jobs.ROW_JOBS.items()}
    space = f"{namespace}_reporting"
    create_namespace(spark, space, f"{location}/{space}" if location else None)
    return reporting.create_views(spark, space, stored)
