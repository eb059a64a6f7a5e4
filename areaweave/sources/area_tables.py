"""The three layers of tables the reports read, as lazy DataFrames.

`AreaTables` derives them from one folder of input files; `StoredTables` reads what the
staged jobs stored. Every report runs on either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from areaweave.operators.key_stats import key_statistics
from areaweave.plans import modeled, row_jobs
from areaweave.sources import derived

_STAGING = {
    "economics": derived.economics,
    "economics_industry": derived.economics_industry,
    "housing": derived.housing,
    "school_enrollment": derived.school_enrollment,
    "work": derived.work,
    "zip_to_zcta5": derived.zip_to_zcta5,
    "public_resources": derived.public_resources,
    "current_students": derived.current_students,
    "new_students": derived.new_students,
    "classes": derived.classes,
}
SCHOOLS = ["private_school", "public_school", "postsecondary_school"]


@dataclass(frozen=True)
class AreaTables:
    spark: SparkSession
    folder: str

    def staging(self, name: str) -> DataFrame:
        if name in SCHOOLS:
            return derived.schools(self.spark, self.folder, name)
        return _STAGING[name](self.spark, self.folder)

    def modeled(self, name: str) -> DataFrame:
        if name in SCHOOLS:
            return modeled.school_table(self.staging(name))
        if name == "zip_to_zcta5":
            return modeled.crosswalk_table(self.staging(name))
        if name == "public_resources":
            return modeled.resource_table(self.staging(name))
        spec = modeled.AREA_TABLES[name]
        return modeled.area_table(self.staging(spec.staging), spec)

    def ready(self, name: str, filtered: bool = True) -> DataFrame:
        job = row_jobs.ROW_JOBS[name]
        return row_jobs.full(self.modeled(job.source), job, filtered)

    def ready_name(self, name: str) -> None:
        """These tables are not stored."""

    def key_stats(self, name: str, key: str) -> None:
        """Nor is anything counted of them."""

    def sample(self, name: str, keyless: bool = False) -> DataFrame:
        job = row_jobs.ROW_JOBS[name]
        return row_jobs.sample(self.modeled(job.source), job, keyless)


@dataclass(frozen=True)
class StoredTables:
    """Tables of `job_survey` and `job_staged` runs that share one namespace."""

    spark: SparkSession
    namespace: str

    def staging(self, name: str) -> DataFrame:
        name = "economics" if name == "economics_industry" else name
        return self.spark.table(f"{self.namespace}_staging.{name}")

    def modeled(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}_modeled.{name}")

    def ready(self, name: str, filtered: bool = True) -> DataFrame:
        job = row_jobs.ROW_JOBS[name]
        if job.full_filter and not filtered:
            return row_jobs.full(self.modeled(job.source), job, filtered)
        return self.spark.table(self.ready_name(name))

    def ready_name(self, name: str) -> str:
        return f"{self.namespace}_modeled.{row_jobs.ROW_JOBS[name].source}_ready"

    def key_stats(self, name: str, key: str) -> DataFrame | None:
        return key_statistics(self.spark, self.ready_name(name), key)

    def sample(self, name: str, keyless: bool = False) -> DataFrame:
        job = row_jobs.ROW_JOBS[name]
        return row_jobs.sample(self.modeled(job.source), job, keyless)
