"""Every operator and report as a named query over one folder of input tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave import fixed_values as fv
from areaweave.functions import classes, cleaning, totals
from areaweave.operators import checks, joins, key_stats, ranking
from areaweave.plans import combine, crossing, explore, integrity, reporting, row_jobs
from areaweave.plans.modeled import AREA_TABLES
from areaweave.plans.row_jobs import ROW_JOBS
from areaweave.plans.staged import (
    SURVEY_EXTRACTS, SURVEY_JOBS, TUTORIAL_EXTRACTS, audit, job_load, job_staged, job_survey,
)
from areaweave.sources import csv_files, derived, published, tables
from areaweave.sources.area_tables import SCHOOLS, AreaTables
from areaweave.sources.csv_files import CsvLoad, read_csv, write_csv
from areaweave.sources.field_lists import (
    drift, read_field_list, schema_from_json, school_field_list, school_fields, sink_schemas,
)
from areaweave.sources.landing import land, landed
from areaweave.sources.runs import run_namespace
from areaweave.sources.scratch import drop_path, run_folder, scratch_path

Query = Callable[[AreaTables], DataFrame]
ENTRIES: dict[str, Query] = {}


def entry(name: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} registered twice")
        ENTRIES[name] = query
        return query

    return register


def _table_name(t: AreaTables, name: str) -> str:
    """A name of this call's own."""
    return f"{run_namespace(t.spark)}.{name}"


def _through_csv(t: AreaTables, table: str, load: CsvLoad) -> DataFrame:
    """Write a staging table the way its extract is published and load it again."""
    path = scratch_path(t.spark, table)
    return read_csv(t.spark, write_csv(t.staging(table), path, load), load)


def _landed(t: AreaTables, table: str, load: CsvLoad, rows: DataFrame | None = None) -> DataFrame:
    """The same by landing the extract: its types are found while it is read once. `rows` are the
    staging table's, if they are at hand."""
    folder = scratch_path(t.spark, f"landed-{table}")
    path = write_csv(t.staging(table) if rows is None else rows, scratch_path(t.spark, table), load)
    land(t.spark, path, load, folder)
    return landed(t.spark, folder)


def _fields(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row per value: table, key, column, and the value as a number or as text, by its type."""
    cells = (
        f"named_struct('field', '{f.name}', "
        + ("'number', CAST(NULL AS DOUBLE), 'text', {0})" if f.dataType == tables.T.StringType() else
           "'number', CAST({0} AS DOUBLE), 'text', CAST(NULL AS STRING))").format(f.name)
        for f in df.schema if f.name != key)
    return df.selectExpr(f"'{table}' AS table_name", f"{key} AS area", f"inline(array({', '.join(cells)}))")


# --- sources and sinks ---------------------------------------------------------


@entry("src_csv_infer")
def _(t):
    return _landed(t, "current_students", csv_files.PLAIN_LOAD)


@entry("src_csv_nullmarker")
def _(t):
    return _landed(t, "zip_to_zcta5", csv_files.CROSSWALK_LOAD)


@entry("src_csv_nullmarker_survey")
def _(t):
    """As text, since whether a percentage column loads as text depends on its values."""
    rows = _through_csv(t, "economics", csv_files.SURVEY_LOAD)
    return rows.selectExpr(*(f"CAST({c} AS STRING) AS {c}" for c in rows.columns))


@entry("src_csv_survey_values")
def _(t):
    """The survey in the types found: numbers where every value of a column is one, else text."""
    return _fields(_landed(t, "economics", csv_files.SURVEY_LOAD), "economics", "NAME")


@entry("src_csv_survey_types")
def _(t):
    """The type found for each column of the four survey extracts. Three are made of the same
    order lines, which are gone through once for them."""
    made = derived.from_lines(t.spark, t.folder, scratch_path(t.spark, "counted"))
    found = [(name, field.name, field.dataType.simpleString())
             for name, load in SURVEY_EXTRACTS.items()
             for field in _landed(t, name, load, made.get(name)).schema]
    return t.spark.createDataFrame(found, "table_name STRING, field STRING, type STRING")


for _name in TUTORIAL_EXTRACTS:
    @entry(f"src_tutorial_{_name}")
    def _(t, name=_name):
        """One of the three tutorial extracts, loaded as tables by one job."""
        folder = scratch_path(t.spark, "tutorial")
        for each, load in TUTORIAL_EXTRACTS.items():
            write_csv(t.staging(each), f"{folder}/{each}", load)
        space = run_namespace(t.spark)
        job_load(t.spark, folder, space, TUTORIAL_EXTRACTS, scratch_path(t.spark, "job"))
        return t.spark.table(f"{space}_staging.{name}")


RAGGED_SCHEMA = "MID BIGINT, DISCIPL STRING, ADZIP5 INT, INCOME15 STRING, WEBURL STRING"


@entry("src_csv_ragged")
def _(t):
    """Rows of every event type have another length: short, full or too long."""
    path = scratch_path(t.spark, "ragged")
    t.staging("public_resources").selectExpr(
        "concat_ws(',', slice(array(CAST(MID AS STRING), DISCIPL, CAST(ADZIP5 AS STRING), "
        "INCOME15, WEBURL, 'surplus'), 1, "
        "CASE DISCIPL WHEN 'click' THEN 3 WHEN 'view' THEN 6 ELSE 5 END)) AS line"
    ).write.text(path)
    schema = tables.T.StructType.fromDDL(RAGGED_SCHEMA)
    load = CsvLoad(schema=schema, ragged=True, header=False)
    rows = read_csv(t.spark, path, load, keep_malformed=True)
    uneven = F.col(csv_files.MALFORMED).isNotNull()
    return rows.withColumn("uneven", uneven).drop(csv_files.MALFORMED)


@entry("src_csv_ragged_inferred")
def _(t):
    """The resources' own load: names from the header, types found, uneven rows padded or cut."""
    path = scratch_path(t.spark, "ragged")
    names = "MID,DISCIPL,ADZIP5,INCOME15,WEBURL"
    t.staging("public_resources").selectExpr(
        "concat_ws(',', slice(array(CAST(MID AS STRING), DISCIPL, CAST(ADZIP5 AS STRING), "
        "INCOME15, WEBURL, 'surplus'), 1, "
        f"CASE DISCIPL WHEN 'click' THEN 3 WHEN 'view' THEN 6 ELSE 5 END)) AS `{names}`"
    ).write.options(header=True, quote="", sep="|", ignoreLeadingWhiteSpace=False).csv(path)
    folder = scratch_path(t.spark, "landed-ragged")
    land(t.spark, path, csv_files.RESOURCE_LOAD, folder)
    return landed(t.spark, folder)


@entry("src_csv_schema")
def _(t):
    schema = tables.T.StructType.fromDDL(
        ", ".join(f"{name} STRING" for name in school_fields("public_school"))
    )
    return _through_csv(t, "public_school", CsvLoad(schema=schema))


@entry("src_schema_json")
def _(t):
    schema = schema_from_json(school_field_list("postsecondary_school"))
    return _through_csv(t, "postsecondary_school", CsvLoad(schema=schema))


@entry("src_schema_drift")
def _(t):
    """A field list kept in a file, against the schema found in an extract."""
    path = scratch_path(t.spark, "fields")
    wanted = [{"name": "sid", "type": "INTEGER"}, {"name": "cno", "type": "STRING"},
              {"name": "sname", "type": "STRING"}, {"name": "credits", "type": "FLOAT"}]
    t.spark.createDataFrame([(json.dumps(wanted, indent=1),)], "value STRING").coalesce(
        1).write.text(path)
    found = _landed(t, "current_students", csv_files.PLAIN_LOAD).schema
    return t.spark.createDataFrame(
        [(d.column, d.problem, d.declared, d.found)
         for d in drift(read_field_list(t.spark, path), found)],
        "field STRING, problem STRING, declared STRING, found STRING")


@entry("src_query")
def _(t):
    income = t.modeled("Income")
    return tables.read_query(income, ["NAME", *fv.INCOME], ROW_JOBS["income"].full_filter)


@entry("src_sample")
def _(t):
    return tables.read_sample(t.modeled("Housing_Unit_Status"), "NAME")


@entry("ns_create")
def _(t):
    name = run_namespace(t.spark)
    tables.create_namespace(t.spark, name)
    return tables.replace_table(t.modeled("zip_to_zcta5"), f"{name}.first_table")


@entry("sink_ctas")
def _(t):
    return tables.create_table(t.modeled("Labor_Force_Stats"), _table_name(t, "created"))


@entry("sink_replace")
def _(t):
    """Two versions; the first is of other rows, and read to the end after the swap."""
    name = _table_name(t, "replaced")
    schools, layout = t.modeled("private_school"), ["ZIPCODE", "SCHOOLID"]
    tables.replace_table(schools.where("LATITUDE > 0"), name, layout)
    return tables.replace_table(schools, name, layout)


@entry("sink_rollback")
def _(t):
    """The name points at the version before the last again, of which no file was touched."""
    name = _table_name(t, "replaced")
    tables.replace_table(t.modeled("zip_to_zcta5"), name)
    tables.replace_table(t.modeled("zip_to_zcta5").where("ZCTA5 IS NULL"), name)
    published.roll_back(t.spark, name)
    return t.spark.table(name)


@entry("sink_truncate")
def _(t):
    return tables.truncate_table(
        t.ready("resources"), _table_name(t, "truncated"), sink_schemas()["resources"]
    )


@entry("sink_audit")
def _(t):
    folder = run_folder(scratch_path(t.spark, "audit"))
    row_jobs.run(t.modeled("Working_Weeks_Per_Year"), "weeks", _table_name(t, "audited"), folder)
    before = "NAME STRING, " + ", ".join(f"{c} BIGINT" for c in fv.WEEKS)
    after = "ZCTA5 STRING, " + ", ".join(f"{c} BIGINT" for c in fv.WEEKS.values())
    read = t.spark.read
    a = read.schema(before).json(f"{folder}/input").select(
        F.lit("input").alias("stage"), F.col("NAME").alias("area"), *fv.WEEKS)
    b = read.schema(after).json(f"{folder}/output").select(
        F.lit("output").alias("stage"), F.col("ZCTA5").alias("area"), *fv.WEEKS.values())
    return a.union(b)


@entry("sink_view")
def _(t):
    """A stored view over a name that is published anew afterwards."""
    space = run_namespace(t.spark)
    name = f"{space}.enrollment_stored"
    tables.replace_table(t.ready("pubpriv").where("College_Undergrad_Public = 0"), name)
    view = tables.store_view(t.spark, f"{space}.v_mostly_private", (
        f"SELECT * FROM {name} WHERE College_Undergrad_Private > College_Undergrad_Public"))
    tables.replace_table(t.ready("pubpriv"), name)
    return t.spark.table(f"{space}.v_mostly_private").select(*view.columns)


# --- projections and filters -------------------------------------------------


@entry("proj_columns")
def _(t):
    return t.modeled("Labor_In_Industry").select("NAME", "DP03_0033E", "DP03_0045E")


@entry("proj_rename")
def _(t):
    return t.staging("economics").select(
        "NAME", *(F.col(c).alias(v) for c, v in fv.LABOR_FORCE_REPORT.items()))


@entry("proj_star")
def _(t):
    return t.modeled("Commute").select("*")


@entry("proj_star_plus")
def _(t):
    return combine.built_and_value(t.ready("built_year"), t.ready("housing_value"))


@entry("proj_arith")
def _(t):
    p = t.modeled("PrivatePublic_School_Enrollment")
    return p.select(
        "NAME",
        (F.col("S1401_C03_008E") + F.col("S1401_C03_009E")).alias("Public_enrollment"),
        (F.col("S1401_C05_008E") + F.col("S1401_C05_009E")).alias("Private_enrollment"),
    )


@entry("flt_not_null")
def _(t):
    return t.staging("school_enrollment").where(F.col("S1401_C01_004E").isNotNull())


@entry("flt_range")
def _(t):
    return t.modeled("Income").where((F.col("DP03_0052PE") < 90) & (F.col("DP03_0061PE") < 70))


@entry("flt_nonzero")
def _(t):
    return combine.priced(t.ready("housing_value"))


@entry("flt_disjunction")
def _(t):
    income = t.ready("income", filtered=False)
    return income.where(F.col("Predominant_Class").isin(combine.CLASSES_ABOVE))


@entry("flt_nonempty_string")
def _(t):
    return t.ready("industry").where(combine.named_industries())


@entry("flt_safe_cast")
def _(t):
    rows = t.staging("public_resources").where(F.col("INCOME15").try_cast("double") > 0)
    return rows.select("MID", "INCOME15")


@entry("flt_length")
def _(t):
    return checks.wrong_length(t.modeled("public_school"), "ZIPCODE", longer_than=fv.ZIP_LENGTH)


@entry("flt_scalar_subquery")
def _(t):
    return combine.above_average(t.ready("enrollment"), "College_Undergrad", "Grad_HigherEdu")


@entry("flt_in_subquery")
def _(t):
    income = t.ready("income", filtered=False)
    rich = income.where(F.col("Predominant_Class").isin("Rich", "Upper_Middle"))
    return joins.with_parent(t.ready("housing_value"), rich, "ZCTA5")


# --- scalar functions and row transforms ----------------------------------------


@entry("sc_sentinel_to_double")
def _(t):
    return t.staging("economics").selectExpr(
        "NAME", *(f"{cleaning.marked_to_double(c)} AS {c}" for c in fv.INCOME))


@entry("sc_sentinel_chain")
def _(t):
    return t.staging("work").selectExpr(
        "NAME", *(f"{cleaning.text_measure_to_double(c)} AS {c}" for c in list(fv.WORK_STATS)[:2]))


@entry("sc_blank_to_double")
def _(t):
    return t.staging("public_resources").selectExpr(
        "MID",
        f"{cleaning.blank_to_double('INCOME15')} AS INCOME",
        f"{cleaning.blank_to_double('REVENUE15')} AS REVENUE",
    )


@entry("sc_cast_double")
def _(t):
    return t.staging("postsecondary_school").select(
        "UNITID", F.col("LAT").cast("double").alias("LATITUDE"),
        F.col("LON").cast("double").alias("LONGITUDE"))


@entry("sc_cast_string")
def _(t):
    return t.staging("zip_to_zcta5").select(
        F.col("ZIP_CODE").alias("ZIPCODE"), F.col("ZCTA").cast("string").alias("ZCTA5"))


@entry("sc_safe_cast")
def _(t):
    return t.staging("economics").select(
        "NAME", F.col("DP03_0025E").try_cast("double").alias("Mean_Travel_Time_To_Work"))


@entry("sc_length")
def _(t):
    return t.modeled("private_school").select(
        "SCHOOLID", F.length("ZIPCODE").cast("bigint").alias("zip_length"))


@entry("tx_null_to_zero")
def _(t):
    return row_jobs.null_filled(t.modeled("Income"), ROW_JOBS["income"], "NAME")


@entry("tx_rename_map")
def _(t):
    return row_jobs.relabelled(t.modeled("Commute"), ROW_JOBS["commute"], "NAME")


@entry("tx_area_key")
def _(t):
    return t.modeled("Work_Stats").selectExpr("NAME", f"{cleaning.area_code('NAME')} AS ZCTA5")


@entry("tx_zfill")
def _(t):
    return t.modeled("public_resources").selectExpr(
        "MID", "ZIPCODE", f"{cleaning.pad_code('ZIPCODE')} AS padded")


@entry("tx_zip5")
def _(t):
    return t.modeled("public_school").selectExpr(
        "SCHOOLID", "ZIPCODE", f"{cleaning.five_digit_zip('ZIPCODE')} AS zip5")


@entry("tx_bracket_sum")
def _(t):
    return t.ready("housing_value").select("ZCTA5", *fv.VALUE_CLASSES)


@entry("tx_argmax_label")
def _(t):
    return t.ready("income", filtered=False).selectExpr(
        "ZCTA5", *fv.INCOME_CLASSES, f"{classes.largest_label(list(fv.INCOME_CLASSES))} AS label")


@entry("tx_weighted_score")
def _(t):
    return t.ready("income", filtered=False).select("ZCTA5", "Average")


@entry("tx_top3_labels")
def _(t):
    return t.ready("industry").select("ZCTA5", *fv.TOP_INDUSTRIES)


@entry("tx_passthrough")
def _(t):
    return row_jobs.transform(t.modeled("private_school"), ROW_JOBS["private_school"])


# --- row jobs, whole and as dry run, and looks at their results -----------------


# Dry runs of tables with unnamed areas, which are rows of the job like any other.
_KEYLESS_SAMPLES = ("work_stats", "hours", "weeks")

for _job in ROW_JOBS:
    ENTRIES[f"pipe_{_job}"] = lambda t, job=_job: t.ready(job)
    ENTRIES[f"pipe_{_job}_sample"] = lambda t, job=_job: t.sample(
        job, keyless=job in _KEYLESS_SAMPLES)
    if ROW_JOBS[_job].columns:
        ENTRIES[f"q27_{_job}"] = lambda t, job=_job: explore.preview(t.ready(job), "ZCTA5", 20)
        ENTRIES[f"q27_{_job}_sample"] = lambda t, job=_job: explore.preview(
            t.sample(job), "NAME", 20)


@entry("pipe_income_unfiltered")
def _(t):
    return t.ready("income", filtered=False)


# --- joins ------------------------------------------------------------------------


@entry("join_inner")
def _(t):
    return combine.income_next_to(t.modeled("Working_Hours_Per_Week"), fv.HOURS, t.modeled("Income"))


@entry("join_inner_3way")
def _(t):
    h, c, i = t.ready("hours"), t.ready("commute"), t.ready("industry")
    return h.join(c, "ZCTA5").join(i, "ZCTA5").select(
        "ZCTA5", "Work_35h_or_more", "Work_From_Home", *fv.TOP_INDUSTRIES)


@entry("join_left_chain")
def _(t):
    return combine.working_time_and_income(
        t.ready("hours"), t.ready("weeks"), t.ready("income", filtered=False))


@entry("join_left_using")
def _(t):
    crosswalk = t.ready("zipmap").select("ZCTA5", "ZIPCODE")
    return joins.split_left_join(t.ready("income").select("ZCTA5", "Average"), crosswalk, "ZCTA5",
                                 t.key_stats("zipmap", "ZCTA5"), ["ZIPCODE"])


@entry("join_full_2way")
def _(t):
    return combine.industry_value(t.modeled("Labor_In_Industry"), t.modeled("Housing_Value"))


@entry("join_full_chain")
def _(t):
    return combine.income_value_weeks(
        t.modeled("Income"), t.modeled("Housing_Value"), t.modeled("Working_Weeks_Per_Year"))


@entry("join_to_aggregate")
def _(t):
    return _colleges(t)


@entry("join_agg_to_agg")
def _(t):
    return _schools_and_class(t, filtered=False)


@entry("join_semi")
def _(t):
    return joins.with_parent(t.ready("resources"), t.ready("zipmap"), "ZIPCODE")


@entry("join_anti")
def _(t):
    return joins.without_parent(t.ready("resources"), t.ready("zipmap"), "ZIPCODE")


# --- aggregates ----------------------------------------------------------------------


@entry("agg_count_star")
def _(t):
    return t.ready("private_school").groupBy("ZIPCODE").agg(
        F.count("*").alias("number_of_private_schools"))


@entry("agg_count_col")
def _(t):
    return t.staging("zip_to_zcta5").groupBy("STATE").agg(F.count("ZCTA").alias("with_area"))


@entry("agg_count_distinct")
def _(t):
    return t.modeled("public_resources").groupBy("DISCIPL").agg(
        F.count_distinct("ZIPCODE").alias("zips"))


@entry("agg_sum")
def _(t):
    return combine.enrollment_by_class(t.ready("income", filtered=False), t.ready("pubpriv"))


@entry("agg_avg")
def _(t):
    return t.ready("income", filtered=False).groupBy("Predominant_Class").agg(
        F.expr(f"{totals.steady_avg('Average')} AS Average"))


@entry("agg_group_multi")
def _(t):
    return t.ready("industry").groupBy(*fv.TOP_INDUSTRIES).agg(F.count("*").alias("areas"))


@entry("agg_having_key")
def _(t):
    return t.ready("housing_value").groupBy("High_Housing_Value").agg(
        F.count("*").alias("areas")).where(F.col("High_Housing_Value") > 30)


@entry("agg_having_alias")
def _(t):
    return _work_by_industry(t)


@entry("agg_over_derived")
def _(t):
    return combine.industry_of_graduates(t.ready("industry"), t.ready("enrollment"))


@entry("agg_distinct_rows")
def _(t):
    return t.modeled("Housing_Unit_Status")


# --- order and limit ---------------------------------------------------------------


@entry("top_k")
def _(t):
    return combine.best(t.ready("housing_status"), 20, "Total_Housing_Units")


@entry("top_k_multi")
def _(t):
    return combine.best(t.ready("hours"), 20, "Work_35h_or_more", "No_working")


@entry("top_k_expr")
def _(t):
    return explore.ranked(t.staging("housing"), explore.STAGING_RANKINGS["q08"])


@entry("sort_full")
def _(t):
    return ranking.sorted_rows(
        t.ready("enrollment").select("ZCTA5", "Grad_HigherEdu"), "ZCTA5")


@entry("sort_in_view")
def _(t):
    return combine.in_order(_stored_view(t, "v_Housing_Value_and_Unit_Status"),
                            "Total_Housing_Units")


@entry("sort_in_ctas")
def _(t):
    return tables.replace_table(
        t.modeled("postsecondary_school"), _table_name(t, "sorted_schools"), ["ZIPCODE", "SCHOOLID"])


@entry("limit_plain")
def _(t):
    return explore.preview(t.modeled("public_school"), "SCHOOLID", 10)


@entry("limit_any")
def _(t):
    """Any ten rows: how many there are, have a key and are rows of the table."""
    schools = t.modeled("public_school")
    some = tables.read_sample(schools, "SCHOOLID", 10, ordered=False)
    known = joins.with_parent(some, schools, "SCHOOLID")
    return some.agg(F.count("SCHOOLID").alias("rows")).join(
        known.agg(F.count("SCHOOLID").alias("found")))


# --- checks and the staged job ---------------------------------------------------------


@entry("chk_unique")
def _(t):
    return checks.key_counts(t.ready("zipmap"), "ZIPCODE")


@entry("chk_not_null")
def _(t):
    return checks.null_count(t.ready("private_school"), "ZIPCODE")


@entry("chk_length")
def _(t):
    return checks.wrong_length(t.modeled("zip_to_zcta5"), "ZCTA5", shorter_than=fv.ZIP_LENGTH)


@entry("chk_foreign_key")
def _(t):
    return checks.missing_parents(t.ready("zipmap"), t.ready("income"), "ZCTA5")


_JOBS = {
    "edge": (SCHOOLS, csv_files.PLAIN_LOAD, ["postsecondary", "public_school", "private_school"]),
    "uds": (["zip_to_zcta5"], csv_files.CROSSWALK_LOAD, ["zipmap"]),
    "iml": (["public_resources"], csv_files.RESOURCE_LOAD, ["resources"]),
}


def _extracts(t: AreaTables, dataset: str, left_out: tuple[str, ...] = (),
              folder: str | None = None) -> str:
    folder = folder or scratch_path(t.spark, dataset)
    names, load, _ = _JOBS[dataset]
    for name in names:
        if name not in left_out:
            write_csv(t.staging(name), f"{folder}/{name}", load)
    return folder


def _staged(t: AreaTables, dataset: str, **options) -> tuple[DataFrame, str]:
    """What the job returns, and the namespace it stored its tables in."""
    space, folder = f"{run_namespace(t.spark)}_{dataset}", _extracts(t, dataset)
    counts = job_staged(t.spark, dataset, folder, space, scratch_path(t.spark, "job"), **options)
    drop_path(t.spark, folder)
    return counts, space


for _dataset, _entry_name in {"edge": "job_staged", "uds": "job_staged_uds",
                              "iml": "job_staged_iml"}.items():
    ENTRIES[_entry_name] = lambda t, dataset=_dataset: _staged(t, dataset)[0]


@entry("job_rows_edge")
def _(t):
    """What the job stored, by value."""
    _, space = _staged(t, "edge")
    ready = [t.spark.table(f"{space}_modeled.{name}_ready").select(
        F.lit(name).alias("table_name"), "*") for name in SCHOOLS]
    return ready[0].unionByName(ready[1]).unionByName(ready[2])


@entry("job_rows_uds")
def _(t):
    _, space = _staged(t, "uds")
    return t.spark.table(f"{space}_modeled.zip_to_zcta5_ready")


@entry("job_rows_iml")
def _(t):
    _, space = _staged(t, "iml")
    return t.spark.table(f"{space}_modeled.public_resources_ready")


@entry("job_audit")
def _(t):
    """What was counted while all four jobs ran, and the rows of their dumps."""
    folder, found = scratch_path(t.spark, "audits"), []
    _, survey = _survey(t, audit_root=f"{folder}/survey")
    found.append(audit(t.spark, survey, SURVEY_JOBS))
    for dataset, (_, _, jobs) in _JOBS.items():
        _, space = _staged(t, dataset, audit_root=f"{folder}/{dataset}")
        found.append(audit(t.spark, space, jobs))
    counted = reduce(DataFrame.unionByName, found)
    # <folder>/<job>/<time>/<table>/<input or output>/<file>
    step = F.split("path", "/")
    dumped = t.spark.read.option("recursiveFileLookup", True).text(folder).select(
        F.col("_metadata.file_path").alias("path")).select(
        F.element_at(step, -3).alias("source"), F.element_at(step, -2).alias("dump")).groupBy(
        "source").agg(F.count_if(F.col("dump") == "input").alias("dumped_before"),
                      F.count_if(F.col("dump") == "output").alias("dumped_after"))
    sources = t.spark.createDataFrame([(name, job.source) for name, job in ROW_JOBS.items()],
                                      "job STRING, source STRING")
    return counted.join(sources, "job").join(dumped, "source").drop("source")


@entry("job_rerun")
def _(t):
    """The job fails at one of its extracts, is started again once that is there, and once more:
    every step has run once. Versions of each table, and its rows."""
    folder = _extracts(t, "edge", left_out=("public_school",))
    space, place = f"{run_namespace(t.spark)}_rerun", scratch_path(t.spark, "job")
    try:
        job_staged(t.spark, "edge", folder, space, place)
        raise RuntimeError("an extract is missing")
    except AnalysisException:
        pass
    write_csv(t.staging("public_school"), f"{folder}/public_school", _JOBS["edge"][1])
    for _ in range(2):
        counts = job_staged(t.spark, "edge", folder, space, place)
    stages = {"staging": ("staging", ""), "modeled": ("modeled", ""), "ready": ("modeled", "_ready")}
    made = [(name, stage, len(published.versions(t.spark, f"{space}_{layer}.{name}{end}")))
            for name in SCHOOLS for stage, (layer, end) in stages.items()]
    return counts.join(t.spark.createDataFrame(
        made, "table_name STRING, stage STRING, versions BIGINT"), ["table_name", "stage"])


def _write_survey(t: AreaTables) -> str:
    """The four survey extracts; the industry columns belong to `economics`."""
    folder = scratch_path(t.spark, "survey")
    made = derived.from_lines(t.spark, t.folder, f"{folder}-counted", industry=True)
    industry = made["economics_industry"].drop("DP03_0003E")
    economics = t.staging("economics").join(industry, "NAME", "left")
    for name, load in SURVEY_EXTRACTS.items():
        rows = economics if name == "economics" else made[name]
        write_csv(rows, f"{folder}/{name}", load)
    drop_path(t.spark, f"{folder}-counted")
    return folder


def _survey(t: AreaTables, **options) -> tuple[DataFrame, str]:
    space, folder = f"{run_namespace(t.spark)}_survey", _write_survey(t)
    counts = job_survey(t.spark, folder, space, scratch_path(t.spark, "job"), **options)
    drop_path(t.spark, folder)
    return counts, space


@entry("job_staged_survey")
def _(t):
    return _survey(t)[0]


@entry("job_rows_survey")
def _(t):
    """All values of the thirteen tables the job stored."""
    _, space = _survey(t)
    return reduce(DataFrame.unionByName, (
        _fields(t.spark.table(f"{space}_modeled.{name}_ready"), name, "ZCTA5")
        for name in AREA_TABLES))


# --- exploration reports and previews --------------------------------------------------


for _name, _spec in explore.STAGING_RANKINGS.items():
    ENTRIES[_name] = lambda t, s=_spec: explore.ranked(t.staging(s.source), s)
for _name, _source in zip(["q16", "q17", "q18", "q19"],
                          ["economics", "housing", "school_enrollment", "work"], strict=True):
    ENTRIES[_name] = lambda t, s=_source: checks.name_counts(t.staging(s))
for _name, _spec in explore.MODELED_RANKINGS.items():
    ENTRIES[_name] = lambda t, s=_spec: explore.ranked(t.modeled(s.source), s)
for _number, _table in enumerate(
    [*AREA_TABLES, "postsecondary_school", "public_school", "private_school", "zip_to_zcta5",
     "public_resources"], start=1):
    ENTRIES[f"m{_number:02d}"] = lambda t, name=_table: t.modeled(name)
for _number, _table in enumerate(["postsecondary_school", "public_school", "private_school"], 1):
    ENTRIES[f"e{_number:02d}"] = lambda t, name=_table: explore.schools_with_zip(t.staging(name))
for _table in SCHOOLS:
    ENTRIES[f"e06_{_table}"] = lambda t, name=_table: explore.preview(t.modeled(name), "ZIPCODE", 10)


@entry("e04")
def _(t):
    return explore.crosswalk_with_area(t.staging("zip_to_zcta5"))


@entry("e05_income")
def _(t):
    return explore.resources_with_income(t.staging("public_resources"))


@entry("e05_streets")
def _(t):
    return explore.resource_streets(t.staging("public_resources"))


@entry("e06_zip_to_zcta5")
def _(t):
    return explore.preview(t.modeled("zip_to_zcta5"), "ZIPCODE", 20)


@entry("c01")
def _(t):
    return explore.row_count(t.staging("classes"))


@entry("c02")
def _(t):
    return explore.row_count(t.staging("current_students"), "count")


@entry("c03")
def _(t):
    return explore.students_in(t.staging("current_students"), fv.COURSES)


# --- joined reports -----------------------------------------------------------------------


@entry("j01")
def _(t):
    return combine.first_by_name(combine.labor_income_value(
        t.modeled("Labor_Force_Stats"), t.modeled("Income"), t.modeled("Housing_Value")))


@entry("j02")
def _(t):
    return combine.first_by_name(combine.income_units_labor(
        t.modeled("Income"), t.modeled("Housing_Unit"), t.modeled("Labor_Force_Stats")))


@entry("j03")
def _(t):
    joined = combine.industry_value(t.modeled("Labor_In_Industry"), t.modeled("Housing_Value"))
    return combine.best(joined, 10, "Housing_Value_1M_Or_More")


@entry("j04")
def _(t):
    return combine.first_by_name(combine.income_school_industry(
        t.modeled("Income"), t.modeled("General_School_Enrollment"),
        t.modeled("Labor_In_Industry")))


@entry("j05")
def _(t):
    college = {c: fv.PUBLIC_PRIVATE[c] for c in list(fv.PUBLIC_PRIVATE)[:2]}
    return combine.first_by_name(combine.income_next_to(
        t.modeled("PrivatePublic_School_Enrollment"), college, t.modeled("Income")))


@entry("j06")
def _(t):
    return combine.first_by_name(combine.income_next_to(
        t.modeled("Working_Hours_Per_Week"), fv.HOURS, t.modeled("Income")))


@entry("j07")
def _(t):
    return combine.first_by_name(combine.income_value_weeks(
        t.modeled("Income"), t.modeled("Housing_Value"), t.modeled("Working_Weeks_Per_Year")))


def _stored_view(t, name: str) -> DataFrame:
    """A published view over stored tables: the job's own, or else stored for this call."""
    space = run_namespace(t.spark)
    names = {job: t.ready_name(job) or f"{space}.{job}" for job in reporting.VIEWS[name].reads}
    for job, stored in names.items():
        if t.ready_name(job) is None:
            tables.replace_table(t.ready(job), stored)
    (view,) = reporting.create_views(t.spark, space, names, [name])
    return t.spark.table(view)


for _name in reporting.VIEWS:
    ENTRIES[f"v01_{_name}"] = lambda t, name=_name: _stored_view(t, name)


def _class_and_college(t):
    return combine.class_and_college(t.ready("income"), t.ready("pubpriv"))


def _value_and_units(t):
    return combine.value_and_units(t.ready("housing_value"), t.ready("housing_status"))


def _class_and_value(t):
    return combine.class_and_value(t.ready("income"), t.ready("housing_value"))


def _higher_income(t):
    return combine.industry_of_higher_income(t.ready("income"), t.ready("industry"))


def _work_by_industry(t):
    return combine.work_by_industry(t.ready("hours"), t.ready("commute"), t.ready("industry"))


def _enrollment_by_class(t):
    return combine.enrollment_by_class(t.ready("income"), t.ready("pubpriv"))


def _graduates(t):
    return combine.industry_of_graduates(t.ready("industry"), t.ready("enrollment"))


def _resources(t, filtered=True):
    return crossing.resources_and_income(
        t.ready("income", filtered), t.ready("zipmap"), t.ready("resources"),
        t.key_stats("zipmap", "ZCTA5"))


def _schools_and_class(t, filtered=True):
    return crossing.schools_and_class(
        t.ready("income", filtered), t.ready("zipmap"), t.ready("private_school"),
        t.ready("public_school"))


def _colleges(t):
    return crossing.colleges_and_enrollment(
        t.ready("pubpriv"), t.ready("zipmap"), t.ready("postsecondary"))


@entry("a01")
def _(t):
    return combine.best(_class_and_college(t), 20, "College_Undergrad_Private")


@entry("a02")
def _(t):
    return combine.best(_value_and_units(t), 20, "Total_Housing_Units")


def _new_and_costly(t, above):
    return combine.new_and_costly(t.ready("built_year"), t.ready("housing_value"), above)


@entry("a03")
def _(t):
    return combine.best(_new_and_costly(t, 50), 20, "num_of_highvalue_built2014_or_later")


@entry("a03_above_30")
def _(t):
    return _new_and_costly(t, 30)


@entry("a04")
def _(t):
    return combine.best(_class_and_value(t), 20, "Predominant_Class")


@entry("a05")
def _(t):
    return combine.best(_higher_income(t), 20, "Average")


@entry("a06")
def _(t):
    return combine.best(combine.working_time_and_income(
        t.ready("hours"), t.ready("weeks"), t.ready("income")), 20, "Average")


@entry("a07")
def _(t):
    return combine.best(_work_by_industry(t), 20, "Total_Full_Work_Week", "Total_Work_From_Home")


@entry("a08")
def _(t):
    return combine.in_order(_enrollment_by_class(t), "Total_College_Undergrad_Private")


@entry("a09")
def _(t):
    return ranking.top_k(
        combine.areas_above_average(t.ready("enrollment")), 20,
        "ZCTA5_higher_than_average_schoolenrollment")


@entry("a10")
def _(t):
    return combine.in_order(_graduates(t), "Area_with_Industry")


def _costly_areas(t, filtered=True):
    return combine.in_order(combine.industry_of_costly_areas(
        t.ready("industry"), t.ready("income", filtered), t.ready("housing_value")),
        "Number_of_Area")


def _rich_areas(t, filtered=True):
    return combine.in_order(
        combine.value_of_rich_areas(t.ready("housing_value"), t.ready("income", filtered)),
        "High_Housing_Value")


@entry("a11")
def _(t):
    return _costly_areas(t)


@entry("a11_unfiltered")
def _(t):
    return _costly_areas(t, filtered=False)


@entry("a12")
def _(t):
    return _rich_areas(t)


@entry("a12_unfiltered")
def _(t):
    return _rich_areas(t, filtered=False)


@entry("a13")
def _(t):
    return combine.areas_per_class(t.ready("income"), t.ready("housing_value"))


@entry("a14")
def _(t):
    return combine.best(combine.built_and_value(t.ready("built_year"), t.ready("housing_value")),
                        20, "High_Housing_Value")


@entry("x01")
def _(t):
    return combine.in_order(_resources(t), "num_of_public_resources")


@entry("x01_unfiltered")
def _(t):
    return combine.in_order(_resources(t, filtered=False), "num_of_public_resources")


@entry("x02")
def _(t):
    return combine.best(_schools_and_class(t), 20, "number_of_private_schools")


@entry("x03")
def _(t):
    return combine.best(_colleges(t), 10, "total_number_of_schools")


@entry("x04")
def _(t):
    return crossing.area_resource_listing(
        t.ready("income"), t.ready("zipmap"), t.ready("resources"),
        t.key_stats("zipmap", "ZCTA5"), t.key_stats("resources", "ZIPCODE"))


@entry("x04_split")
def _(t):
    """The same over stored tables with key statistics, one row to a slot: all keys of several
    rows are dealt out."""
    space, spark = run_namespace(t.spark), t.spark
    keys = {"zipmap": "ZCTA5", "resources": "ZIPCODE"}
    stored = {job: tables.replace_table(t.ready(job), f"{space}.{job}") for job in keys}
    for job, key in keys.items():
        key_stats.store_key_statistics(spark, f"{space}.{job}", key, more_than=1)
    return crossing.area_resource_listing(
        t.ready("income"), stored["zipmap"], stored["resources"],
        *(key_stats.key_statistics(spark, f"{space}.{job}", key) for job, key in keys.items()),
        slot_rows=1)


# --- integrity reports ------------------------------------------------------------------


@entry("k01")
def _(t):
    jobs = {"private_school": "private_school", "public_school": "public_school",
            "postsecondary_school": "postsecondary"}
    reports = [integrity.school_report(name, t.modeled(name), t.ready(job))
               for name, job in jobs.items()]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@entry("k02")
def _(t):
    return integrity.crosswalk_report(
        t.modeled("zip_to_zcta5"), t.ready("zipmap"), t.ready("income", filtered=False))


@entry("k03")
def _(t):
    return integrity.resource_report(
        t.modeled("public_resources"), t.ready("resources"), t.ready("zipmap"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(AreaTables(spark, folder))

    return {name: bind(query) for name, query in ENTRIES.items()}
