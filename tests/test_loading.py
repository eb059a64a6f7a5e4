"""Landed extracts, declared schemas, audits and jobs that go on where they broke off."""

import json
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_tables import put, rows, space  # noqa: F401

from areaweave import fixed_values as fv
from areaweave.operators import checks
from areaweave.plans import entries, integrity, row_jobs, staged
from areaweave.sources import csv_files, derived, field_lists, landing, published, scratch, tables
from areaweave.sources.area_tables import AreaTables
from areaweave.sources.csv_files import CsvLoad, write_csv

FOLDER = "/root/testdata/sf0.001"


def landed(spark, tmp_path, text, load=csv_files.PLAIN_LOAD, name="f.csv"):
    folder = str(tmp_path / f"landed-{name}")
    schema = landing.land(spark, put(tmp_path, text, name), load, folder)
    assert schema == landing.landed_schema(spark, folder)
    return landing.landed(spark, folder)


def test_types_of_one_scan(spark, tmp_path):
    df = landed(spark, tmp_path, (
        "i,l,d,b,day,at,mixed,empty,zip,big,signs\n"
        "1,1,1,true,2020-02-29,2020-01-01,1,,00716,99999999999999999999,-\n"
        "-2,3000000000,.5,FALSE,2019-01-01,2020-01-01 10:30,2020-01-01,,78705,1,1\n"
        ",,1e3,,,,,,,,\n"))
    assert dict(df.dtypes) == {
        "i": "int", "l": "bigint", "d": "double", "b": "boolean", "day": "date", "at": "timestamp",
        "mixed": "string", "empty": "string", "zip": "int", "big": "double", "signs": "string"}
    assert [r.d for r in df.collect()] == [1.0, 0.5, 1000.0]
    assert [r.zip for r in df.collect()] == [716, 78705, None]


def test_markers_quotes_and_uneven_rows(spark, tmp_path):
    path = 'ZIP_CODE,STATE,ZCTA\n1,"a ""b""\nc",No ZCTA\n2,,3\n'
    assert rows(landed(spark, tmp_path, path, csv_files.CROSSWALK_LOAD)) == [
        (1, 'a "b"\nc', None), (2, None, 3)]
    uneven = "A,B,C\n1,x,y\n2,x\n3,x,y,z\n"
    assert rows(landed(spark, tmp_path, uneven, csv_files.RESOURCE_LOAD, "u.csv")) == [
        (1, "x", "y"), (2, "x", None), (3, "x", "y")]
    with pytest.raises(Exception, match="MALFORMED"):
        landed(spark, tmp_path, uneven, name="v.csv")


def test_odd_days_are_text(spark, tmp_path):
    df = landed(spark, tmp_path, "day,at\n2021-02-29,2021-01-01 25:00\n2021-01-01,2021-01-01\n")
    assert dict(df.dtypes) == {"day": "string", "at": "string"}


def plain_kind(value):
    if re.fullmatch(r"[+-]?\d+", value, re.ASCII):
        n = int(value)
        if -2**31 <= n < 2**31:
            return "int"
        return "bigint" if -2**63 <= n < 2**63 else "double"
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", value, re.ASCII):
        return "double"
    return "boolean" if value.lower() in ("true", "false") else "string"


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(
    st.integers(-2**65, 2**65).map(str), st.floats(allow_nan=False, allow_infinity=False).map(str),
    st.sampled_from(["true", "False", "-", "N", "+", "1.", ".", "1e", "0x1", "1d", " 1", "²"])),
    min_size=1, max_size=4))
def test_kinds_value_by_value(spark, values):
    kinds = {plain_kind(v) for v in values}
    order = ["int", "bigint", "double"]
    wanted = (max(kinds, key=order.index) if kinds <= set(order)
              else kinds.pop() if len(kinds) == 1 else "string")
    df = spark.createDataFrame([(v,) for v in values], "c STRING")
    found = df.agg(F.expr(f"bit_or({landing.kind_of('c')})")).first()[0]
    assert landing.type_of(found).simpleString() == wanted


def test_every_extract_and_result_is_declared(spark):
    assert set(field_lists.sink_schemas()) == set(row_jobs.ROW_JOBS)
    for table, leading in fv.SCHOOL_LEADING_FIELDS.items():
        assert field_lists.school_fields(table) == leading + fv.SCHOOL_PLACE_FIELDS
    t = AreaTables(spark, FOLDER)
    for name, declared in field_lists.sink_schemas().items():
        assert field_lists.losses(declared, t.ready(name).schema) == [], name
        types = [d for d in field_lists.drift(declared, t.ready(name).schema) if d.problem == "type"]
        assert types == [], name


def test_drift():
    declared = T.StructType.fromDDL("a BIGINT, b DOUBLE, c STRING, d DATE")
    found = T.StructType.fromDDL("C STRING, a INT, b STRING, e INT")
    assert {(d.column, d.problem) for d in field_lists.drift(declared, found)} == {
        ("d", "missing"), ("e", "extra"), ("a", "type"), ("b", "type"), ("a", "order")}
    assert {d.column for d in field_lists.losses(declared, found)} == {"d", "e", "b"}
    assert field_lists.drift(declared, declared) == []


def test_a_changed_type_does_not_get_stored(spark, space):
    source = spark.range(3).selectExpr(
        "concat('ZCTA5 0000', id) AS NAME", *(f"id AS {c}" for c in fv.HOURS))
    row_jobs.run(source, "hours", f"{space}.hours")
    changed = source.withColumn(next(iter(fv.HOURS)), F.lit("many"))
    with pytest.raises((ValueError, PySparkException)):
        row_jobs.run(changed, "hours", f"{space}.hours")
    with pytest.raises(ValueError, match="missing"):
        tables.to_declared(source, field_lists.sink_schemas()["hours"])
    assert spark.table(f"{space}.hours").count() == 3


def test_field_list_from_any_path(spark, tmp_path):
    path = tmp_path / "fields.json"
    path.write_text('[{"name": "a", "type": "DATE"},\n {"name": "b", "type": "INTEGER"}]')
    assert field_lists.read_field_list(spark, str(path)) == T.StructType.fromDDL("a DATE, b BIGINT")
    (tmp_path / "two").mkdir()
    for name in "xy":
        (tmp_path / "two" / name).write_text("[]")
    with pytest.raises(ValueError, match="one field list"):
        field_lists.read_field_list(spark, str(tmp_path / "two"))


def test_counts_are_kept_with_the_result(spark, space):
    names = spark.range(10).selectExpr(
        "CASE WHEN id > 6 THEN NULL ELSE concat('ZCTA5 0000', id) END AS NAME",
        *(f"id AS {c}" for c in fv.HOURS))
    row_jobs.run(names, "hours", f"{space}.hours", buckets=3)
    counts = json.loads(published.notes(spark, f"{space}.hours")["counts"])
    assert counts == {"rows": 10, "nameless": 3, "chosen": 10, "made": 10, "stored": 10}
    row_jobs.run(names, "hours", f"{space}.hours", dry_run=True)
    counts = json.loads(published.notes(spark, f"{space}.hours")["counts"])
    assert counts["rows"] == 10 and counts["stored"] == 7
    published.roll_back(spark, f"{space}.hours")
    assert json.loads(published.notes(spark, f"{space}.hours")["counts"])["stored"] == 10


def test_counts_that_do_not_add_up_fail_the_job(spark, space, monkeypatch):
    """A transformation that drops rows on the way."""
    source = spark.range(10).selectExpr(
        "concat('ZCTA5 0000', id) AS NAME", *(f"id AS {c}" for c in fv.HOURS))
    row_jobs.run(source.limit(4), "hours", f"{space}.hours")
    whole = row_jobs.transform
    monkeypatch.setattr(row_jobs, "transform",
                        lambda *a, **k: whole(*a, **k).where("Work_35h_or_more < 5"))
    with pytest.raises(ValueError, match="add up"):
        row_jobs.run(source, "hours", f"{space}.hours")
    assert spark.table(f"{space}.hours").count() == 4
    assert len(published.versions(spark, f"{space}.hours")) == 1


def test_dry_run_of_any_rows(spark):
    df = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS k")
    some = tables.read_sample(df, "k", 10, ordered=False)
    assert some.count() == 10 and all(r.k is not None for r in some.collect())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "LocalLimit" in plan or "CollectLimit" in plan
    assert [r.k for r in tables.read_sample(df, "k", 3).collect()] == [0, 2, 4]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Order lines of 60 areas, of which 5 are unnamed in the working time extract."""
    folder = str(tmp_path_factory.mktemp("lines"))
    orders = spark.range(1, 61).withColumnRenamed("id", "o_orderkey")
    orders.selectExpr(
        "o_orderkey", "o_orderkey AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice",
        "'5-LOW' AS o_orderpriority").write.parquet(f"{folder}/orders.parquet")
    orders.selectExpr(
        "o_orderkey AS l_orderkey", "o_orderkey AS l_partkey", "o_orderkey AS l_suppkey",
        "1 AS l_linenumber", "CAST(o_orderkey % 50 + 1 AS DOUBLE) AS l_quantity",
        "900.0D AS l_extendedprice", "0.04D AS l_discount", "'A' AS l_returnflag",
        "'F' AS l_linestatus").write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("job", ["work_stats", "hours", "weeks"])
def test_dry_run_of_all_rows(spark, lines, job):
    names = [r.NAME for r in entries.queries()[f"pipe_{job}_sample"](spark, lines).collect()]
    named = [f"{fv.AREA_PREFIX}{key:05}" for key in range(1, 61) if key % 11]
    assert sorted(names, key=lambda n: n or "") == [None] * 5 + named[:45]
    top = entries.queries()[f"q27_{job}_sample"](spark, lines).collect()
    assert [r.NAME for r in top] == named[:20]


def test_extracts_from_lines_that_are_joined_once(spark, lines, tmp_path):
    made = derived.from_lines(spark, lines, str(tmp_path / "counted"))
    assert sorted(made) == ["housing", "school_enrollment", "work"]
    for name, df in made.items():
        alone = AreaTables(spark, lines).staging(name)
        assert df.columns == alone.columns
        assert Counter(df.collect()) == Counter(alone.collect())
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_lines_counted_in_parts(spark, tmp_path):
    """Repeated orders, lines without an order, missing keys and values: the counts of the parts are
    those of all lines at once, for the four extracts."""
    folder = str(tmp_path / "in")
    orders = spark.range(1, 40).selectExpr(
        "CASE WHEN id % 13 = 0 THEN NULL ELSE id - id % 2 END AS o_orderkey",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 7 END AS o_custkey", "'O' AS o_orderstatus",
        "id * 9000.0D AS o_totalprice", "'5-LOW' AS o_orderpriority")
    orders.write.parquet(f"{folder}/orders.parquet")
    spark.range(200).selectExpr(
        "CASE WHEN id % 17 = 0 THEN NULL ELSE id % 45 END AS l_orderkey", "id AS l_partkey",
        "CASE WHEN id % 5 > 0 THEN id END AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CASE WHEN id % 45 NOT IN (6, 10) THEN CAST(id % 50 AS DOUBLE) END AS l_quantity",
        "CASE WHEN id % 3 > 0 THEN id * 700.0D END AS l_extendedprice", "0.04D AS l_discount",
        "CASE WHEN id % 4 > 0 THEN 'A' END AS l_returnflag", "'F' AS l_linestatus",
    ).write.parquet(f"{folder}/lineitem.parquet")
    made = derived.from_lines(spark, folder, str(tmp_path / "counted"), industry=True)
    assert [p.name for p in (tmp_path / "counted").iterdir()] == ["whole"]
    assert len(made) == 4
    for name, df in made.items():
        alone = AreaTables(spark, folder).staging(name)
        assert df.dtypes == alone.dtypes and df.count() >= 8
        assert Counter(df.collect()) == Counter(alone.collect())


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for d in disk.localDirs() for f in Path(str(d)).rglob("shuffle_*.data")}


def test_shuffles_go_when_a_step_ends(spark, tmp_path, space):
    """The files of a large job's shuffles would else stay, all together, until the driver happens
    to collect its garbage."""
    df = spark.range(5000).selectExpr("id AS ZIP_CODE", "'TX' AS STATE", "id % 7 AS ZCTA")
    before, path = _shuffle_files(spark), str(tmp_path / "in" / "zip_to_zcta5")
    write_csv(df.repartition(7, "ZCTA"), path, csv_files.CROSSWALK_LOAD)
    staged.job_staged(spark, "uds", str(tmp_path / "in"), f"{space}_job", str(tmp_path / "job"))
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    # Key statistics are kept as a table; nothing else shuffles.
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.table(f"{space}_job_modeled.zip_to_zcta5_ready").count() == 5000


def test_landings_go_when_they_are_stored(spark, tmp_path, space):
    df = spark.createDataFrame([(1, "TX", 7), (2, None, None)], "ZIP_CODE INT, STATE STRING, ZCTA INT")
    path = tmp_path / "in" / "zip_to_zcta5"
    write_csv(df, str(path), csv_files.CROSSWALK_LOAD)
    assert all(p.name.endswith(".csv.gz") for p in path.glob("part-*"))
    landings = Path(scratch.scratch_root(spark).removeprefix("file:")) / "areaweave"
    before = set(landings.glob("landed-*"))
    counts = staged.job_staged(spark, "uds", str(tmp_path / "in"), f"{space}_job", str(tmp_path / "job"))
    assert set(landings.glob("landed-*")) <= before
    assert {(r.stage, r.row_count) for r in counts.collect()} == {
        ("staging", 2), ("modeled", 1), ("ready", 1)}


def test_survey_rows_leave_only_their_tables(spark):
    """Extracts, counts and landings go with the job; what it stored stays and is read."""
    folder = Path(scratch.scratch_root(spark).removeprefix("file:")) / "areaweave"
    before = set(folder.iterdir()) if folder.exists() else set()
    found = entries.queries()["job_rows_survey"](spark, FOLDER)
    made = {re.sub("-[0-9a-f]{32}", "", p.name) for p in set(folder.iterdir()) - before}
    assert made == {"job", "tables"}
    assert found.select("table_name").distinct().count() == 13


def test_dumps_are_compressed(spark, tmp_path):
    df = spark.range(3000).selectExpr("id AS A_LONG_FIELD_NAME", "CAST(NULL AS STRING) AS ANOTHER_ONE")
    folder = tables.dump_rows(df, str(tmp_path / "dump"))
    parts = list((tmp_path / "dump").glob("part-*"))
    assert parts and sum(p.stat().st_size for p in parts) < 40_000
    lines = spark.read.text(folder).collect()
    assert len(lines) == 3000 and '{"A_LONG_FIELD_NAME":17,"ANOTHER_ONE":null}' in {r.value for r in lines}


def test_a_changed_extract_runs_its_steps_again(spark, tmp_path, space):
    path = tmp_path / "in" / "zip_to_zcta5"
    df = spark.createDataFrame([(1, "TX", 7), (2, "TX", None)], "ZIP_CODE INT, STATE STRING, ZCTA INT")
    name = f"{space}_job"

    def run(**options):
        staged.job_staged(spark, "uds", str(tmp_path / "in"), name, str(tmp_path / "job"), **options)
        return [len(published.versions(spark, f"{name}_{t}")) for t in (
            "staging.zip_to_zcta5", "modeled.zip_to_zcta5", "modeled.zip_to_zcta5_ready")]

    write_csv(df, str(path), csv_files.CROSSWALK_LOAD)
    assert run() == [1, 1, 1] and run() == [1, 1, 1]
    assert run(resume=False) == [2, 2, 2]
    write_csv(df.union(df.selectExpr("ZIP_CODE + 2", "STATE", "9")), str(path), csv_files.CROSSWALK_LOAD)
    assert run() == [3, 3, 3]
    assert spark.table(f"{name}_modeled.zip_to_zcta5_ready").count() == 3
    schema = T.StructType.fromDDL("ZIP_CODE INT, STATE STRING, ZCTA INT")
    assert run(load=CsvLoad(schema=schema, null_marker="No ZCTA")) == [4, 4, 4]


def test_value_counts_answer_all_key_checks(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, None), (2, "bbbbbb"), (None, "a"), (3, None)], "k INT, v STRING")
    counts = checks.value_counts(df, ["k", "v"])
    assert Counter(tuple(r) for r in counts.collect()) == Counter([
        ("k", "1", 2), ("k", "2", 1), ("k", "3", 1), ("k", None, 1),
        ("v", "a", 2), ("v", "bbbbbb", 1), ("v", None, 2)])
    report = checks.as_report(counts, "t", {
        "rows": checks.rows_where("k"), "keys": checks.values_where("k"),
        "long": checks.rows_where("v", "length(value) > 5"),
        "repeated": checks.values_where("k", "rows > 1")})
    assert {r.check_name: r.value for r in report.collect()} == {
        "rows": 5, "keys": 3, "long": 1, "repeated": 1}
    empty = checks.as_report(checks.value_counts(df.limit(0), ["k"]), "t",
                             {"rows": checks.rows_where("k"), "keys": checks.values_where("k")})
    assert [r.value for r in empty.collect()] == [0, 0]
    orphans = checks.orphan_rows(counts, "v", spark.createDataFrame([("a",)], "x STRING"), "x")
    assert Counter(tuple(r) for r in orphans.collect()) == Counter([("v", "bbbbbb", 1), ("v", None, 2)])


def test_integrity_reports_expand_no_rows_per_distinct_count(spark):
    t = AreaTables(spark, FOLDER)
    report = integrity.resource_report(
        t.modeled("public_resources"), t.ready("resources"), t.ready("zipmap"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Cartesian" not in plan
