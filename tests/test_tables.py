"""Loading, storing, checking and the staged job."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaweave import fixed_values as fv
from areaweave.operators import checks
from areaweave.plans import crossing, staged
from areaweave.sources import csv_files, scratch, tables
from areaweave.sources.csv_files import CsvLoad, read_csv, write_csv
from areaweave.sources.field_lists import school_field_list, schema_from_json, schema_from_sink


def put(tmp_path, text, name="f.csv"):
    folder = tmp_path / name.removesuffix(".csv")
    folder.mkdir()
    (folder / name).write_text(text)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_inferred_types_lose_leading_zeros(spark, tmp_path):
    df = read_csv(spark, put(tmp_path, "ZIP,P\n00716,-\n78705,1.5\n"), csv_files.PLAIN_LOAD)
    assert dict(df.dtypes) == {"ZIP": "int", "P": "string"}
    assert rows(df) == [(716, "-"), (78705, "1.5")]


def test_null_marker_and_empty_fields(spark, tmp_path):
    path = put(tmp_path, "ZIP_CODE,STATE,ZCTA\n1,TX,No ZCTA\n2,,3\n")
    df = read_csv(spark, path, csv_files.CROSSWALK_LOAD)
    assert rows(df) == [(1, "TX", None), (2, None, 3)]


def test_quoted_newlines(spark, tmp_path):
    path = put(tmp_path, 'A,B\n1,"two\nlines, ""quoted"""\n2,x\n')
    df = read_csv(spark, path, csv_files.SURVEY_LOAD)
    assert rows(df) == [(1, 'two\nlines, "quoted"'), (2, "x")]


def test_newlines_and_quotes_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc, d'), (2, None)], "i INT, t STRING")
    path = write_csv(df, str(tmp_path / "out"), csv_files.SURVEY_LOAD)
    assert rows(read_csv(spark, path, csv_files.SURVEY_LOAD)) == rows(df)


def test_ragged_rows(spark, tmp_path):
    path = put(tmp_path, "A,B,C\n1,x,y\n2,x\n3,x,y,z\n")
    loose = read_csv(spark, path, csv_files.RESOURCE_LOAD)
    assert rows(loose) == [(1, "x", "y"), (2, "x", None), (3, "x", "y")]
    schema = T.StructType.fromDDL("A INT, B STRING, C STRING")
    kept = read_csv(spark, path, CsvLoad(schema=schema, ragged=True), keep_malformed=True)
    uneven = kept.where(F.col(csv_files.MALFORMED).isNotNull()).select("A")
    assert sorted(r.A for r in uneven.collect()) == [2, 3]


def test_uneven_rows_fail_a_strict_load(spark, tmp_path):
    schema = T.StructType.fromDDL("A INT, B STRING, C STRING")
    path = put(tmp_path, "A,B,C\n1,x,y\n3,x,y,z\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, path, CsvLoad(schema=schema)).select("A").collect()


def test_schemas():
    schema = schema_from_json(school_field_list("public_school"))
    assert len(schema) == 24 and {f.dataType for f in schema} == {T.StringType()}
    assert all(f.nullable for f in schema)
    assert len(schema_from_json(school_field_list("private_school"))) == 23
    mixed = schema_from_json(
        '[{"name": "a", "type": "INTEGER", "mode": "REQUIRED", "description": "key"},'
        ' {"name": "b", "type": "FLOAT"}]'
    )
    assert [(f.name, f.dataType, f.nullable) for f in mixed] == [
        ("a", T.LongType(), False), ("b", T.DoubleType(), True),
    ]
    with pytest.raises(ValueError):
        schema_from_json('[{"name": "a", "type": "GEOGRAPHY"}]')
    assert schema_from_sink("NAME:STRING,\n Rich:FLOAT") == T.StructType.fromDDL(
        "NAME STRING, Rich DOUBLE")


@pytest.fixture
def space(spark, tmp_path):
    name = f"test_{tmp_path.name}".lower().replace("-", "_")
    tables.create_namespace(spark, name, str(tmp_path / "db"))
    tables.create_namespace(spark, name)
    return name


def test_sinks(spark, space):
    df = spark.range(5).selectExpr("id", "id % 2 AS g")
    assert rows(tables.create_table(df, f"{space}.t")) == rows(df)
    with pytest.raises(PySparkException):
        tables.create_table(df, f"{space}.t")
    fewer = tables.replace_table(df.where("id > 2"), f"{space}.t", ["g", "id"])
    assert rows(fewer) == [(3, 1), (4, 0)]
    declared = tables.truncate_table(df, f"{space}.u", "g DOUBLE, id STRING")
    assert dict(declared.dtypes) == {"g": "double", "id": "string"}
    view = tables.store_view(spark, f"{space}.v", f"SELECT id FROM {space}.t WHERE g = 1")
    assert rows(view) == [(3,)]
    tables.replace_table(df, f"{space}.t")
    assert rows(spark.table(f"{space}.v")) == [(1,), (3,)]


def test_sorted_layout_splits_a_frequent_value(spark, space):
    df = spark.range(4000).selectExpr("'00001' AS ZIPCODE", "CAST(id AS STRING) AS SCHOOLID")
    stored = tables.replace_table(df.repartition(8), f"{space}.hot", ["ZIPCODE", "SCHOOLID"])
    assert stored.count() == 4000


def test_scratch_folder_is_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if named:
        assert scratch.scratch_root(spark) == named.rstrip("/")
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")


def test_key_checks(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), ("22", "d")], "k STRING, v STRING")
    assert tuple(checks.key_counts(df, "k").first()) == (4, 3, 2, False)
    assert checks.null_count(df, "k").first()[0] == 1
    assert rows(checks.wrong_length(df, "k", longer_than=1)) == [("22", "d")]
    assert checks.wrong_length(df, "k", shorter_than=2).count() == 2
    parents = spark.createDataFrame([("1",)], "k STRING")
    assert rows(checks.missing_parents(df, parents, "k")) == [("22", "d"), (None, "c")]


def test_zip_without_resource_scores_one_and_finds_none(spark):
    income = spark.createDataFrame([("00001", 10.0), ("00002", 20.0)], "ZCTA5 STRING, Average DOUBLE")
    crosswalk = spark.createDataFrame(
        [("00011", "00001"), ("00012", "00001")], "ZIPCODE STRING, ZCTA5 STRING")
    resources = spark.createDataFrame(
        [("00011", 1), ("00011", 2), ("00099", 3), (None, 4)], "ZIPCODE STRING, MID BIGINT")
    got = crossing.resources_and_income(income, crosswalk, resources)
    assert rows(got) == [("00011", 10.0, 2, 2), ("00012", 10.0, 1, 0), (None, 20.0, 0, 0)]
    listing = crossing.area_resource_listing(income, crosswalk, resources)
    assert listing.count() == 4


def test_staged_job_can_be_repeated(spark, tmp_path, space):
    schema = schema_from_json(school_field_list("public_school"))
    for table in fv.SCHOOL_LEADING_FIELDS:
        names = [f.name for f in schema_from_json(school_field_list(table))]
        values = {"ZIP": "'787051234'", "LAT": "'30.5'", "LON": "'-97.5'", "STATE": "'TX'"}
        df = spark.range(3).selectExpr(
            *(f"{values.get(n, 'CAST(id AS STRING)')} AS {n}" for n in names))
        write_csv(df, str(tmp_path / "in" / table), csv_files.PLAIN_LOAD)
    assert len(schema) == 24
    first, second = (
        rows(staged.job_staged(spark, "edge", str(tmp_path / "in"), f"{space}_job",
                               str(tmp_path / "job")))
        for _ in range(2)
    )
    assert first == second and len(first) == 9 and {r[2] for r in first} == {3}
    ready = spark.table(f"{space}_job_modeled.public_school_ready")
    assert {(r.ZIPCODE, r.LATITUDE, r.LONGITUDE) for r in ready.collect()} == {("78705", 30.5, -97.5)}


def test_reports_run_on_stored_tables(spark, tmp_path, space):
    """Extracts -> jobs -> reports, against the same reports over the derived tables."""
    from areaweave.plans import entries
    from areaweave.sources.area_tables import SCHOOLS, AreaTables, StoredTables

    derived = AreaTables(spark, "/root/testdata/sf0.001")
    name, place = f"{space}_all", str(tmp_path / "all")
    staged.job_survey(spark, entries._write_survey(derived), name, place)
    for dataset, tables_, load in (
        ("edge", SCHOOLS, csv_files.PLAIN_LOAD),
        ("uds", ["zip_to_zcta5"], csv_files.CROSSWALK_LOAD),
        ("iml", ["public_resources"], csv_files.RESOURCE_LOAD),
    ):
        for table in tables_:
            write_csv(derived.staging(table), str(tmp_path / dataset / table), load)
        staged.job_staged(spark, dataset, str(tmp_path / dataset), name, place)
    stored = StoredTables(spark, name)
    for report in ("x01", "x02", "x03", "j04", "j07", "a05", "a07", "a09", "k01", "k03", "q07"):
        assert rows(entries.ENTRIES[report](stored)) == rows(entries.ENTRIES[report](derived)), report


def test_dry_run_stores_fifty_rows_under_the_source_key(spark, tmp_path, space):
    from areaweave.plans import row_jobs

    source = spark.range(80).selectExpr(
        "concat('ZCTA5 ', lpad(id, 5, '0')) AS NAME", *(f"id AS {c}" for c in fv.WEEKS))
    folder = scratch.run_folder(str(tmp_path))
    stored = row_jobs.run(source, "weeks", f"{space}.dry", folder, dry_run=True)
    assert stored.columns == ["NAME", *fv.WEEKS.values()] and stored.count() == 50
    assert spark.read.json(f"{folder}/input").count() == 50
    assert {r.NAME for r in stored.collect()} == {f"ZCTA5 {i:05d}" for i in range(50)}


def test_bucketed_tables_join_without_a_shuffle(spark, space):
    from areaweave.plans import row_jobs

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    source = spark.range(300).selectExpr("concat('ZCTA5 ', lpad(id, 5, '0')) AS NAME", "id")
    stored = [
        row_jobs.run(source.selectExpr("NAME", *(f"id AS {c}" for c in columns)), job,
                     f"{space}.{job}", buckets=4)
        for job, columns in (("weeks", fv.WEEKS), ("hours", fv.HOURS))
    ]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = stored[0].join(stored[1], "ZCTA5")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
