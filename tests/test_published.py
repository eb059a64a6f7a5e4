"""Versioned tables, stored views and names of one run."""

from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from test_tables import rows, space  # noqa: F401

from areaweave.plans import entries, reporting, staged
from areaweave.sources import published, runs, tables
from areaweave.sources.area_tables import AreaTables

FOLDER = "/root/testdata/sf0.001"


def test_open_reader_finishes_after_the_swap(spark, space):
    name = f"{space}.t"
    first = tables.replace_table(spark.range(100).repartition(4), name)
    half = first.where("id < 50")
    second = tables.replace_table(spark.range(7), name)
    assert first.count() == 100 and half.count() == 50
    assert second.count() == spark.table(name).count() == 7
    assert len(published.versions(spark, name)) == 2


def test_failed_write_leaves_the_old_table(spark, space):
    name = f"{space}.t"
    tables.replace_table(spark.range(5), name)
    broken = spark.range(20).selectExpr("id", "IF(id = 13, raise_error('no'), id) AS x")
    with pytest.raises(PySparkException):
        tables.replace_table(broken, name)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 5
    assert len(published.versions(spark, name)) == 1


def test_a_version_can_have_other_columns_and_read_the_one_before(spark, space):
    name = f"{space}.T"
    tables.replace_table(spark.range(5), name)
    tables.replace_table(spark.table(name).selectExpr("id", "id * 2 AS twice"), name)
    assert rows(spark.table(name))[-1] == (4, 8)
    old = published.roll_back(spark, name)
    assert spark.table(name).columns == ["id"] and published.current(spark, name) == old
    with pytest.raises(ValueError, match="earlier"):
        published.roll_back(spark, name)
    with pytest.raises(ValueError, match="no version"):
        published.roll_back(spark, name, f"{space}.other")


def test_old_versions_go_on_request(spark, space):
    name = f"{space}.t"
    tables.replace_table(spark.range(1), f"{space}.t_other")
    for n in range(4):
        tables.replace_table(spark.range(n), name)
    assert published.drop_old(spark, name, 0, timedelta(hours=1)) == []
    stored = published.versions(spark, name)
    assert published.drop_old(spark, name, keep=1) == stored[:2]
    assert published.versions(spark, name) == stored[2:]
    published.roll_back(spark, name)
    assert published.drop_old(spark, name, keep=0) == stored[3:]
    assert spark.table(name).count() == 2 and spark.table(f"{space}.t_other").count() == 1


def test_plain_tables_are_taken_over_and_other_views_left_alone(spark, space):
    tables.create_table(spark.range(3), f"{space}.plain")
    assert published.current(spark, f"{space}.plain") is None
    tables.replace_table(spark.range(4), f"{space}.plain")
    published.roll_back(spark, f"{space}.plain")
    assert spark.table(f"{space}.plain").count() == 3
    tables.store_view(spark, f"{space}.v", f"SELECT * FROM {space}.plain")
    with pytest.raises(ValueError, match="view"):
        tables.replace_table(spark.range(1), f"{space}.v")
    assert spark.table(f"{space}.v").count() == 3


@pytest.mark.parametrize("name", [
    "ns_create", "sink_ctas", "sink_replace", "sink_rollback", "sink_truncate", "sink_view",
    "sort_in_ctas", "sink_audit"])
def test_entries_can_be_called_twice(spark, name):
    t = AreaTables(spark, FOLDER)
    first, second = (entries.ENTRIES[name](t) for _ in range(2))
    assert rows(first) == rows(second) == rows(first)


def test_namespaces_of_old_runs_go_on_request(spark):
    name = runs.run_namespace(spark)
    tables.replace_table(spark.range(3), f"{name}.t")
    spark.sql("CREATE DATABASE IF NOT EXISTS areaweave_run_kept")
    assert name not in runs.drop_runs(spark, timedelta(hours=1))
    assert spark.table(f"{name}.t").count() == 3
    assert name in runs.drop_runs(spark, timedelta(0))
    found = {row[0] for row in spark.sql("SHOW DATABASES").collect()}
    assert name not in found and "areaweave_run_kept" in found


@pytest.mark.parametrize("name", list(reporting.VIEWS))
def test_stored_views_show_what_is_published(spark, name):
    t = AreaTables(spark, FOLDER)
    view = entries.ENTRIES[f"v01_{name}"](t)
    space = max(n for n in (r[0] for r in spark.sql("SHOW DATABASES").collect())
                if published.stamped_at(n, runs.PREFIX))
    kept = {row.viewName for row in spark.sql(f"SHOW VIEWS IN {space}").collect()
            if not row.isTemporary}
    assert name.lower() in kept
    found = view.count()
    assert found > 0 or name == "v_Industry_With_Higher_Income"
    table = reporting.VIEWS[name].reads[0]
    tables.replace_table(spark.table(f"{space}.{table}").where("false"), f"{space}.{table}")
    assert spark.table(f"{space}.{name}").count() == 0 and view.count() == found


def test_job_makes_the_views(spark, space, tmp_path):
    names = {job: f"{space}.{job}" for view in reporting.VIEWS.values() for job in view.reads}
    t = AreaTables(spark, FOLDER)
    for job, name in names.items():
        tables.replace_table(t.ready(job), name)
    made = staged.job_views(spark, space, names, str(tmp_path / "views"))
    assert [m.split(".")[1] for m in made] == list(reporting.VIEWS)
    again = staged.job_views(spark, space, names)
    assert made == again and made[0].startswith(f"{space}_reporting.")
