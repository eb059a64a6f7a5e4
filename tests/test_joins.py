"""Joins on skewed and NULL keys against the plain joins, in the hot and the cold setting."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areaweave.operators import joins, key_stats
from areaweave.plans import combine
from areaweave.sources import published, tables


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def sides(spark):
    """One right key holds a third of the rows; some keys are on one side only, some NULL."""
    right = [("hot", i) for i in range(100)] + [(f"k{i}", i) for i in range(150)]
    right += [("rare", 1), (None, 7), (None, 8)] + [("hot", 0)] * 20
    left = [("hot", "a"), ("hot", "b"), ("k3", "c"), ("nowhere", "d"), ("rare", "e")]
    left += [(None, f"n{i}") for i in range(30)] + [("hot", "a")]
    return (
        spark.createDataFrame(left, "k STRING, l STRING"),
        spark.createDataFrame(right, "k STRING, r INT"),
    )


def counted(df, slot_rows):
    return key_stats.frequent_keys(df, "k", slot_rows) if slot_rows else None


@pytest.mark.parametrize("slot_rows", [None, 1, 7, 50, 1000])
@pytest.mark.parametrize("unique", [(), ("r",)])
def test_split_left_join_equals_plain_join(spark, slot_rows, unique):
    left, right = sides(spark)
    got = joins.split_left_join(left, right, "k", counted(right, slot_rows), unique, slot_rows or 1)
    assert bag(got) == bag(left.join(right, "k", "left"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.tuples(st.sampled_from("abcd") | st.none(), st.integers(0, 3)), max_size=12),
    right=st.lists(st.tuples(st.sampled_from("abce") | st.none(), st.integers(0, 3)), max_size=25),
    slot_rows=st.sampled_from([1, 2, 5]),
)
def test_split_left_join_on_any_rows(spark, left, right, slot_rows):
    a = spark.createDataFrame(left, "`k` STRING, `l 1` INT").withColumnRenamed("l 1", "l.1")
    b = spark.createDataFrame(right, "k STRING, r INT")
    got = joins.split_left_join(a, b, "k", counted(b, slot_rows), ["r"], slot_rows)
    assert bag(got) == bag(a.join(b, "k", "left"))


def test_frequent_keys_are_exact(spark):
    _, right = sides(spark)
    assert {tuple(r) for r in key_stats.frequent_keys(right, "k", 100).collect()} == {("hot", 120)}
    assert key_stats.frequent_keys(right, "k").count() == 0
    assert key_stats.frequent_keys(right, "k", 0).count() == 152


def test_statistics_belong_to_a_version(spark, tmp_path):
    space = f"stats_{tmp_path.name}".lower().replace("-", "_")
    tables.create_namespace(spark, space, str(tmp_path / "db"))
    _, right = sides(spark)
    name = f"{space}.t"
    assert key_stats.key_statistics(spark, name, "k") is None
    tables.replace_table(right, name)
    with pytest.raises(ValueError, match="published"):
        key_stats.store_key_statistics(spark, f"{space}.other", "k")
    for _ in range(2):
        key_stats.store_key_statistics(spark, name, "k", 10)
    assert bag(key_stats.key_statistics(spark, name, "k")) == {("hot", 120): 1}
    tables.replace_table(right.where("r < 50"), name)
    assert key_stats.key_statistics(spark, name, "k") is None
    published.roll_back(spark, name)
    assert key_stats.key_statistics(spark, name, "k").count() == 1
    tables.replace_table(right, name)
    assert len(published.drop_old(spark, name, keep=0)) == 2
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {space}").collect()]
    assert len(left) == 2 and not any("keys" in n for n in left)


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_join_with_null_keys(spark, how):
    left, right = sides(spark)
    a, b = left.withColumnRenamed("k", "k1"), right.withColumnRenamed("k", "k2")
    assert bag(joins.outer_join(a, b, "k1", "k2", how)) == bag(a.join(b, a.k1 == b.k2, how))


@pytest.fixture
def shuffled(spark):
    """Every join shuffles, and partitions stay as they are."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["left", "full", "unique", "split", "anti"])
def test_null_keys_spread_over_tasks(spark, shuffled, kind):
    left = spark.range(5000).selectExpr("CAST(NULL AS STRING) AS k", "id")
    right = spark.range(10).selectExpr("CAST(id AS STRING) AS k", "id AS r").where("k IS NOT NULL")
    joined = {
        "left": lambda: joins.outer_join(
            left.withColumnRenamed("k", "k1"), right.withColumnRenamed("k", "k2"), "k1", "k2", "left"),
        "full": lambda: joins.outer_join(
            left.withColumnRenamed("k", "k1"), right.withColumnRenamed("k", "k2"), "k1", "k2", "full"),
        "unique": lambda: joins.left_join_unique(left, right, "k"),
        "split": lambda: joins.split_left_join(left, right, "k"),
        "anti": lambda: joins.without_parent(left, right, "k"),
    }[kind]()
    found = joined.where("id IS NOT NULL").selectExpr("spark_partition_id() AS p")
    tasks = found.groupBy("p").count().collect()
    assert sum(r["count"] for r in tasks) == 5000
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 1500


def test_rows_of_a_frequent_key_spread_over_tasks(spark, shuffled):
    """Rows that differ in nothing but the unique column, too."""
    left = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id AS l")
    right = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '7' ELSE CAST(id % 100 AS STRING) END AS k", "id AS r", "1 AS x")
    many = key_stats.frequent_keys(right, "k", 100)
    joined = joins.split_left_join(left, right, "k", many, ["r"], 100)
    slots = right.where("k = '7'").count() // 100
    tasks = joined.where("k = '7'").selectExpr("spark_partition_id() AS p").groupBy("p").count()
    sizes = [r["count"] for r in tasks.collect()]
    assert sum(sizes) == right.where("k = '7'").count() and slots == 20
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 2
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_left_join_unique(spark):
    left, right = sides(spark)
    one = right.dropDuplicates(["k"])
    assert bag(joins.left_join_unique(left, one, "k")) == bag(left.join(one, "k", "left"))


def test_anti_and_semi_cover_all_rows(spark):
    left, right = sides(spark)
    missing = joins.without_parent(left, right, "k")
    present = joins.with_parent(left, right, "k")
    assert bag(missing) + bag(present) == bag(left)
    assert {r.k for r in missing.collect()} == {"nowhere", None}


def test_full_chain_matches_on_the_middle_key_only(spark):
    def area(values, key, column):
        return spark.createDataFrame([(v, f"{column}{v}") for v in values], f"{key} STRING, {column} STRING")

    first = area(["1", "2", "3"], "k1", "a")
    middle = area(["2", "3"], "k2", "b")
    last = area(["1", "3", "4"], "k3", "c")
    rows = bag(combine.full_chain(first, middle, last))
    assert rows == Counter([
        ("1", "a1", None, None), (None, None, None, "c1"),  # in first and last, not in the middle
        ("2", "a2", "b2", None), ("3", "a3", "b3", "c3"), (None, None, None, "c4"),
    ])


def test_reports_neither_cross_join_nor_sort_a_whole_table_for_a_cut(spark):
    from areaweave.plans import entries
    from areaweave.sources.area_tables import AreaTables

    t = AreaTables(spark, "/root/testdata/sf0.001")
    for name in ("x01", "x02", "x04", "j01", "a07", "a09"):
        plan = entries.ENTRIES[name](t)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name in ("x02", "j01", "a07", "a09"):
            assert "TakeOrderedAndProject" in plan, name


def area_rows(spark, seed, n, key, column):
    rng = random.Random(seed)
    keys = [rng.choice([None, *map(str, range(12))]) for _ in range(n)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"{key} STRING, {column} INT")


@pytest.mark.parametrize("how", ["left", "full"])
@pytest.mark.parametrize("tables_", [2, 3, 4])
def test_chain_equals_plain_joins(spark, how, tables_):
    parts = [(area_rows(spark, i, 9 + 3 * i, f"k{i}", f"v{i}"), f"k{i}") for i in range(tables_)]
    plain = parts[0][0]
    for i, (df, key) in enumerate(parts[1:]):
        on = f"k{i}" if how == "full" else "k0"
        plain = plain.join(df, F.col(on) == F.col(key), how)
    got = joins.outer_chain(parts, how)
    assert got.columns == plain.columns and bag(got) == bag(plain)


def planned(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {kind: plan.count(kind) for kind in ("SortMergeJoin", "Exchange hashpartitioning", "FileScan")}


@pytest.mark.parametrize("how,tables_,shuffles", [
    ("left", 3, 3), ("left", 4, 4), ("full", 3, 4), ("full", 4, 6)])
def test_a_chain_plans_every_join_once(spark, shuffled, tmp_path, how, tables_, shuffles):
    parts = []
    for i in range(tables_):
        path = str(tmp_path / f"t{i}")
        area_rows(spark, i, 30, f"k{i}", f"v{i}").write.parquet(path)
        parts.append((spark.read.parquet(path), f"k{i}"))
    found = planned(joins.outer_chain(parts, how))
    set_aside = tables_ if how == "full" else 1
    assert found == {"SortMergeJoin": tables_ - 1, "Exchange hashpartitioning": shuffles,
                     "FileScan": tables_ + set_aside}


@pytest.mark.parametrize("tables_", [3, 4])
def test_a_left_chain_of_bucketed_tables_needs_no_shuffle(spark, shuffled, tmp_path, tables_):
    space = f"chain_{tmp_path.name}".lower().replace("-", "_")
    tables.create_namespace(spark, space, str(tmp_path / "db"))
    parts = []
    for i in range(tables_):
        df = area_rows(spark, i, 30, f"k{i}", f"v{i}")
        parts.append((published.publish(df, f"{space}.t{i}", key=f"k{i}", buckets=4), f"k{i}"))
    chain = joins.outer_chain(parts, "left")
    found = planned(chain)
    assert found["Exchange hashpartitioning"] == 0 and found["SortMergeJoin"] == tables_ - 1
    assert chain.count() >= 30


def test_rows_the_table_before_lacks_are_spread(spark, shuffled):
    """A third table meets 5,000 rows that the second one does not have."""
    first = spark.range(5000).selectExpr("CAST(id AS STRING) AS k1", "id")
    middle = spark.range(10).selectExpr("concat('m', id) AS k2", "id AS m")
    last = spark.range(10).selectExpr("concat('m', id) AS k3", "id AS l")
    chain = joins.outer_chain([(first, "k1"), (middle, "k2"), (last, "k3")], "full")
    found = chain.where("id IS NOT NULL").selectExpr("spark_partition_id() AS p").groupBy("p").count()
    sizes = [r["count"] for r in found.collect()]
    assert sum(sizes) == 5000 and len(sizes) == 8 and max(sizes) < 1500
