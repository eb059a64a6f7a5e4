"""Area-shaped source tables derived from the order, customer and event tables.

They have the columns, types and oddities of the published extracts (suppressed values,
missing names, repeated rows, ZIP+4 codes, blank amounts, areas missing from some
tables), produced by rule from every input row. An area is a customer key. Column
pruning reaches through: an unused derived column is never computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave import fixed_values as fv
from areaweave.sources.field_lists import school_fields
from areaweave.sources.scratch import drop_path, shuffles_released

# Parts that order lines are joined and counted in, one after the other.
PARTS = 3

# Columns used of each input table; declared, so that opening one costs no footer scan.
_INPUT = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_INPUT[table]).parquet(f"{sf_dir}/{table}.parquet")


def _unless_every(n: int | None, value: str) -> str:
    """NULL for every n-th area, else the value."""
    return f"CASE WHEN pmod(o_custkey, {n}) <> 0 THEN {value} END" if n else value


@dataclass(frozen=True)
class Extract:
    """shares, counts: code -> condition; measures: code -> (value, divisor of its mean); totals:
    codes that hold the number of rows."""

    shares: Mapping[str, str] = field(default_factory=dict)
    counts: Mapping[str, str] = field(default_factory=dict)
    measures: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    totals: Sequence[str] = ()
    unnamed_every: int | None = None
    unknown_every: int | None = None


def _counted(rows: DataFrame, *extracts: Extract) -> DataFrame:
    """One row per area with all that these extracts, whose codes differ, are made of. Counting is
    combined map-side, so an area with a large part of all rows is no burden."""
    found = {}
    for each in extracts:
        found |= {code: f"count_if({cond})" for code, cond in {**each.shares, **each.counts}.items()}
        found |= {code: f"avg({value})" for code, (value, _) in each.measures.items()}
    return rows.groupBy("o_custkey").agg(
        F.expr("count(*) AS all_rows"),
        *(F.expr(f"{agg} AS n_{code}") for code, agg in found.items()),
    )


def _per_area(grouped: DataFrame, of: Extract) -> DataFrame:
    """One row per area: percentages as text, counts, and text measures with markers."""
    name = f"concat('{fv.AREA_PREFIX}', lpad(CAST(o_custkey AS STRING), 5, '0'))"
    percent = (
        "CASE WHEN pmod(o_custkey, 37) = 0 THEN NULL "
        f"WHEN n_{{0}} = 0 THEN '{fv.SUPPRESSED}' "
        "ELSE CAST(round(100.0D * n_{0} / all_rows, 1) AS STRING) END AS {0}"
    )
    measure = (
        f"CASE WHEN pmod(o_custkey, 20) = 0 THEN '{fv.NOT_AVAILABLE}' "
        f"WHEN pmod(o_custkey, 20) = 1 THEN '{fv.SUPPRESSED}' "
        "ELSE CAST(round(n_{0} / {1}, 1) AS STRING) END AS {0}"
    )
    return grouped.selectExpr(
        "o_custkey",
        f"{_unless_every(of.unnamed_every, name)} AS NAME",
        *(f"all_rows AS {code}" for code in of.totals),
        *(percent.format(code) for code in of.shares),
        *(f"{_unless_every(of.unknown_every, f'n_{code}')} AS {code}" for code in of.counts),
        *(measure.format(code, divisor) for code, (_, divisor) in of.measures.items()),
    )


def _lines(spark: SparkSession, sf_dir: str, some: str = "true") -> DataFrame:
    """Order lines with their orders. `some`: a condition that both sides' order keys `{}` meet."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders = orders.where(some.format("o_orderkey"))
    lines = load(spark, sf_dir, "lineitem").where(some.format("l_orderkey"))
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def _numbered(codes, value: str, start: int = 0) -> dict[str, str]:
    return {code: f"{value} = {i}" for i, code in enumerate(codes, start)}


def economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income, commute and labor-force columns."""
    shares = {
        **_numbered(fv.INCOME, "floor(o_totalprice / 50000)"),
        **_numbered(list(fv.COMMUTE)[:6], "pmod(o_orderkey, 6)"),
        "DP03_0002PE": "o_orderstatus = 'O'",
        "DP03_0004PE": "o_orderstatus = 'F'",
        "DP03_0005PE": "o_orderstatus = 'P'",
    }
    extract = Extract(shares, measures={"DP03_0025E": ("o_totalprice", 10000)},
                      totals=["DP03_0003E", "DP03_0014E"])
    return _per_area(_counted(load(spark, sf_dir, "orders"), extract), extract).drop("o_custkey")


def economics_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The industry columns of the same extract, which come from the order lines."""
    return _industry(_counted(_lines(spark, sf_dir), INDUSTRY))


INDUSTRY = Extract(counts=_numbered(fv.INDUSTRY, "pmod(l_partkey, 12)"), totals=["DP03_0003E"])

HOUSING = Extract(
    shares={
        "DP04_0002PE": "l_linestatus = 'F'",
        "DP04_0003PE": "l_linestatus = 'O'",
        **_numbered(fv.HOUSING_UNIT, "pmod(l_partkey, 9)"),
        **_numbered(fv.BUILT_YEAR, "pmod(l_suppkey, 10)"),
        **_numbered(fv.HOUSING_VALUE, "least(7, floor(l_extendedprice / 13125))"),
    },
    totals=["DP04_0001E", "DP04_0006E"], unnamed_every=7)

SCHOOL_ENROLLMENT = Extract(
    counts={
        **_numbered(fv.ENROLLMENT, "pmod(l_partkey, 6)"),
        "S1401_C03_008E": "l_returnflag = 'A' AND l_linestatus = 'F'",
        "S1401_C05_008E": "l_returnflag = 'A' AND l_linestatus = 'O'",
        "S1401_C03_009E": "l_returnflag = 'R' AND l_linestatus = 'F'",
        "S1401_C05_009E": "l_returnflag = 'R' AND l_linestatus = 'O'",
        "S1401_C03_011E": "l_linestatus = 'F' AND l_quantity <= 25",
        "S1401_C05_011E": "l_linestatus = 'F' AND l_quantity > 25",
        "S1401_C03_012E": "l_linestatus = 'O' AND l_quantity <= 25",
        "S1401_C05_012E": "l_linestatus = 'O' AND l_quantity > 25",
    },
    unnamed_every=13, unknown_every=41)

WORK = Extract(
    counts={
        **_numbered(fv.WEEKS, "l_linenumber", start=1),
        **_numbered(fv.HOURS, "floor((l_quantity - 1) / 13)"),
        "S2303_C03_030E": "l_discount < 0.05D",
        "S2303_C05_030E": "l_discount >= 0.05D",
    },
    measures={"S2303_C01_031E": ("l_quantity", 1), "S2303_C01_032E": ("l_extendedprice", 1000)},
    totals=["S2303_C01_033E"], unnamed_every=11, unknown_every=41)


def _industry(grouped: DataFrame) -> DataFrame:
    return _per_area(grouped, INDUSTRY).drop("o_custkey")


def _housing(grouped: DataFrame) -> DataFrame:
    times = "explode(sequence(1, CASE WHEN pmod(o_custkey, 10) = 3 THEN 2 ELSE 1 END)) AS copy"
    return _per_area(grouped, HOUSING).selectExpr("*", times).drop("o_custkey", "copy")


def _school_enrollment(grouped: DataFrame) -> DataFrame:
    return _per_area(grouped, SCHOOL_ENROLLMENT).drop("o_custkey")


def _work(grouped: DataFrame) -> DataFrame:
    return _per_area(grouped, WORK).drop("o_custkey")


def housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Housing columns; some areas are unnamed and some come twice."""
    return _housing(_counted(_lines(spark, sf_dir), HOUSING))


def school_enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrollment counts; some unnamed areas and missing counts."""
    return _school_enrollment(_counted(_lines(spark, sf_dir), SCHOOL_ENROLLMENT))


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working time counts and measures; some unnamed areas and missing counts."""
    return _work(_counted(_lines(spark, sf_dir), WORK))


def _counted_lines(spark: SparkSession, sf_dir: str, folder: str, *extracts: Extract) -> DataFrame:
    """`_counted` over the order lines, stored in `folder`. The lines are gone through in parts by
    order, so that only one part's shuffles are there at a time; counts and sums are added up."""
    found = {}
    for each in extracts:
        found |= {code: f"count_if({cond})" for code, cond in {**each.shares, **each.counts}.items()}
    values = {code: value for each in extracts for code, (value, _) in each.measures.items()}
    made = {"all_rows": "count(*)", **{f"n_{code}": agg for code, agg in found.items()},
            **{f"sum_{code}": f"sum({value})" for code, value in values.items()},
            **{f"known_{code}": f"count({value})" for code, value in values.items()}}
    with shuffles_released(spark):
        for part in range(PARTS):
            rows = _lines(spark, sf_dir, f"pmod(xxhash64({{}}), {PARTS}) = {part}")
            counts = rows.groupBy("o_custkey").agg(
                *(F.expr(f"{agg} AS {name}") for name, agg in made.items()))
            counts.write.parquet(f"{folder}/parts/{part}", compression="zstd")
        parts = spark.read.schema(counts.schema).option("recursiveFileLookup", True).parquet(
            f"{folder}/parts")
        grouped = parts.groupBy("o_custkey").agg(
            *(F.expr(f"sum({name}) AS {name}") for name in made)).selectExpr(
            "o_custkey", "all_rows", *(f"n_{code}" for code in found),
            *(f"sum_{code} / nullif(known_{code}, 0) AS n_{code}" for code in values))
        grouped.write.parquet(f"{folder}/whole", compression="zstd")
    drop_path(spark, f"{folder}/parts")
    return spark.read.schema(grouped.schema).parquet(f"{folder}/whole")


def from_lines(spark: SparkSession, sf_dir: str, folder: str,
               industry: bool = False) -> dict[str, DataFrame]:
    """The extracts made of order lines, for which these are joined and counted once; the counts are
    stored in `folder`. The columns of the fourth, `economics_industry`, are counted if asked for."""
    extracts = HOUSING, SCHOOL_ENROLLMENT, WORK
    kept = _counted_lines(spark, sf_dir, folder, *extracts, *([INDUSTRY] if industry else []))
    made = {"housing": _housing(kept), "school_enrollment": _school_enrollment(kept),
            "work": _work(kept)}
    return made | ({"economics_industry": _industry(kept)} if industry else {})


def zip_to_zcta5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZIP to area crosswalk; two ZIPs per area, some without one."""
    return load(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS ZIP_CODE",
        "c_mktsegment AS STATE",
        "CAST(CASE WHEN pmod(c_custkey, 50) <> 0 "
        "THEN c_custkey - pmod(c_custkey, 2) END AS INT) AS ZCTA",
    )


def public_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Museums and libraries, from events; unknown amounts are blanks."""
    value = "CASE WHEN event_type = '{}' THEN '{}' ELSE CAST(value AS STRING) END AS {}"
    return load(spark, sf_dir, "events").selectExpr(
        "event_id AS MID",
        "event_type AS DISCIPL",
        "concat('Resource ', event_id) AS COMMONNAME",
        "concat('Resource, the ', event_id) AS LEGALNAME",
        "concat('Street ', event_id) AS ADSTREET",
        "concat('Old Street ', event_id) AS GSTREET",
        "concat('City ', user_id) AS ADCITY",
        "upper(substr(event_type, 1, 2)) AS ADSTATE",
        "CAST(user_id AS INT) AS ADZIP5",
        "concat('555-', event_id) AS PHONE",
        "concat('www.', event_type, '.example/', event_id) AS WEBURL",
        value.format("error", " ", "INCOME15"),
        value.format("view", "   ", "REVENUE15"),
        value.format("click", " ", "LONGITUDE"),
        value.format("click", " ", "LATITUDE"),
    )


_SCHOOL_ROWS = {
    "private_school": "o_orderpriority = '1-URGENT'",
    "public_school": "o_orderpriority <> '1-URGENT'",
    "postsecondary_school": "o_orderpriority = '5-LOW'",
}

_SCHOOL_VALUES = {
    "key": "CAST(o_orderkey AS STRING)",
    "name": "concat('School ', o_orderkey)",
    "OPSTFIPS": "o_orderstatus",
    "STREET": "concat(o_orderkey, ' Main, ', o_orderpriority)",
    "CITY": "concat('City ', o_custkey)",
    "STATE": "o_orderstatus",
    "ZIP": "CASE WHEN pmod(o_orderkey, 50) = 0 THEN NULL "
    "WHEN pmod(o_orderkey, 3) = 0 THEN concat(lpad(CAST(o_custkey AS STRING), 5, '0'), '1234') "
    "ELSE lpad(CAST(o_custkey AS STRING), 5, '0') END",
    "LOCALE": "substr(o_orderpriority, 1, 1)",
    "LAT": "CAST(floor(o_totalprice) / 10000 AS STRING)",
    "LON": "concat('-', CAST(floor(o_totalprice) / 5000 AS STRING))",
    "SCHOOLYEAR": "'2017-2018'",
}


def schools(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """School locations, from orders, in the field order of the file; all text."""
    names = school_fields(table)
    values = (_SCHOOL_VALUES.get(s, "CAST(NULL AS STRING)") for s in ["key", "name", *names[2:]])
    rows = load(spark, sf_dir, "orders").where(_SCHOOL_ROWS[table])
    return rows.selectExpr(*(f"{v} AS {n}" for v, n in zip(values, names, strict=True)))


def current_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tutorial table: one row per student, with a course id."""
    return load(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS sid",
        "c_name AS sname",
        f"CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '{fv.COURSES[0]}' "
        f"WHEN 'BUILDING' THEN '{fv.COURSES[1]}' ELSE concat('CS', c_nationkey) END AS cno",
        "c_acctbal AS balance",
    )


def new_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tutorial table: one row per student who joined, with the day and whether fees are paid."""
    return load(spark, sf_dir, "customer").where("c_acctbal < 0").selectExpr(
        "CAST(c_custkey AS INT) AS sid",
        "c_name AS sname",
        "date_add(DATE '2018-01-01', CAST(pmod(c_custkey, 365) AS INT)) AS joined",
        "pmod(c_custkey, 2) = 0 AS paid",
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tutorial table: one row per class."""
    return load(spark, sf_dir, "part").selectExpr(
        "concat('CS', p_partkey) AS cno", "p_name AS cname", "p_size AS credits"
    )
