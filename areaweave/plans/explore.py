"""Exploration reports over the staging extracts and previews of later tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave import fixed_values as fv
from areaweave.operators.ranking import sorted_rows, top_k


@dataclass(frozen=True)
class Ranking:
    """A renamed column list, ranked and cut.

    order: (column or expression, descending?) pairs; where: SQL condition.
    """

    source: str
    columns: Mapping[str, str]
    order: tuple[tuple[str, bool], ...]
    rows: int
    where: str | None = None
    name: bool = True
    distinct: bool = False


def _by_name(source: str, columns: Mapping[str, str], present: str | None = None,
             distinct: bool = False) -> Ranking:
    where = f"{present} IS NOT NULL" if present else None
    return Ranking(source, columns, (("NAME", False),), 20, where, distinct=distinct)


def _by_share(columns: Mapping[str, str], share: str, rows: int) -> Ranking:
    number = f"try_cast({share} AS DOUBLE)"
    return Ranking("housing", columns, ((number, True),), rows, f"{number} > 0")


_LARGEST = (("DP03_0003E", True),)
_TRAVEL = "try_cast(DP03_0025E AS DOUBLE)"

STAGING_RANKINGS = {
    "q01": Ranking("economics", fv.LABOR_FORCE_REPORT, (("DP03_0014E", True),), 10,
                   "DP03_0014E IS NOT NULL"),
    "q02": Ranking("economics_industry", fv.INDUSTRY_REPORT, _LARGEST, 10,
                   "DP03_0003E IS NOT NULL"),
    "q03": Ranking("economics", fv.COMMUTE_REPORT, _LARGEST, 10, "DP03_0003E IS NOT NULL"),
    "q04": Ranking("economics", {_TRAVEL: "Mean_Travel_Time_To_Work"}, ((_TRAVEL, False),), 10,
                   f"{_TRAVEL} IS NOT NULL", name=False),
    "q05": Ranking("economics", fv.INCOME_REPORT, _LARGEST, 10, "DP03_0003E IS NOT NULL"),
    # The percentage is text here and ranks as text.
    "q06": Ranking("housing", fv.OCCUPANCY_REPORT, (("DP04_0002PE", True),), 10,
                   "DP04_0001E IS NOT NULL"),
    "q07": _by_share(fv.UNIT_REPORT, "DP04_0015PE", 20),
    "q08": _by_share(fv.BUILT_REPORT, "DP04_0017PE", 10),
    "q09": _by_share(fv.VALUE_REPORT, "DP04_0088PE", 100),
    "q10": _by_name("school_enrollment", fv.ENROLLMENT, "S1401_C01_004E"),
    "q11": _by_name("school_enrollment", fv.PUBLIC_PRIVATE, "S1401_C03_008E"),
    "q12": _by_name("school_enrollment", fv.SEX_REPORT, "S1401_C03_011E"),
    "q13": _by_name("work", fv.WORK_STATS, "S2303_C01_031E"),
    "q14": _by_name("work", fv.HOURS, "S2303_C01_016E"),
    "q15": _by_name("work", fv.IDLE_REPORT, "S2303_C03_030E"),
}

MODELED_RANKINGS = {
    "q20": Ranking("Labor_Force_Stats", fv.LABOR_FORCE_REPORT,
                   (("DP03_0002PE", True), ("DP03_0014E", True)), 10, name=False),
    "q21": Ranking("Labor_In_Industry", fv.INDUSTRY_REPORT, (("NAME", True),), 10, name=False),
    "q22": Ranking("Commute", {**fv.COMMUTE_REPORT, "DP03_0025E": "Mean_Travel_Time_To_Work"},
                   (("DP03_0019PE", True), ("DP03_0020PE", True)), 10),
    "q23": Ranking("Income", fv.INCOME_REPORT, (("DP03_0052PE", True),), 10,
                   "DP03_0052PE < 90 AND DP03_0061PE < 70"),
    "q24": _by_name("Working_Hours_Per_Week", fv.HOURS, "S2303_C01_009E"),
    "q25": _by_name("Built_Year", fv.BUILT_REPORT, distinct=True),
    "q26": _by_name("PrivatePublic_School_Enrollment", fv.PUBLIC_PRIVATE, distinct=True),
}


def ranked(source: DataFrame, spec: Ranking) -> DataFrame:
    rows = source.where(spec.where) if spec.where else source
    shown = {"NAME": "NAME"} if spec.name else {}
    shown |= {label: code for code, label in spec.columns.items()}
    # Order columns may be hidden ones, except where repeats of the shown columns go first.
    keys = {} if spec.distinct else {f"__k{i}": text for i, (text, _) in enumerate(spec.order)}
    rows = rows.selectExpr(*(f"{text} AS {name}" for name, text in {**keys, **shown}.items()))
    if spec.distinct:
        rows = rows.distinct()
    order = [
        f"-{key}" if descending else key
        for key, (_, descending) in zip(keys or ["NAME"], spec.order, strict=True)
    ]
    return top_k(rows, spec.rows, *order, keep=list(shown))


def preview(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A look at a table: the first rows by key, of those that have one."""
    return top_k(df.where(f"{key} IS NOT NULL"), rows, key)


def schools_with_zip(staging: DataFrame) -> DataFrame:
    return sorted_rows(staging.where("ZIP IS NOT NULL"), "STATE")


def crosswalk_with_area(staging: DataFrame) -> DataFrame:
    return staging.where("ZCTA IS NOT NULL")


def resources_with_income(staging: DataFrame, rows: int = 10) -> DataFrame:
    earning = staging.where("try_cast(INCOME15 AS DOUBLE) > 0")
    return top_k(
        earning.select(*"DISCIPL COMMONNAME ADSTATE ADCITY ADZIP5 INCOME15 REVENUE15".split()), rows
    )


def resource_streets(staging: DataFrame, rows: int = 10) -> DataFrame:
    return top_k(staging.select("GSTREET", "ADSTREET"), rows)


def row_count(df: DataFrame, label: str = "row_count") -> DataFrame:
    return df.agg(F.expr(f"count(*) AS {label}"))


def students_in(students: DataFrame, courses: list[str]) -> DataFrame:
    return row_count(students.where(F.col("cno").isin(courses)))
