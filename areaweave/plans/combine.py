"""Reports that join and aggregate area tables.

`full_*` reports read modelled tables keyed by NAME, the others transformed tables keyed
by ZCTA5. Reports that are also published as views come unlimited; `top` adds the cut.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave import fixed_values as fv
from areaweave.functions.totals import steady_avg, steady_sum
from areaweave.operators.joins import outer_chain, outer_join, with_parent
from areaweave.operators.ranking import sorted_rows, top_k

CLASSES_ABOVE = ["Rich", "Upper_Middle", "Middle"]
INDUSTRIES = fv.TOP_INDUSTRIES


def labelled(df: DataFrame, labels: Mapping[str, str], key: str) -> DataFrame:
    """Columns under report labels, the area key under `key` (one per joined table)."""
    return df.selectExpr(f"NAME AS {key}", *(f"{c} AS {v}" for c, v in labels.items()))


def full_pair(first: DataFrame, second: DataFrame, shown: str) -> DataFrame:
    """Full outer join of two labelled tables with keys k1, k2; one key shown as NAME."""
    joined = outer_join(first, second, "k1", "k2", "full")
    return joined.withColumnRenamed(shown, "NAME").drop("k1", "k2")


def full_chain(first: DataFrame, middle: DataFrame, last: DataFrame) -> DataFrame:
    """Full outer chain: the third table is matched on the middle table's key only, so an
    area missing there comes as two rows. NAME is the first table's key and may be NULL."""
    joined = outer_chain([(first, "k1"), (middle, "k2"), (last, "k3")], "full")
    return joined.withColumnRenamed("k1", "NAME").drop("k2", "k3")


def first_by_name(df: DataFrame, rows: int = 20) -> DataFrame:
    return top_k(df, rows, "NAME")


def labor_income_value(labor: DataFrame, income: DataFrame, value: DataFrame) -> DataFrame:
    return full_chain(
        labelled(labor, {"DP03_0002PE": "Labor_Force"}, "k1"),
        labelled(income, {"DP03_0057PE": "Income_50K_74K"}, "k2"),
        labelled(value, {"DP04_0085PE": "House_value_200K_299K"}, "k3"),
    )


def income_units_labor(income: DataFrame, unit: DataFrame, labor: DataFrame) -> DataFrame:
    return full_chain(
        labelled(income, {"DP03_0054PE": "Income_15K_24K", "DP03_0059PE": "Income_100K_149K"}, "k1"),
        labelled(unit, {"DP04_0014PE": "Mobile_Home", "DP04_0015PE": "RV_Boat"}, "k2"),
        labelled(labor, {"DP03_0002PE": "Labor_Force"}, "k3"),
    )


OFFICE_INDUSTRIES = {
    "DP03_0039E": "Information",
    "DP03_0040E": "Finance_Real_Estate",
    "DP03_0041E": "Prof_Sci_Man",
    "DP03_0042E": "Educational_Health_Care",
    "DP03_0043E": "Art_Entertainment",
}


def industry_value(industry: DataFrame, value: DataFrame) -> DataFrame:
    return full_pair(
        labelled(industry, OFFICE_INDUSTRIES, "k1"),
        labelled(value, {"DP04_0088PE": "Housing_Value_1M_Or_More"}, "k2"),
        "k1",
    )


def income_school_industry(income: DataFrame, school: DataFrame, industry: DataFrame) -> DataFrame:
    high = {"DP03_0059PE": "Income_100K_149K", "DP03_0060PE": "Income_150K_199K"}
    college = {"S1401_C01_008E": "College_Undergrad", "S1401_C01_009E": "Grad_HigherEd"}
    office = {
        **OFFICE_INDUSTRIES,
        "DP03_0041E": "Professional_Scientific_Management",
        "DP03_0045E": "Public_Administration",
    }
    return full_chain(
        labelled(income, high, "k1"), labelled(school, college, "k2"), labelled(industry, office, "k3")
    )


def income_value_weeks(income: DataFrame, value: DataFrame, weeks: DataFrame) -> DataFrame:
    high = {code: fv.INCOME_REPORT[code] for code in list(fv.INCOME)[6:]}
    costly = {
        "DP04_0086PE": "Housing_Value_400K_499K",
        "DP04_0087PE": "Housing_Value_500K_999K",
        "DP04_0088PE": "Housing_Value_1M_Or_More",
    }
    worked = {**fv.WEEKS, "S2303_C01_008E": "No_working_Yearly"}
    return full_chain(
        labelled(income, high, "k1"), labelled(value, costly, "k2"), labelled(weeks, worked, "k3")
    )


def income_next_to(other: DataFrame, labels: Mapping[str, str], income: DataFrame) -> DataFrame:
    """Income brackets next to columns of another table, areas in both (inner join)."""
    a = labelled(income, fv.INCOME_REPORT, "NAME")
    return a.join(labelled(other, labels, "NAME"), "NAME")


# --- transformed tables -------------------------------------------------------


def nonzero(*columns: str) -> str:
    return " AND ".join(f"{c} <> 0" for c in columns)


ALL_VALUES = ["High_Housing_Value", "Middle_Housing_Value", "Low_Housing_Value"]


def priced(value: DataFrame) -> DataFrame:
    """Areas with houses of every price class."""
    return value.where(nonzero(*ALL_VALUES))


def class_and_college(income: DataFrame, pubpriv: DataFrame) -> DataFrame:
    attended = pubpriv.where(nonzero("College_Undergrad_Public", "College_Undergrad_Private"))
    return income.join(attended, "ZCTA5").select(
        "ZCTA5", "Predominant_Class", "College_Undergrad_Public", "College_Undergrad_Private"
    )


def value_and_units(value: DataFrame, status: DataFrame) -> DataFrame:
    return priced(value).join(status, "ZCTA5").select(
        "ZCTA5", "Low_Housing_Value", "Middle_Housing_Value", "High_Housing_Value",
        "Total_Housing_Units",
    )


def new_and_costly(built: DataFrame, value: DataFrame, above: float = 50) -> DataFrame:
    """Areas per share of costly houses. Built_2014_or_later has no NULL left, so its
    count is the number of areas. The share is filtered before the join."""
    costly = priced(value).where(f"High_Housing_Value > {above}")
    return (
        built.join(costly, "ZCTA5")
        .groupBy("High_Housing_Value")
        .agg(
            F.expr(f"{steady_avg('High_Housing_Value')} AS Average_High_Housing_Value"),
            F.count("Built_2014_or_later").alias("num_of_highvalue_built2014_or_later"),
        )
    )


def class_and_value(income: DataFrame, value: DataFrame) -> DataFrame:
    return income.join(priced(value), "ZCTA5").select(
        "Predominant_Class", "Low_Housing_Value", "Middle_Housing_Value", "High_Housing_Value"
    )


def named_industries() -> str:
    """All three ranks filled (a missing rank is NULL, which this drops too)."""
    return " AND ".join(f"{c} <> ''" for c in INDUSTRIES)


def industry_of_higher_income(income: DataFrame, industry: DataFrame) -> DataFrame:
    """Class totals and income index by leading industries.

    The filters on class and industry are applied before the join and the grouping.
    """
    upper = income.where(F.col("Predominant_Class").isin(CLASSES_ABOVE))
    return (
        upper.join(industry.where(named_industries()), "ZCTA5")
        .groupBy(*INDUSTRIES)
        .agg(
            *(F.expr(f"{steady_sum(c)} AS Total_{c}") for c in CLASSES_ABOVE),
            F.expr(f"{steady_avg('Average')} AS Average"),
        )
    )


def working_time_and_income(hours: DataFrame, weeks: DataFrame, income: DataFrame) -> DataFrame:
    """Hours with weeks and income where known; asking for a nonzero index makes the last
    join an inner one, which Catalyst then plans."""
    h = hours.selectExpr("ZCTA5 AS k1", "Work_35h_or_more", "No_working AS no_working_weekly")
    w = weeks.selectExpr("ZCTA5 AS k2", "Work_50_to_52_weeks", "No_working AS no_working_yearly")
    i = income.selectExpr("ZCTA5 AS k3", "Average")
    joined = outer_chain([(h, "k1"), (w, "k2"), (i, "k3")], "left")
    return joined.where("Average <> 0").select(
        "Work_50_to_52_weeks", "no_working_yearly", "Work_35h_or_more", "no_working_weekly",
        "Average",
    )


def work_by_industry(hours: DataFrame, commute: DataFrame, industry: DataFrame) -> DataFrame:
    """Home workers and full weeks by leading industries."""
    return (
        hours.join(commute, "ZCTA5")
        .join(industry, "ZCTA5")
        .groupBy(*INDUSTRIES)
        .agg(
            F.expr(f"{steady_sum('Work_From_Home')} AS Total_Work_From_Home"),
            F.sum("Work_35h_or_more").alias("Total_Full_Work_Week"),
        )
        .where("Total_Full_Work_Week > 0")
    )


def enrollment_by_class(income: DataFrame, pubpriv: DataFrame) -> DataFrame:
    totals = (F.sum(c).alias(f"Total_{c}") for c in fv.PUBLIC_PRIVATE.values())
    return (
        income.join(pubpriv, "ZCTA5")
        .groupBy(F.col("Predominant_Class").alias("Predominant_Income_Class"))
        .agg(*totals)
    )


def above_average(df: DataFrame, *columns: str) -> DataFrame:
    """Rows above the whole table's average in every column. The averages are scalar
    subqueries, which Catalyst merges into one aggregate."""
    above = df
    for name in columns:
        above = above.where(F.col(name) > df.agg(F.avg(name)).scalar())
    return above


def areas_above_average(enrollment: DataFrame) -> DataFrame:
    return above_average(enrollment, "College_Undergrad", "Grad_HigherEdu").selectExpr(
        "ZCTA5 AS ZCTA5_higher_than_average_schoolenrollment",
        "College_Undergrad",
        "Grad_HigherEdu",
    )


def industry_of_graduates(industry: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Areas per leading industry, of those with more graduate students than average."""
    studious = above_average(enrollment, "Grad_HigherEdu").select("ZCTA5")
    return (
        industry.where("Predominant_Industry_First IS NOT NULL")
        .join(studious, "ZCTA5")
        .groupBy("Predominant_Industry_First")
        .agg(F.count("Predominant_Industry_First").alias("Area_with_Industry"))
    )


def industry_of_costly_areas(industry: DataFrame, income: DataFrame, value: DataFrame) -> DataFrame:
    """Areas per leading industry, of well-off areas with costly houses."""
    well_off = income.where(F.col("Predominant_Class").isin("Rich", "Upper_Middle"))
    costly = value.where("High_Housing_Value > 0")
    chosen = well_off.select("ZCTA5").join(costly.select("ZCTA5"), "ZCTA5")
    return (
        with_parent(industry, chosen, "ZCTA5")
        .groupBy("Predominant_Industry_First")
        .agg(F.count("*").alias("Number_of_Area"))
    )


def value_of_rich_areas(value: DataFrame, income: DataFrame) -> DataFrame:
    rich = income.where("Predominant_Class = 'Rich'")
    return with_parent(value, rich, "ZCTA5").select(*ALL_VALUES)


def areas_per_class(income: DataFrame, value: DataFrame) -> DataFrame:
    return (
        income.join(priced(value), "ZCTA5")
        .groupBy("Predominant_Class")
        .agg(F.count("Predominant_Class").alias("Count_of_class"))
    )


def built_and_value(built: DataFrame, value: DataFrame) -> DataFrame:
    """Every column of the first table and one of the second."""
    b, h = built.alias("b"), priced(value).alias("h")
    return b.join(h, F.col("b.ZCTA5") == F.col("h.ZCTA5")).select("b.*", "High_Housing_Value")


def best(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """Largest first."""
    return top_k(df, rows, *(f"-{c}" for c in columns))


def in_order(df: DataFrame, column: str) -> DataFrame:
    return sorted_rows(df, f"-{column}")
