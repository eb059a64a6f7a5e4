"""The published views, kept in the catalog.

A view is SQL over stored tables and is planned anew at each read, so it shows what was last
published under their names. Views come without the order their published forms end in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from areaweave import fixed_values as fv
from areaweave.functions.totals import steady_avg, steady_sum
from areaweave.sources.published import quoted
from areaweave.sources.tables import create_namespace, store_view

_RANKS = ", ".join(fv.TOP_INDUSTRIES)
_NAMED = " AND ".join(f"{rank} <> ''" for rank in fv.TOP_INDUSTRIES)
_PRICED = "High_Housing_Value <> 0 AND Middle_Housing_Value <> 0 AND Low_Housing_Value <> 0"


@dataclass(frozen=True)
class View:
    """`query` names each table of `reads` (a row job) in braces."""

    reads: tuple[str, ...]
    query: str


def _totals(columns: Iterable[str], how: str = "sum({0})") -> str:
    return ", ".join(f"{how.format(c)} AS Total_{c}" for c in columns)


VIEWS = {
    "v_Industry_With_Higher_Income": View(("income", "industry"), f"""
        SELECT i.ZCTA5, {", ".join(f"{steady_sum(c)} AS Total_{c}" for c in
                                   ("Rich", "Upper_Middle", "Middle"))},
            {steady_avg("Average")} AS Average, {_RANKS}
        FROM {{income}} i JOIN {{industry}} l ON i.ZCTA5 = l.ZCTA5
        WHERE Predominant_Class IN ('Rich', 'Upper_Middle', 'Middle') AND {_NAMED}
        GROUP BY i.ZCTA5, {_RANKS}"""),
    "v_Income_Class_With_School_Enrollment": View(("income", "pubpriv"), f"""
        SELECT Predominant_Class AS Predominant_Income_Class,
            {_totals(fv.PUBLIC_PRIVATE.values())}
        FROM {{income}} i JOIN {{pubpriv}} s ON i.ZCTA5 = s.ZCTA5 GROUP BY Predominant_Class"""),
    "v_Working_Situtation_In_Different_Industry": View(("hours", "commute", "industry"), f"""
        SELECT {steady_sum("Work_From_Home")} AS Total_Work_From_Home,
            sum(Work_35h_or_more) AS Total_Full_Work_Week, {_RANKS}
        FROM {{hours}} h JOIN {{commute}} c ON c.ZCTA5 = h.ZCTA5
            JOIN {{industry}} l ON l.ZCTA5 = h.ZCTA5
        WHERE {_NAMED} GROUP BY {_RANKS} HAVING sum(Work_35h_or_more) > 0"""),
    "v_Housing_Value_and_Unit_Status": View(("housing_value", "housing_status"), f"""
        SELECT s.ZCTA5, Low_Housing_Value, Middle_Housing_Value, High_Housing_Value,
            Total_Housing_Units
        FROM {{housing_value}} h JOIN {{housing_status}} s ON s.ZCTA5 = h.ZCTA5 WHERE {_PRICED}"""),
    "v_Income_Housing_Value": View(("income", "housing_value"), f"""
        SELECT Predominant_Class, Low_Housing_Value, Middle_Housing_Value, High_Housing_Value
        FROM {{income}} i JOIN {{housing_value}} h ON i.ZCTA5 = h.ZCTA5 WHERE {_PRICED}"""),
    "v_School_Enrollment_Average": View(("enrollment",), """
        SELECT ZCTA5 AS ZCTA5_higher_than_average_schoolenrollment, College_Undergrad,
            Grad_HigherEdu
        FROM {enrollment} WHERE College_Undergrad > (SELECT avg(College_Undergrad) FROM {enrollment})
            AND Grad_HigherEdu > (SELECT avg(Grad_HigherEdu) FROM {enrollment})"""),
    "v_Industry_School_Enrollment_Average": View(("industry", "enrollment"), """
        SELECT Predominant_Industry_First, count(Predominant_Industry_First) AS Area_with_Industry
        FROM {industry} l JOIN {enrollment} s ON l.ZCTA5 = s.ZCTA5
        WHERE Grad_HigherEdu > (SELECT avg(Grad_HigherEdu) FROM {enrollment})
            AND Predominant_Industry_First IS NOT NULL
        GROUP BY Predominant_Industry_First"""),
    # Both sides are counted before they meet; see crossing.resources_and_income.
    "v_Public_Resources_with_Income": View(("income", "zipmap", "resources"), """
        SELECT a.ZIPCODE, average_income,
            pairs * coalesce(places, 1) AS num_of_public_resources,
            pairs * coalesce(found, 0) AS num_of_resources_found
        FROM (SELECT m.ZIPCODE, Average AS average_income, count(m.ZIPCODE) AS pairs
              FROM {income} i LEFT JOIN {zipmap} m ON i.ZCTA5 = m.ZCTA5
              GROUP BY m.ZIPCODE, Average) a
        LEFT JOIN (SELECT ZIPCODE, count(*) AS places, count(MID) AS found FROM {resources}
                   WHERE ZIPCODE IS NOT NULL GROUP BY ZIPCODE) p ON a.ZIPCODE = p.ZIPCODE"""),
    "v_School_with_Income_Class": View(
        ("income", "zipmap", "private_school", "public_school"), """
        SELECT i.ZCTA5, Predominant_Class, number_of_private_schools, number_of_public_schools
        FROM {income} i JOIN {zipmap} z ON i.ZCTA5 = z.ZCTA5
        JOIN (SELECT ZIPCODE, count(*) AS number_of_private_schools FROM {private_school}
              GROUP BY ZIPCODE) pri ON z.ZIPCODE = pri.ZIPCODE
        JOIN (SELECT ZIPCODE, count(*) AS number_of_public_schools FROM {public_school}
              GROUP BY ZIPCODE) pub ON z.ZIPCODE = pub.ZIPCODE"""),
    "v_Postsecondary_vs_PublicPrivate_enrollment": View(("pubpriv", "zipmap", "postsecondary"), """
        SELECT s.ZCTA5, College_Undergrad_Public + Grad_HigherEdu_Public AS Public_enrollment,
            College_Undergrad_Private + Grad_HigherEdu_Private AS Private_enrollment,
            total_number_of_schools
        FROM {pubpriv} s JOIN {zipmap} z ON s.ZCTA5 = z.ZCTA5
        JOIN (SELECT ZIPCODE, count(*) AS total_number_of_schools FROM {postsecondary}
              GROUP BY ZIPCODE) p ON z.ZIPCODE = p.ZIPCODE"""),
}


def create_views(spark: SparkSession, namespace: str, tables: Mapping[str, str],
                 names: Iterable[str] = tuple(VIEWS)) -> list[str]:
    """Keep views in `namespace` (made if missing) over stored tables; `tables`: row job -> name
    of the table its result is stored under. Returns the views' full names."""
    create_namespace(spark, namespace)
    made = []
    for name in names:
        view = VIEWS[name]
        query = view.query.format(**{job: quoted(spark, tables[job]) for job in view.reads})
        store_view(spark, f"`{namespace}`.`{name}`", query)
        made.append(f"{namespace}.{name}")
    return made
