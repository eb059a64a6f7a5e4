"""Reports across datasets: areas are tied to ZIP-level places through the crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.operators.joins import left_join_unique, split_left_join
from areaweave.operators.key_stats import SLOT_ROWS


def resources_and_income(income: DataFrame, crosswalk: DataFrame, resources: DataFrame,
                         areas: DataFrame | None = None) -> DataFrame:
    """Museums and libraries per ZIP next to the income index of its area.

    `num_of_public_resources` counts the merged ZIPCODE of the joined rows, so a ZIP
    without any resource scores 1; `num_of_resources_found` counts the resources
    themselves. Areas without a ZIP form groups with a NULL ZIPCODE and score 0.

    Both sides are counted before they meet, so no joined row is ever built: a ZIP with a
    large part of all resources arrives as one number. `areas`: the crosswalk's statistics
    of ZCTA5, if stored.
    """
    per_zip = resources.where(F.col("ZIPCODE").isNotNull()).groupBy("ZIPCODE").agg(
        F.count("*").alias("rows"), F.count("MID").alias("found")
    )
    counted = (
        split_left_join(income.select("ZCTA5", "Average"), crosswalk.select("ZCTA5", "ZIPCODE"),
                        "ZCTA5", areas, ["ZIPCODE"])
        .groupBy("ZIPCODE", F.col("Average").alias("average_income"))
        .agg(F.count("ZIPCODE").alias("pairs"))
    )
    return left_join_unique(counted, per_zip, "ZIPCODE").select(
        "ZIPCODE",
        "average_income",
        (F.col("pairs") * F.coalesce("rows", F.lit(1))).alias("num_of_public_resources"),
        (F.col("pairs") * F.coalesce("found", F.lit(0))).alias("num_of_resources_found"),
    )


def _per_zip(places: DataFrame, label: str) -> DataFrame:
    return places.groupBy("ZIPCODE").agg(F.count("*").alias(label))


def schools_and_class(income: DataFrame, crosswalk: DataFrame, private: DataFrame,
                      public: DataFrame) -> DataFrame:
    """Private and public schools of ZIPs that have both, with the area's class."""
    both = _per_zip(private, "number_of_private_schools").join(
        _per_zip(public, "number_of_public_schools"), "ZIPCODE"
    )
    return (
        crosswalk.join(both, "ZIPCODE")
        .join(income, "ZCTA5")
        .select("ZCTA5", "Predominant_Class", "number_of_private_schools",
                "number_of_public_schools")
    )


def colleges_and_enrollment(pubpriv: DataFrame, crosswalk: DataFrame, colleges: DataFrame) -> DataFrame:
    """Postsecondary schools per ZIP with the public and private enrollment of its area."""
    return (
        crosswalk.join(_per_zip(colleges, "total_number_of_schools"), "ZIPCODE")
        .join(pubpriv, "ZCTA5")
        .select(
            "ZCTA5",
            (F.col("College_Undergrad_Public") + F.col("Grad_HigherEdu_Public")).alias(
                "Public_enrollment"
            ),
            (F.col("College_Undergrad_Private") + F.col("Grad_HigherEdu_Private")).alias(
                "Private_enrollment"
            ),
            "total_number_of_schools",
        )
    )


def area_resource_listing(income: DataFrame, crosswalk: DataFrame, resources: DataFrame,
                          areas: DataFrame | None = None, zips: DataFrame | None = None,
                          slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Every area with its ZIPs and their resources, keys merged, nothing dropped.

    Rows of frequent keys of both right sides are dealt out over several tasks, by the
    statistics stored with the crosswalk (`areas`, of ZCTA5) and the resources (`zips`, of ZIPCODE).
    """
    listed = split_left_join(income, crosswalk, "ZCTA5", areas, ["ZIPCODE"], slot_rows)
    return split_left_join(listed, resources, "ZIPCODE", zips, ["MID"], slot_rows)
