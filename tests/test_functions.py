"""Hand-made rows for each cleaning and classification rule."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from areaweave import fixed_values as fv
from areaweave.functions import classes, cleaning, totals
from areaweave.plans.row_jobs import ROW_JOBS, income_classes, top_industries, transform, value_classes


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, c STRING")


def apply(spark, expression, *values):
    rows = texts(spark, *values).selectExpr("i", f"{expression} AS out").orderBy("i").collect()
    return [r.out for r in rows]


def test_marker_is_zero_and_eats_minus(spark):
    assert apply(spark, cleaning.marked_to_double("c"), "-", "12.5", "-5.2", None) == [
        0.0, 12.5, 5.2, None,
    ]


def test_marker_chain(spark):
    got = apply(spark, cleaning.text_measure_to_double("c"), "N", "-", "31.4", None)
    assert got == [0.0, 0.0, 31.4, None]


def test_blank(spark):
    assert apply(spark, cleaning.blank_to_double("c"), " ", "   ", "12") == [0.0, 0.0, 12.0]


def test_strict_and_safe_cast(spark):
    with pytest.raises(PySparkException):
        apply(spark, cleaning.marked_to_double("c"), "250,000+")
    assert apply(spark, "try_cast(c AS DOUBLE)", "250,000+", "7") == [None, 7.0]


def test_area_code(spark):
    assert apply(spark, cleaning.area_code("c"), "ZCTA5 00716", None) == ["00716", None]


def test_pad_code(spark):
    got = apply(spark, cleaning.pad_code("c"), "716", "00716", "123456", None)
    assert got == ["00716", "00716", "123456", None]


def test_five_digit_zip(spark):
    got = apply(spark, cleaning.five_digit_zip("c"), "787051234", "78705-1234", "78705", "787", None)
    assert got == ["78705", "78705", "78705", "787", None]


def test_or_zero(spark):
    assert apply(spark, cleaning.or_zero("c", "bigint"), "4", None) == [4, 0]


def income_row(spark, **values):
    full = {label: 0.0 for label in fv.INCOME.values()} | values
    return spark.createDataFrame([tuple(full.values())], ", ".join(f"{c} DOUBLE" for c in full))


def test_class_tie_goes_to_the_first(spark):
    row = income_classes(income_row(spark, Income_Less_10k=40.0, Income_50k_74k=40.0)).first()
    assert (row.Lowest, row.Middle, row.Predominant_Class) == (40.0, 40.0, "Lowest")


def test_empty_area_is_lowest_with_index_zero(spark):
    source = spark.createDataFrame(
        [("ZCTA5 00001", *[None] * 10)],
        "NAME STRING, " + ", ".join(f"{c} DOUBLE" for c in fv.INCOME),
    )
    row = transform(source, ROW_JOBS["income"]).first()
    assert (row.ZCTA5, row.Predominant_Class, row.Average) == ("00001", "Lowest", 0.0)


@pytest.mark.parametrize(
    ("bracket", "index"), [("Income_200k_More", 100.0), ("Income_Less_10k", 2.0)]
)
def test_income_index_ends(spark, bracket, index):
    assert income_classes(income_row(spark, **{bracket: 100.0})).first().Average == index


def test_class_sums_cover_all_brackets(spark):
    values = {label: float(2**i) for i, label in enumerate(fv.INCOME.values())}
    row = income_classes(income_row(spark, **values)).first()
    assert sum(row[c] for c in fv.INCOME_CLASSES) == sum(values.values())
    assert row.Rich == 512.0 and row.Lowest == 7.0
    with pytest.raises(ValueError):
        classes.class_sums(["a", "b"], {"x": 1})


def test_value_classes(spark):
    labels = list(fv.HOUSING_VALUE.values())
    df = spark.createDataFrame([tuple(float(i) for i in range(8))],
                               ", ".join(f"{c} DOUBLE" for c in labels))
    row = value_classes(df).first()
    assert [row[c] for c in fv.VALUE_CLASSES] == [6.0, 9.0, 13.0]


def industries(spark, *rows):
    labels = list(fv.INDUSTRY.values())
    data = [tuple(float(row.get(c, 0)) for c in labels) for row in rows]
    return top_industries(spark.createDataFrame(data, ", ".join(f"{c} DOUBLE" for c in labels)))


def test_industry_tie_goes_to_the_last_and_zero_is_no_industry(spark):
    row = industries(spark, {"Retail": 9, "Information": 9}).first()
    assert [row[c] for c in fv.TOP_INDUSTRIES] == ["Information", "Retail", None]


def test_no_industry_at_all(spark):
    assert [industries(spark, {}).first()[c] for c in fv.TOP_INDUSTRIES] == [None] * 3


def test_top_values_do_not_increase(spark):
    rows = [{c: (i * 7 + j * 5) % 11 for j, c in enumerate(fv.INDUSTRY.values())} for i in range(40)]
    for row in industries(spark, *rows).collect():
        top = [row[row[c]] for c in fv.TOP_INDUSTRIES if row[c]]
        assert top == sorted(top, reverse=True)
        assert top[0] == max(row[c] for c in fv.INDUSTRY.values())


def test_filter_on_ranks_does_not_copy_the_sort(spark):
    df = industries(spark, {"Retail": 3}).where(" AND ".join(f"{c} <> ''" for c in fv.TOP_INDUSTRIES))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1


def test_totals_are_not_cut(spark):
    rows = [("small", 1e-7), ("small", 3e-7), ("large", 1e13), ("large", 3e13), ("few", 0.1),
            ("few", 0.2), ("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: (r.s, r.m) for r in df.groupBy("g").agg(
        F.expr(f"{totals.steady_sum('x')} AS s"), F.expr(f"{totals.steady_avg('x')} AS m")
    ).collect()}
    assert got["small"] == (1e-7 + 3e-7, (1e-7 + 3e-7) / 2)
    assert got["large"] == (4e13, 2e13)
    assert got["few"] == (0.3, 0.15)
    assert got["none"][0] is None
