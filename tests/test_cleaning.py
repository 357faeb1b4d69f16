import datetime

import pytest
from pyspark.sql import functions as F

from casebook.functions import casts
from casebook.functions.cleaning import blank_to_null, leading_number, snake_case, table_name, upper_category
from casebook.functions.geo import flat_distance_m, usable
from casebook.functions.rates import per_thousand, percent, ratio_or_zero


@pytest.fixture(scope="module")
def apply(spark):
    """Values of one expression over a list of texts."""

    def run(values, expression, type_="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]

    return run


def test_header_names():
    names = ["Case Number", "X-Coordinate", "Zip.Code", "CHARGE 1 TYPE", "N Region.Key"]
    assert [snake_case(n) for n in names] == ["case_number", "x_coordinate", "zipcode", "charge_1_type", "n_regionkey"]


def test_table_names():
    assert table_name("Yearly-Trends 2.0") == "yearly_trends_2_0"
    assert table_name("crimes_join_arrests") == "crimes_join_arrests"


def test_blank_to_null(apply):
    values = [" a ", "N/A", "none", "   ", "NULL", "null", "NA", "#N/A ", "None", "NONE", "", None, "x\t", "Null"]
    expected = ["a", None, "none", None, None, None, None, None, None, None, None, None, "x\t", "Null"]
    assert apply(values, blank_to_null) == expected


def test_upper_category(apply):
    assert apply([" white ", None, "Black"], upper_category) == ["WHITE", None, "BLACK"]


def test_unreadable_numbers_are_null(apply):
    assert apply(["12", "abc", "12.7", "018", "00601", None, "99999999999"], casts.to_int) == [
        12, None, None, 18, 601, None, None,
    ]
    texts = ["+7", "-7", " 7 ", "\t7\n", "7-", "--7", "+", "", "７", "7e0", "0x7", "2147483647", "2147483648", "\x7f7", "1 2"]
    assert apply(texts, casts.to_int) == apply(texts, lambda c: c.try_cast("int"))
    texts = ["1.5", "-.5", "5.", "1e3", "1E-3", " 2 ", "inf", "-Infinity", "+inf", "x", "n.a.", "", "1d", "2F", "0x1p3", ".", "-", None]
    assert apply(texts, casts.to_double) == apply(texts, lambda c: c.try_cast("double"))
    assert str(apply([" NaN ", "nan"], casts.to_double)) == str(apply([" NaN ", "nan"], lambda c: c.try_cast("double")))
    assert apply(["41.5", "x", None, "NaN", "-1e3"], casts.to_double)[:3] == [41.5, None, None]


def test_timestamps_need_the_whole_pattern(apply):
    read = apply(
        ["01/05/2021 12:30:00 AM", "01/05/2021 12:30:00 PM", "1/5/2021 2:30:00 AM", "2021-01-05", None],
        lambda c: casts.to_timestamp(c).cast("string"),
    )
    assert read == ["2021-01-05 00:30:00", "2021-01-05 12:30:00", None, None, None]


def test_days(apply):
    assert apply(["02/29/2020", "02/30/2020", "2/9/2020", None], casts.to_day) == [
        datetime.date(2020, 2, 29), None, None, None,
    ]


def test_flags(apply):
    assert apply(["TRUE", "false", "", "yes", None, "True"], lambda c: casts.is_word(c, "true")) == [
        True, False, False, False, False, True,
    ]


def test_label_code(apply):
    assert apply(["Headquarters", "018", "x", None], lambda c: casts.label_code(c, "Headquarters", 0)) == [
        0, 18, None, None,
    ]


def test_feet_inches(apply):
    assert apply(["509", "603", "1002", "70", "5'9", "ab9", "", None], casts.feet_inches) == [
        69, 75, 122, 70, None, None, None, None,
    ]


def test_year_falls_back_to_the_date(spark):
    df = spark.sql("select cast(null as int) y, timestamp'2019-06-01 00:00:00' t union all select 2020, null")
    years = df.select(casts.year_or_from(F.col("y"), F.col("t"))).collect()
    assert sorted(r[0] for r in years) == [2019, 2020]


def test_leading_number(apply):
    assert apply(["043XX S EXAMPLE", "EXAMPLE RD", "7"], leading_number) == ["043", "", "7"]


def test_rates_of_nothing(spark):
    row = spark.range(1).select(
        percent(F.lit(1), F.lit(8)).alias("pct"),
        percent(F.lit(1), F.lit(0)).alias("pct0"),
        ratio_or_zero(F.lit(1), F.lit(3)).alias("ratio"),
        ratio_or_zero(F.lit(1), F.lit(0)).alias("ratio0"),
        per_thousand(F.lit(1), F.lit(3)).alias("per"),
        per_thousand(F.lit(1), F.lit(0)).alias("per0"),
    ).first()
    assert row.asDict() == {
        "pct": 12.5, "pct0": None, "ratio": 0.3333, "ratio0": 0.0, "per": 333.33, "per0": None,
    }


def test_usable_coordinates(apply):
    values = [41.5, 0.0, float("nan"), None, -87.0, -0.0, float("inf"), float("-inf")]
    assert apply(values, usable, "double") == [True, False, False, False, True, False, False, False]


def test_distance(spark):
    row = spark.range(1).select(
        flat_distance_m(F.lit(41.0), F.lit(-87.0), F.lit(42.0), F.lit(-87.0)).alias("north"),
        flat_distance_m(F.lit(60.0), F.lit(10.0), F.lit(60.0), F.lit(11.0)).alias("east"),
        flat_distance_m(F.lit(60.0), F.lit(10.0), F.lit(None).cast("double"), F.lit(11.0)).alias("none"),
    ).first()
    assert row.asDict() == {"north": 111000.0, "east": 55500.0, "none": None}
