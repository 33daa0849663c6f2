import datetime

import pytest
from pyspark.sql import functions as F

from tarnwork.functions import scalars
from tarnwork.plans import retail


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items()) or "x int"
    row = tuple(v for v, _ in values.values()) or (None,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "email, masked",
    [
        ("alice.j@example.com", "a*****j@example.com"),
        ("ab@x", "ab@x"),
        ("a@x", "aa@x"),
        ("abc@d@e", "a*c@d@e"),
        ("nobody", None),
        ("@x", None),
        ("", None),
        (None, None),
        ("山田太郎@x", "山**郎@x"),
    ],
)
def test_mask_email(spark, email, masked):
    assert one(spark, scalars.mask_email("e"), e=(email, "string")) == masked


@pytest.mark.parametrize("age, group", [(34, "若年層"), (35, "中年層"), (54, "中年層"), (55, "シニア層"), (None, "シニア層")])
def test_age_bucket(spark, age, group):
    assert one(spark, scalars.age_bucket("a"), a=(age, "int")) == group


@pytest.mark.parametrize("text, flag", [("○", True), ("x", False), ("", False), (None, False)])
def test_flag(spark, text, flag):
    assert one(spark, scalars.flag_from_marker("t"), t=(text, "string")) is flag


@pytest.mark.parametrize("text, number", [("29.85", 29.85), ("null", None), ("", None), ("12a", None), (None, None), (" 7 ", 7.0)])
def test_to_number(spark, text, number):
    assert one(spark, scalars.to_number("t"), t=(text, "string")) == number


def test_map_label(spark):
    column = scalars.map_label("t", {"Yes": 1, "No": 0})
    assert [one(spark, column, t=(v, "string")) for v in ("Yes", "No", "Maybe", None)] == [1, 0, None, None]


def test_ratio_and_digits(spark):
    assert one(spark, scalars.ratio_safe("a", "b"), a=(1.0, "double"), b=(0.0, "double")) is None
    assert one(spark, scalars.group_digits("a"), a=(1234567.6, "double")) == "1,234,568"
    assert one(spark, scalars.equals_value("r"), r=(None, "string")) is False


def test_lead_days(spark):
    column = scalars.days_between("a", "b")
    assert one(spark, column, a=("2024-02-28", "string"), b=("2024-03-01", "string")) == 2


@pytest.mark.parametrize("start, end", [(None, None), ("", "")])
def test_period_defaults(spark, start, end):
    first, last = retail.period(start, end, F.lit("2024-03-01").cast("date"))
    assert one(spark, first) == datetime.date(2022, 3, 2)
    assert one(spark, last) == datetime.date(2024, 3, 1)


def test_period_given(spark):
    first, last = retail.period("2016-01-01", "2020-12-31")
    assert (one(spark, first), one(spark, last)) == (datetime.date(2016, 1, 1), datetime.date(2020, 12, 31))


@pytest.mark.parametrize(
    "sales, profit, returns, lead, tag",
    [
        (100.0, 20.0, 0.04, 3.0, "優秀"),
        (100.0, 20.0, 0.05, 3.0, "標準"),
        (100.0, 20.0, 0.04, 3.1, "標準"),
        (100.0, 4.9, 0.0, 1.0, "要改善"),
        (100.0, 30.0, 0.11, 1.0, "要改善"),
        (0.0, 30.0, 0.0, 1.0, "標準"),
        (0.0, 30.0, 0.2, 1.0, "要改善"),
    ],
)
def test_performance_tag(spark, sales, profit, returns, lead, tag):
    ddl = "total_sales_amount double, total_profit double, return_rate double, avg_lead_time_days double, total_budget double"
    totals = spark.createDataFrame([(sales, profit, returns, lead, 0.0)], ddl)
    row = retail.with_scores(totals).first()
    assert row["performance_tag"] == tag
    assert row["budget_achievement"] is None
    assert (row["profit_margin"] is None) == (sales == 0)
