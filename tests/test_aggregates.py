import random

import numpy as np
import pytest
from conftest import day
from pyspark.sql import functions as F

from tarnwork.operators import aggregates
from tarnwork.plans import retail


def test_monthly_weather(spark, rows):
    weather = [("2024-01-30", 5.0, 9.5, 1.0), ("2024-01-31", 6.01, 12.0, -2.5), ("2024-02-01", None, 8.0, 3.0)]
    df = spark.createDataFrame([(day(d), *t) for d, *t in weather], "date date, ave double, high double, low double")
    gold = aggregates.monthly_rollup(
        df,
        "date",
        {"avg": F.round(F.avg("ave"), 2), "max": F.round(F.max("high"), 2), "min": F.round(F.min("low"), 2)},
    )
    assert [tuple(r) for r in gold.collect()] == [("2024-01", 5.51, 12.0, -2.5), ("2024-02", None, 8.0, 3.0)]


def test_percent(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)], "k string")
    assert [tuple(map(str, r)) for r in aggregates.percent_of_total(df, "k").collect()] == [("a", "2", "66.7"), ("b", "1", "33.3")]


def test_category_quantities_do_not_fan_out(spark, rows):
    users = spark.createDataFrame([(1, 20), (2, 60)], "user_id int, age int")
    lines = spark.createDataFrame(
        [(1, 2, "食料品"), (1, 3, "食料品"), (1, 4, "日用品"), (1, 5, "家具"), (1, 9, None), (1, None, "家具")],
        "user_id int, quantity int, category string",
    )
    assert rows(aggregates.category_quantities(users, lines)) == [(1, 20, 5, 4, 5), (2, 60, 0, 0, 0)]


def test_unknown_age_is_a_senior_and_unknown_groups_stay(spark, rows):
    df = spark.createDataFrame(
        [(None, None, None, None, 5.0), (30, "F", "x", "s", 7.0)],
        "age int, gender string, region string, subcategory string, transaction_price double",
    )
    assert rows(retail.revenue_by_user_segment(df)) == [("シニア層", None, None, 5.0), ("若年層", "F", "x", 7.0)]
    assert rows(retail.revenue_by_subcategory(df)) == [(None, 5.0), ("s", 7.0)]


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a")], "n int, s string")
    for exact in (False, True):
        stats = {r["column_name"]: tuple(r)[1:] for r in aggregates.column_stats(df, exact=exact).collect()}
        assert stats == {"n": (3, 0, 2, "1", "2"), "s": (3, 1, 2, "a", "b")}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n, slices", [(0, 4), (1, 4), (7, 256), (1000, 16)])
def test_running_total(spark, n, slices, descending):
    values = [(x, random.Random(x).randint(0, 9)) for x in random.Random(1).sample(range(-500, n * 3 + 10), n)]
    df = spark.createDataFrame([(float(x) / 7, v) for x, v in values], "x double, v int")
    found = aggregates.running_total(df, "x", ["v"], descending, slices).collect()
    total = 0
    wanted = {}
    for x, v in sorted(values, reverse=descending):
        total += v
        wanted[x / 7] = total
    assert {r["x"]: r["v_cum"] for r in found} == wanted


def test_linear_fit(spark):
    df = spark.createDataFrame([("a", x, 2.0 * x + 1) for x in range(10)] + [("b", 1, 5.0)], "g string, x int, y double")
    fits = {r["g"]: r for r in aggregates.per_group_linear_fit(df, "g", "x", "y").collect()}
    assert fits["a"]["slope"] == pytest.approx(2) and fits["a"]["intercept"] == pytest.approx(1)
    assert fits["b"]["slope"] is None and fits["b"]["n"] == 1


def test_least_squares_per_group(spark):
    r = random.Random(4)
    data = [(g, r.gauss(1000, 3), r.gauss(0, 1), r.random()) for g in ["a"] * 300 + ["b"] * 40 + [None] * 40]
    data = [(g, x, z, 3 * x - 2 * z + 5 + e if g == "a" else z + e) for g, x, z, e in data] + [("one", 1.0, 2.0, 3.0), ("a", None, 1.0, 1.0), ("flat", 1.0, 1.0, 7.0), ("flat", 2.0, 5.0, 7.0)]
    found = {m.g: m for m in aggregates.per_group_least_squares(spark.createDataFrame(data, "g string, x double, z double, y double"), "g", ["x", "z"], "y").collect()}
    for g in ("a", "b", None):
        rows = np.array([d[1:] for d in data if d[0] == g and d[1] is not None])
        x = np.column_stack([np.ones(len(rows)), rows[:, :2]])
        beta, *_ = np.linalg.lstsq(x, rows[:, 2], rcond=None)
        assert [found[g].intercept, *found[g].coefficients] == pytest.approx(beta.tolist(), rel=1e-5) and found[g].n == len(rows)
        residual = rows[:, 2] - x @ beta
        assert found[g].r2 == pytest.approx(1 - residual @ residual / ((rows[:, 2] - rows[:, 2].mean()) ** 2).sum(), abs=1e-6)
    assert found["one"].coefficients == [0.0, 0.0] and found["one"].intercept == 3.0 and found["one"].r2 is None
    assert found["flat"].intercept == pytest.approx(7.0) and found["flat"].r2 is None


SALES = (
    "customer_segment string, ship_mode string, order_date string, ship_date string, sales_amount double, "
    "profit double, budget double, returned boolean, order_id string, customer_id string, category string"
)


def sales(spark):
    return spark.createDataFrame(
        [
            ("s", "m", "2024-01-01", "2024-01-03", 100.0, 30.0, 50.0, False, "o1", "c1", "A"),
            ("s", "m", "2024-01-31", "2024-02-01", 100.0, 10.0, 50.0, None, "o1", "c1", "A"),
            ("s", "m", "2024-02-01", "2024-02-01", 999.0, 1.0, 1.0, True, "o2", "c2", "B"),
            ("t", "m", "2024-01-15", "2024-01-15", 0.0, 0.0, 0.0, True, "o3", "c1", "A"),
        ],
        SALES,
    )


def test_segment_performance(spark, rows):
    wanted = [
        ("s", "m", 2, 200.0, 40.0, 0.2, 1.5, 0.0, 100.0, 2.0, "優秀"),
        ("t", "m", 1, 0.0, 0.0, None, 0.0, 1.0, 0.0, None, "要改善"),
    ]
    df = sales(spark)
    found = retail.segment_performance(df, "2024-01-01", "2024-01-31")
    assert found.columns == retail.PERFORMANCE_COLUMNS
    assert rows(found) == wanted
    assert rows(retail.segment_performance(df, "", None, F.lit("2024-01-31").cast("date"))) == wanted
    df.createOrReplaceTempView("few_sales")
    retail.register_segment_performance(spark, "few_sales", "few_performance")
    assert rows(spark.sql("SELECT * FROM few_performance('2024-01-01', '2024-01-31')")) == wanted
    assert spark.sql("SELECT * FROM few_performance('', NULL)").count() == 0  # the last two years have no sales


def test_kpis(spark):
    found = dict(map(tuple, retail.kpi_totals(sales(spark)).collect()))
    assert found == {"売上合計": "1,199", "利益合計": "41", "オーダー数": "3", "顧客数": "2"}
    first = retail.category_totals(sales(spark)).first()
    assert tuple(first) == ("B", 999.0, 1.0, 1, 1)
