import pytest
from conftest import day

from tarnwork.plans.metric_view import MetricView, sales_metrics

SALES = [
    ("o1", "c1", "A", "x", 100.0, 10.0, 1, day("2024-01-05")),
    ("o1", "c1", "B", "x", 300.0, 90.0, 2, day("2024-01-05")),
    ("o2", "c2", "A", "y", 600.0, 0.0, 3, day("2024-02-10")),
    ("o3", "c1", "A", "y", 0.0, 0.0, 4, day("2024-03-01")),
]
DDL = (
    "order_id string, customer_id string, category string, region string, sales_amount double, profit double, "
    "quantity int, order_date date"
)


@pytest.fixture
def view(spark):
    df = spark.createDataFrame(SALES, DDL)
    blank = {c: "'-'" for c in ("sub_category", "prefecture", "customer_segment")}
    return sales_metrics(df.selectExpr("*", *[f"{v} AS {k}" for k, v in blank.items()]))


def test_ratios_are_of_totals(view, rows):
    by = rows(view.query(["category"], ["profit_margin", "avg_order_value", "order_count"]))
    assert by == [("A", 10 / 700, 700 / 3, 3), ("B", 0.3, 300.0, 1)]
    total = view.query([], ["profit_margin", "order_count", "customer_count"]).first()
    assert tuple(total) == (0.1, 3, 2)


def test_zero_sales_have_no_margin(view, rows):
    assert rows(view.query(["order_month"], ["profit_margin"]))[-1][1] is None


def test_only_what_is_asked_is_shown(view):
    assert view.query(["region"], ["profit_margin"]).columns == ["region", "profit_margin"]


def test_formats(view, rows):
    shown = rows(view.query(["order_month"], ["total_sales", "profit_margin"], formatted=True))
    assert shown[0] == ("2024-1-1", "400", "25.0%")
    metadata = MetricView(view.source, {}, {"n": "count(*)"}, {"n": {"display_name": "N", "synonyms": ["m"]}})
    assert metadata.query([], ["n"]).schema["n"].metadata == {"display_name": "N", "synonyms": ["m"]}


def test_chained_measures(view):
    measures = {
        "n": "count(*)",
        "twice": "measure( n ) * 2",
        "ratio": "MEASURE(twice) / MEASURE(n) + MEASURE(four)",
        "four": "MEASURE(twice) * 0 + 4",
    }
    assert MetricView(view.source, {}, measures).query([], ["ratio"]).first()["ratio"] == 6


def test_unknown_and_circular(view):
    with pytest.raises(KeyError, match="nothing"):
        view.query(["nothing"], ["total_sales"])
    with pytest.raises(KeyError, match="nothing"):
        view.query([], ["nothing"])
    circle = MetricView(view.source, {}, {"a": "MEASURE(b)", "b": "MEASURE(a) + 1"})
    with pytest.raises(ValueError, match="circle"):
        circle.query([], ["a"])


def test_from_yaml(view):
    yaml = pytest.importorskip("yaml")
    text = """
    dimensions:
      - {name: region, expr: source.region, display_name: Region}
    measures:
      - {name: total, expr: sum(source.sales_amount), format: {type: number, decimal_places: {places: 2}}}
      - {name: half, expr: MEASURE(total) / 2}
    """
    made = MetricView.from_spec(view.source, yaml.safe_load(text))
    found = made.query(["region"], ["total", "half"], formatted=True).orderBy("region")
    assert [tuple(r) for r in found.collect()] == [("x", "400.00", 200.0), ("y", "600.00", 300.0)]
    assert found.schema["region"].metadata["display_name"] == "Region"
