"""Retail sales: the silver table, its scorecards and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import age_bucket, date_or_default, flag_from_marker, group_digits
from tarnwork.operators.aggregates import sum_by
from tarnwork.operators.project import rename_present


def clean_sales(raw: DataFrame) -> DataFrame:
    """Silver sales lines: columns renamed and ordered, loss-making lines out, returns as a flag.

    A line without a profit is dropped with the negative ones.
    """
    renamed = rename_present(raw, fv.SALES_COLUMN_NAMES)
    return renamed.where("profit >= 0").withColumn("returned", flag_from_marker("returned")).select(*fv.SALES_COLUMNS)


_MARGIN = "total_profit / nullif(total_sales_amount, 0)"
_TOTALS = {
    "order_cnt": "count(*)",
    "total_sales_amount": "cast(sum(sales_amount) as double)",
    "total_profit": "cast(sum(profit) as double)",
    "avg_lead_time_days": "avg(datediff(to_date(ship_date), to_date(order_date)))",
    "return_rate": "avg(if(returned, 1, 0))",
    "total_budget": "cast(sum(budget) as double)",
}
_SCORES = {
    "profit_margin": _MARGIN,
    "budget_achievement": "total_sales_amount / nullif(total_budget, 0)",
    "performance_tag": (
        f"case when {_MARGIN} >= 0.2 and return_rate < 0.05 and avg_lead_time_days <= 3 then '{fv.TAG_EXCELLENT}'"
        f" when {_MARGIN} < 0.05 or return_rate > 0.1 then '{fv.TAG_NEEDS_ATTENTION}' else '{fv.TAG_STANDARD}' end"
    ),
}
PERFORMANCE_COLUMNS = [
    "customer_segment", "ship_mode", "order_cnt", "total_sales_amount", "total_profit", "profit_margin",
    "avg_lead_time_days", "return_rate", "total_budget", "budget_achievement", "performance_tag",
]


def with_scores(totals: DataFrame) -> DataFrame:
    """Margin, budget achievement and performance tag beside a group's totals."""
    return totals.withColumns({name: F.expr(text) for name, text in _SCORES.items()})


def period(start: str | None, end: str | None, today: Column | None = None) -> tuple[Column, Column]:
    """First and last day; without a start the 730 days before today, without an end today."""
    today = F.current_date() if today is None else today
    return date_or_default(start, F.date_sub(today, 730)), date_or_default(end, today)


def segment_performance(
    sales: DataFrame, start: str | None = None, end: str | None = None, today: Column | None = None
) -> DataFrame:
    """Scorecard per customer segment and ship mode for orders of a period, both ends included."""
    first, last = period(start, end, today)
    totals = (
        sales.where(F.to_date("order_date").between(first, last))
        .groupBy("customer_segment", "ship_mode")
        .agg(*[F.expr(text).alias(name) for name, text in _TOTALS.items()])
    )
    return with_scores(totals).select(*PERFORMANCE_COLUMNS)


def register_segment_performance(
    spark: SparkSession, sales_view: str, name: str = "segment_shipmode_performance"
) -> None:
    """The scorecard as a SQL table function ``name(start_date, end_date)`` over a view or table."""
    types = dict.fromkeys(PERFORMANCE_COLUMNS, "double")
    types |= {"customer_segment": "string", "ship_mode": "string", "order_cnt": "bigint", "performance_tag": "string"}
    totals = ", ".join(f"{text} as {c}" for c, text in _TOTALS.items())
    columns = ", ".join(f"{_SCORES[c]} as {c}" if c in _SCORES else c for c in PERFORMANCE_COLUMNS)
    spark.sql(f"""
        create or replace temporary function {name}(start_date string, end_date string)
        returns table ({", ".join(f"{c} {t}" for c, t in types.items())})
        return select {columns} from (
            select customer_segment, ship_mode, {totals} from {sales_view}
            where to_date(order_date) between
                coalesce(to_date(nullif(start_date, '')), date_sub(current_date(), 730))
                and coalesce(to_date(nullif(end_date, '')), current_date())
            group by customer_segment, ship_mode)
    """)


def kpi_totals(sales: DataFrame, formatted: bool = True) -> DataFrame:
    """Four totals as (metric, value) rows, from a single pass over the sales.

    Lines are combined per order and customer first: counting two kinds of
    distinct keys copies each row three times, so there should be few of them.
    """
    per_order = sales.groupBy("order_id", "customer_id").agg(
        F.sum("sales_amount").alias("sales_amount"), F.sum("profit").alias("profit")
    )
    totals = per_order.agg(
        F.sum("sales_amount").alias(fv.KPI_SALES),
        F.sum("profit").alias(fv.KPI_PROFIT),
        F.countDistinct("order_id").alias(fv.KPI_ORDERS),
        F.countDistinct("customer_id").alias(fv.KPI_CUSTOMERS),
    )
    shown = [(group_digits(c) if formatted else F.col(c).cast("double")).alias(c) for c in totals.columns]
    return totals.select(*shown).unpivot([], totals.columns, "metric", "value")


def category_totals(sales: DataFrame) -> DataFrame:
    """Per category: sales, profit, lines and distinct orders, largest sales first."""
    return (
        sales.groupBy("category")
        .agg(
            F.sum("sales_amount").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            F.count("*").alias("line_count"),
            F.countDistinct("order_id").alias("order_count"),
        )
        .orderBy(F.desc("total_sales"), "category")
    )


def revenue_by_subcategory(enriched: DataFrame) -> DataFrame:
    return sum_by(enriched, ["subcategory"], "transaction_price", "sum_revenue")


def revenue_by_user_segment(enriched: DataFrame) -> DataFrame:
    keys = [age_bucket("age").alias("age_group"), "gender", "region"]
    return sum_by(enriched, keys, "transaction_price", "sum_revenue")
