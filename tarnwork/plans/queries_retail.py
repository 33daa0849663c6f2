"""Projections, joins and aggregates over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions import scalars
from tarnwork.operators import aggregates, joins, project
from tarnwork.plans import driver_tables as dt, retail
from tarnwork.plans.metric_view import SALES_MEASURES, sales_metrics
from tarnwork.plans.registry import query
from tarnwork.session import scratch_dir
from tarnwork.sources.tables import load_tables

FIRST, LAST = "1996-01-01", "1998-12-31"


@query(
    "segment_performance",
    dt.SALES_SQL,
    """agg AS (SELECT customer_segment, ship_mode, COUNT(*) AS order_cnt,
      CAST(SUM(sales_amount) AS DOUBLE) AS total_sales_amount, CAST(SUM(profit) AS DOUBLE) AS total_profit,
      CAST(SUM(budget) AS DOUBLE) AS total_budget, AVG(datediff('day', order_date, ship_date)) AS avg_lead_time_days,
      AVG(CASE WHEN returned THEN 1 ELSE 0 END) AS return_rate
      FROM sales WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY customer_segment, ship_mode)""",
    """SELECT customer_segment, ship_mode, order_cnt, total_sales_amount, total_profit,
      total_profit / nullif(total_sales_amount, 0) AS profit_margin, avg_lead_time_days, return_rate, total_budget,
      total_sales_amount / nullif(total_budget, 0) AS budget_achievement,
      CASE WHEN total_profit / nullif(total_sales_amount, 0) >= 0.2 AND return_rate < 0.05 AND avg_lead_time_days <= 3 THEN '優秀'
        WHEN total_profit / nullif(total_sales_amount, 0) < 0.05 OR return_rate > 0.1 THEN '要改善'
        ELSE '標準' END AS performance_tag
    FROM agg""",
)
def segment_performance(spark, d):
    return retail.segment_performance(dt.sales(spark, d, FIRST, LAST), FIRST, LAST)


@query(
    "segment_performance_function",
    dt.SALES_SQL,
    """SELECT customer_segment, ship_mode, COUNT(*) AS order_cnt, CAST(SUM(sales_amount) AS DOUBLE) AS total_sales_amount
    FROM sales WHERE order_date BETWEEN DATE '1997-01-01' AND current_date GROUP BY customer_segment, ship_mode""",
)
def segment_performance_function(spark, d):
    dt.sales(spark, d).createOrReplaceTempView("sales_silver")
    retail.register_segment_performance(spark, "sales_silver")
    return spark.sql(
        "SELECT customer_segment, ship_mode, order_cnt, total_sales_amount "
        "FROM segment_shipmode_performance('1997-01-01', '')"
    )


@query(
    "param_defaults",
    """WITH shifted AS (SELECT CAST(current_date - CAST(CAST((SELECT MAX(o_orderdate) FROM orders) AS DATE) - CAST(o_orderdate AS DATE) AS INT) AS DATE) AS day,
        CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders),
      periods AS (SELECT * FROM (VALUES ('no start', current_date - 730, current_date), ('empty start', current_date - 730, current_date),
        ('start alone', CAST('2000-01-01' AS DATE), current_date), ('end alone', current_date - 730, current_date - 365)) AS t(given, first_day, last_day))
    SELECT given, COUNT(*) AS n, CAST(SUM(price) AS DOUBLE) AS total FROM shifted JOIN periods ON day BETWEEN first_day AND last_day GROUP BY given""",
)
def param_defaults(spark, d):
    """Orders, moved so that the last one is of today, in periods that leave out the start, the end or both."""
    orders = load_tables(spark, d, "orders")[0].select(F.col("o_orderdate").cast("date").alias("ordered"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"))
    last = orders.agg(F.max("ordered")).scalar()
    moved = orders.withColumn("day", F.date_sub(F.current_date(), F.datediff(last, "ordered")))
    year_ago = spark.range(1).select(F.date_sub(F.current_date(), 365).cast("string")).first()[0]
    given = {"no start": (None, None), "empty start": ("", ""), "start alone": ("2000-01-01", None), "end alone": ("", year_ago)}
    parts = [
        moved.where(F.col("day").between(*retail.period(*dates))).groupBy(F.lit(name).alias("given")).agg(F.count("*").alias("n"), F.sum("price").cast("double").alias("total"))
        for name, dates in given.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "performance_tag",
    """WITH lines AS (SELECT l_returnflag, l_linestatus, l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS s,
        CAST(SUM(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) * 4.9 AS p,
        AVG(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) * 0.4 AS r, AVG(l_linenumber) - 1 AS lead
      FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, l_linestatus, l_suppkey, CASE WHEN p / s >= 0.2 AND r < 0.05 AND lead <= 3 THEN '優秀'
      WHEN p / s < 0.05 OR r > 0.1 THEN '要改善' ELSE '標準' END AS performance_tag FROM lines""",
)
def performance_tag(spark, d):
    """The tag on totals spread so that all three values occur."""
    price, tax = F.col("l_extendedprice").cast("decimal(14,2)"), F.col("l_tax").cast("decimal(4,2)")
    totals = load_tables(spark, d, "lineitem")[0].groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(
        F.sum(price).cast("double").alias("total_sales_amount"),
        (F.sum(tax * price).cast("double") * 4.9).alias("total_profit"),
        (F.avg(F.when(F.col("l_linenumber") == 1, 1).otherwise(0)) * 0.4).alias("return_rate"),
        (F.avg("l_linenumber") - 1).alias("avg_lead_time_days"),
        F.lit(1.0).alias("total_budget"),
    )
    return retail.with_scores(totals).select("l_returnflag", "l_linestatus", "l_suppkey", "performance_tag")


@query(
    "clean_sales",
    dt.SALES_SQL,
    """SELECT order_id, row_id, order_date, ship_date, ship_mode, customer_id, 'n' || customer_id AS customer_name, customer_segment,
      prefecture AS city, prefecture, region AS country_region, region, region AS region_manager, product_id, category, sub_category,
      category || ' ' || sub_category AS product_name, CAST(sales_amount AS DOUBLE) AS sales_amount, quantity,
      CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(profit AS DOUBLE) AS profit, 35.5::DOUBLE AS latitude,
      139.5::DOUBLE AS longitude, CAST(budget AS DOUBLE) AS budget, returned
    FROM sales WHERE profit >= 0""",
)
def clean_sales(spark, d):
    """Lines under the file's own headers and marker, cleaned to the silver table."""
    lines = dt.sales(spark, d).withColumns({
        "customer_name": F.concat(F.lit("n"), F.col("customer_id").cast("string")),
        "city": F.col("prefecture"),
        "country_region": F.col("region"),
        "region_manager": F.col("region"),
        "product_name": F.concat_ws(" ", "category", "sub_category"),
        "latitude": F.lit(35.5),
        "longitude": F.lit(139.5),
        "returned": F.when(F.col("returned"), fv.RETURN_MARKER),
    })
    raw = lines.withColumnsRenamed({name: header for header, name in fv.SALES_COLUMN_NAMES.items()})
    return _as_double(retail.clean_sales(raw), "sales_amount", "discount_rate", "profit", "budget")


# Projections and filters


@query("rename_present", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal AS balance FROM supplier")
def rename_present(spark, d):
    names = {"s_suppkey": "id", "s_name": "name", "s_phone": "phone", "s_acctbal": "balance"}
    return project.rename_present(load_tables(spark, d, "supplier")[0], names)


@query("select_ordered", "SELECT p_size, p_brand, p_partkey FROM part")
def select_ordered(spark, d):
    return load_tables(spark, d, "part")[0].select("p_size", "p_brand", "p_partkey")


@query("select_except", "SELECT * EXCLUDE (p_name, p_size) FROM part")
def select_except(spark, d):
    load_tables(spark, d, "part")[0].createOrReplaceTempView("all_parts")
    return spark.sql("SELECT * EXCEPT (p_name, p_size) FROM all_parts")


@query(
    "filter_nonneg",
    dt.SALES_SQL,
    "SELECT order_id, row_id, CAST(profit AS DOUBLE) AS profit FROM sales WHERE profit >= 0",
)
def filter_nonneg(spark, d):
    kept = dt.sales(spark, d).where("profit >= 0")
    return kept.select("order_id", "row_id", F.col("profit").cast("double").alias("profit"))


@query("filter_eq", "SELECT COUNT(*) AS customers FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, d):
    customer = load_tables(spark, d, "customer")[0]
    return customer.where("c_mktsegment = 'BUILDING'").agg(F.count("*").alias("customers"))


@query(
    "filter_between_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'""",
)
def filter_between_dates(spark, d):
    # Compared in the column's own type, the bounds reach the parquet scan.
    day = F.col("o_orderdate")
    in_march = (day >= F.lit("1996-03-01").cast("timestamp_ntz")) & (day < F.lit("1996-04-01").cast("timestamp_ntz"))
    orders = load_tables(spark, d, "orders")[0].where(in_march)
    return orders.select("o_orderkey", day.cast("date").alias("order_date"))


@query(
    "flag_from_marker",
    """SELECT l_orderkey, l_linenumber, COALESCE(CASE l_returnflag WHEN 'R' THEN '○' WHEN 'A' THEN 'x' END = '○', FALSE)
    AS returned FROM lineitem""",
)
def flag_from_marker(spark, d):
    mark = F.when(F.col("l_returnflag") == "R", fv.RETURN_MARKER).when(F.col("l_returnflag") == "A", "x")
    line = load_tables(spark, d, "lineitem")[0].withColumn("returned", mark)
    return line.select("l_orderkey", "l_linenumber", scalars.flag_from_marker("returned").alias("returned"))


@query(
    "rule_column",
    dt.TRANSACTIONS_SQL,
    """SELECT user_id, product_id, quantity, CAST(transaction_price AS DOUBLE) AS price,
      quantity >= 1 AND transaction_price > 0 AS valid FROM transactions""",
)
def rule_column(spark, d):
    flagged = project.with_rule_flag(dt.transactions(spark, d), fv.TRANSACTION_RULES)
    price = F.col("transaction_price").cast("double").alias("price")
    return flagged.select("user_id", "product_id", "quantity", price, "valid")


@query(
    "bucket_age",
    dt.USERS_SQL,
    """SELECT user_id, CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group
    FROM users""",
)
def bucket_age(spark, d):
    return dt.users(spark, d).select("user_id", scalars.age_bucket("age").alias("age_group"))


@query(
    "bucket_mod",
    "SELECT o_orderkey, ['TV', 'Web', 'Flyer', 'SNS'][o_orderkey % 4 + 1] AS ad_type FROM orders",
)
def bucket_mod(spark, d):
    label = scalars.bucket_label("o_orderkey", fv.AD_TYPES)
    return load_tables(spark, d, "orders")[0].select("o_orderkey", label.alias("ad_type"))


@query(
    "clean_column_names",
    'SELECT s_suppkey AS "supplier-key", s_acctbal AS "accountbalance-total" FROM supplier',
)
def clean_column_names(spark, d):
    supplier = load_tables(spark, d, "supplier")[0]
    return project.clean_names(supplier.select("s_suppkey", "s_acctbal").toDF("supplier (key)", "account balance (total)"))


@query(
    "drop_null_rows",
    dt.TRANSACTIONS_SQL,
    "SELECT user_id, product_id, quantity, area FROM transactions WHERE quantity IS NOT NULL",
)
def drop_null_rows(spark, d):
    return project.drop_null_rows(dt.transactions(spark, d)).drop("transaction_price")


@query(
    "null_sentinel_to_number",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS DOUBLE) END AS number FROM orders""",
)
def null_sentinel_to_number(spark, d):
    status = F.col("o_orderstatus")
    text = F.when(status == "O", "null").when(status == "P", "unknown").otherwise(F.col("o_custkey").cast("string"))
    return load_tables(spark, d, "orders")[0].select("o_orderkey", scalars.to_number(text).alias("number"))


@query(
    "label_map",
    "SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 END AS returned FROM lineitem",
)
def label_map(spark, d):
    line = load_tables(spark, d, "lineitem")[0].select("l_orderkey", "l_returnflag")
    return project.label_column(line, "l_returnflag", {"R": 1, "N": 0}, "returned")


# Joins


@query(
    "batch_enrich",
    dt.TRANSACTIONS_SQL,
    dt.USERS_SQL,
    dt.PRODUCTS_SQL,
    """SELECT t.user_id, t.product_id, t.quantity, CAST(t.transaction_price AS DOUBLE) AS price, u.age, u.gender, u.region,
      p.category, p.subcategory
    FROM transactions t LEFT JOIN users u ON t.user_id = u.user_id LEFT JOIN products p ON t.product_id = p.product_id""",
)
def batch_enrich(spark, d):
    dims = [(dt.users(spark, d), "user_id"), (dt.products(spark, d), "product_id")]
    price = F.col("transaction_price").cast("double").alias("price")
    return joins.enrich(dt.transactions(spark, d), dims).select(
        "user_id", "product_id", "quantity", price, "age", "gender", "region", "category", "subcategory"
    )


@query(
    "skewed_enrich",
    """SELECT e.event_id, e.hot_user AS user_id, CAST(c_acctbal AS DOUBLE) AS balance
    FROM (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 7 WHEN event_type = 'signup' THEN NULL
      ELSE user_id END AS hot_user FROM events) e LEFT JOIN customer ON hot_user = c_custkey""",
)
def skewed_enrich(spark, d):
    """Two fifths of the rows have one key and one fifth has none."""
    event, customer = load_tables(spark, d, "events", "customer")
    kind = F.col("event_type")
    user = F.when(kind.isin("click", "view"), F.lit(7)).when(kind != "signup", F.col("user_id")).cast("bigint")
    balances = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"))
    return joins.left_join_skewed(event.select("event_id", user.alias("user_id")), balances, "user_id")


STAR_SQL = """SELECT COUNT(*) AS row_count, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#3'"""


def _star_totals(spark, d, combine_first):
    line, part = load_tables(spark, d, "lineitem", "part")
    fact = line.select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").cast("decimal(14,2)").alias("revenue"))
    names = ("row_count", "total_revenue")
    totals = joins.star_totals(fact, part, "p_partkey", "p_brand = 'Brand#3'", "revenue", names, combine_first)
    return totals.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("star_inner_filter", STAR_SQL)
def star_inner_filter(spark, d):
    return _star_totals(spark, d, combine_first=False)


@query("star_combined_first", STAR_SQL)
def star_combined_first(spark, d):
    return _star_totals(spark, d, combine_first=True)


@query(
    "user_category_quantity",
    dt.TRANSACTIONS_SQL,
    dt.USERS_SQL,
    dt.PRODUCTS_SQL,
    """lines AS (SELECT t.user_id, t.quantity, p.category FROM transactions t LEFT JOIN products p ON t.product_id = p.product_id),
    per_user AS (SELECT user_id, SUM(CASE WHEN category = 'ECONOMY' THEN quantity ELSE 0 END) AS a,
      SUM(CASE WHEN category = 'PROMO' THEN quantity ELSE 0 END) AS b,
      SUM(CASE WHEN category NOT IN ('ECONOMY', 'PROMO') THEN quantity ELSE 0 END) AS c FROM lines GROUP BY user_id)""",
    """SELECT u.user_id, u.age, CAST(COALESCE(a, 0) AS BIGINT) AS food_quantity, CAST(COALESCE(b, 0) AS BIGINT) AS daily_quantity,
      CAST(COALESCE(c, 0) AS BIGINT) AS other_quantity
    FROM users u LEFT JOIN per_user p ON u.user_id = p.user_id""",
)
def user_category_quantity(spark, d):
    lines = joins.enrich(dt.transactions(spark, d), [(dt.products(spark, d), "product_id")])
    return aggregates.category_quantities(dt.users(spark, d).select("user_id", "age"), lines, "ECONOMY", "PROMO")


@query(
    "inner_using",
    dt.TRANSACTIONS_SQL,
    dt.USERS_SQL,
    """SELECT user_id, region, n FROM users JOIN (SELECT user_id, COUNT(*) AS n FROM transactions GROUP BY user_id) USING (user_id)""",
)
def inner_using(spark, d):
    per_user = dt.transactions(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return dt.users(spark, d).join(per_user, "user_id").select("user_id", "region", "n")


@query(
    "match_audit",
    dt.TRANSACTIONS_SQL,
    dt.USERS_SQL,
    dt.PRODUCTS_SQL,
    """SELECT user_id IN (SELECT user_id FROM users) AS user_id_matched,
      product_id IN (SELECT product_id FROM products) AS product_id_matched, COUNT(*) AS n
    FROM transactions GROUP BY ALL""",
)
def match_audit(spark, d):
    dims = [(dt.users(spark, d), "user_id"), (dt.products(spark, d), "product_id")]
    audited = joins.match_audit(dt.transactions(spark, d), dims)
    return audited.groupBy("user_id_matched", "product_id_matched").agg(F.count("*").alias("n"))


@query(
    "unmatched_rows",
    dt.TRANSACTIONS_SQL,
    dt.PRODUCTS_SQL,
    """SELECT user_id, product_id, quantity FROM transactions WHERE product_id NOT IN (SELECT product_id FROM products)""",
)
def unmatched_rows(spark, d):
    lost = joins.unmatched(dt.transactions(spark, d), dt.products(spark, d), "product_id")
    return lost.select("user_id", "product_id", "quantity")


@query(
    "broadcast_dynamic_prune",
    """SELECT COUNT(*) AS row_count, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = 3""",
)
def broadcast_dynamic_prune(spark, d):
    """A filter on the small side decides at run time which of the large side's partitions are read."""
    line, supplier, nation = load_tables(spark, d, "lineitem", "supplier", "nation")
    path = scratch_dir(spark, "lines")
    placed = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_extendedprice", "s_nationkey")
    # A nation's rows go to several tasks, each writing a file of it.
    placed.repartition("s_nationkey", F.pmod(F.xxhash64("l_extendedprice"), F.lit(8))).write.partitionBy("s_nationkey").parquet(path)
    wanted = nation.where(F.col("n_name") == nation.where("n_nationkey = 3").select("n_name").scalar())
    joined = spark.read.parquet(path).join(F.broadcast(wanted), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations at most
    if "dynamicpruning" not in joined._jdf.queryExecution().executedPlan().toString():
        raise RuntimeError("the join does not prune")
    price = F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double")
    return joined.agg(F.count("*").alias("row_count"), price.alias("total_revenue"))


# Aggregates


ENRICHED_SQL = """enriched AS (SELECT t.*, u.age, u.gender, u.region, p.category, p.subcategory
    FROM transactions t LEFT JOIN users u ON t.user_id = u.user_id LEFT JOIN products p ON t.product_id = p.product_id)"""
ENRICHED = (dt.TRANSACTIONS_SQL, dt.USERS_SQL, dt.PRODUCTS_SQL, ENRICHED_SQL)


def _enriched(spark, d):
    dims = [(dt.users(spark, d), "user_id"), (dt.products(spark, d), "product_id")]
    return joins.enrich(dt.transactions(spark, d), dims)


def _as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(
    "revenue_by_subcategory",
    *ENRICHED,
    "SELECT subcategory, CAST(SUM(transaction_price) AS DOUBLE) AS sum_revenue FROM enriched GROUP BY subcategory",
)
def revenue_by_subcategory(spark, d):
    return _as_double(retail.revenue_by_subcategory(_enriched(spark, d)), "sum_revenue")


@query(
    "revenue_by_segment",
    *ENRICHED,
    """SELECT CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group, gender, region,
      CAST(SUM(transaction_price) AS DOUBLE) AS sum_revenue FROM enriched GROUP BY 1, 2, 3""",
)
def revenue_by_segment(spark, d):
    return _as_double(retail.revenue_by_user_segment(_enriched(spark, d)), "sum_revenue")


@query(
    "monthly_weather",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month,
      ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / COUNT(*), 2) AS avg_value,
      ROUND(MAX(o_totalprice), 2) AS max_value, ROUND(MIN(o_totalprice), 2) AS min_value FROM orders GROUP BY 1""",
)
def monthly_weather(spark, d):
    """The monthly weather table's aggregates, on the prices of orders."""
    exact_sum = F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double")
    return aggregates.monthly_rollup(
        load_tables(spark, d, "orders")[0],
        "o_orderdate",
        {
            "avg_value": F.round(exact_sum / F.count("*"), 2),
            "max_value": F.round(F.max("o_totalprice"), 2),
            "min_value": F.round(F.min("o_totalprice"), 2),
        },
    )


@query(
    "category_totals",
    dt.SALES_SQL,
    """SELECT category, CAST(SUM(sales_amount) AS DOUBLE) AS total_sales, CAST(SUM(profit) AS DOUBLE) AS total_profit,
      COUNT(*) AS line_count, COUNT(DISTINCT order_id) AS order_count FROM sales GROUP BY category""",
)
def category_totals(spark, d):
    return _as_double(retail.category_totals(dt.sales(spark, d)), "total_sales", "total_profit")


@query(
    "kpi_totals",
    dt.SALES_SQL,
    """SELECT '売上合計' AS metric, CAST(SUM(sales_amount) AS DOUBLE) AS value FROM sales
    UNION ALL SELECT '利益合計', CAST(SUM(profit) AS DOUBLE) FROM sales
    UNION ALL SELECT 'オーダー数', COUNT(DISTINCT order_id) FROM sales
    UNION ALL SELECT '顧客数', COUNT(DISTINCT customer_id) FROM sales""",
)
def kpi_totals(spark, d):
    return retail.kpi_totals(dt.sales(spark, d), formatted=False)


@query(
    "kpi_totals_text",
    dt.SALES_SQL,
    """SELECT '売上合計' AS metric, format('{:,}', CAST(round(SUM(sales_amount), 0) AS BIGINT)) AS value FROM sales
    UNION ALL SELECT '利益合計', format('{:,}', CAST(round(SUM(profit), 0) AS BIGINT)) FROM sales
    UNION ALL SELECT 'オーダー数', format('{:,}', COUNT(DISTINCT order_id)) FROM sales
    UNION ALL SELECT '顧客数', format('{:,}', COUNT(DISTINCT customer_id)) FROM sales""",
)
def kpi_totals_text(spark, d):
    return retail.kpi_totals(dt.sales(spark, d))


@query(
    "distinct_count",
    dt.SALES_SQL,
    """SELECT region, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers FROM sales GROUP BY region""",
)
def distinct_count(spark, d):
    # Two distinct counts over the lines would copy each line for either; over the distinct pairs they copy few rows.
    pairs = dt.sales(spark, d).select("region", "order_id", "customer_id").distinct()
    return pairs.groupBy("region").agg(
        F.countDistinct("order_id").alias("orders"), F.countDistinct("customer_id").alias("customers")
    )


@query(
    "conditional_sum_pivot",
    *ENRICHED,
    """SELECT user_id, CAST(SUM(CASE WHEN category = 'ECONOMY' THEN quantity ELSE 0 END) AS BIGINT) AS economy,
      CAST(SUM(CASE WHEN category NOT IN ('ECONOMY') THEN quantity ELSE 0 END) AS BIGINT) AS other
    FROM enriched GROUP BY user_id""",
)
def conditional_sum_pivot(spark, d):
    category = F.col("category")
    return _enriched(spark, d).groupBy("user_id").agg(
        aggregates.sum_where("quantity", category == "ECONOMY", "economy"),
        aggregates.sum_where("quantity", ~category.isin("ECONOMY"), "other"),
    )


@query(
    "ratio_safe",
    """SELECT l_orderkey, l_linenumber, l_quantity / nullif(l_tax, 0) AS ratio FROM lineitem""",
)
def ratio_safe(spark, d):
    ratio = scalars.ratio_safe("l_quantity", "l_tax").alias("ratio")
    return load_tables(spark, d, "lineitem")[0].select("l_orderkey", "l_linenumber", ratio)


@query(
    "percent_of_total",
    """SELECT c_mktsegment, COUNT(*) AS customers,
      CAST(ROUND(CAST(COUNT(*) * 1000 AS DOUBLE) / (SELECT COUNT(*) FROM customer)) AS DOUBLE) / 10 AS pct
    FROM customer GROUP BY c_mktsegment""",
)
def percent_of_total(spark, d):
    customer = load_tables(spark, d, "customer")[0]
    return _as_double(aggregates.percent_of_total(customer, "c_mktsegment", "customers"), "pct")


@query(
    "order_by_agg_desc",
    """SELECT p_brand, COUNT(*) AS parts FROM part GROUP BY p_brand ORDER BY parts DESC, p_brand""",
)
def order_by_agg_desc(spark, d):
    part = load_tables(spark, d, "part")[0]
    return part.groupBy("p_brand").agg(F.count("*").alias("parts")).orderBy(F.desc("parts"), "p_brand")


@query(
    "topk",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 12",
)
def topk(spark, d):
    orders = load_tables(spark, d, "orders")[0]
    return orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(12)


@query(
    "per_group_linear_fit",
    dt.SALES_SQL,
    """SELECT region, COUNT(*) AS n, ROUND(regr_slope(CAST(sales_amount AS DOUBLE), quantity), 4) AS slope,
      ROUND(regr_intercept(CAST(sales_amount AS DOUBLE), quantity), 3) AS intercept,
      ROUND(regr_r2(CAST(sales_amount AS DOUBLE), quantity), 8) AS r2 FROM sales GROUP BY region""",
)
def per_group_linear_fit(spark, d):
    lines = _as_double(dt.sales(spark, d), "sales_amount")
    fits = aggregates.per_group_linear_fit(lines, "region", "quantity", "sales_amount")
    places = {"slope": 4, "intercept": 3, "r2": 8}
    return fits.withColumns({c: F.round(c, n) for c, n in places.items()})


@query(
    "per_group_least_squares",
    dt.SALES_SQL,
    """moments AS (SELECT region, COUNT(*) AS n, AVG(x) AS mx, AVG(z) AS mz, AVG(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, var_pop(y) AS yy,
        covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy
      FROM (SELECT region, CAST(quantity AS DOUBLE) AS x, CAST(discount_rate AS DOUBLE) AS z, CAST(sales_amount AS DOUBLE) AS y FROM sales) GROUP BY region),
    solved AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM moments)""",
    """SELECT region, n, ROUND(my - bx * mx - bz * mz, 2) AS intercept, ROUND(bx, 3) AS of_quantity, ROUND(bz, 2) AS of_discount,
      ROUND((bx * xy + bz * zy) / yy, 7) AS r2 FROM solved""",
)
def per_group_least_squares(spark, d):
    """A model of two features for each region, all from one aggregation."""
    fits = aggregates.per_group_least_squares(dt.sales(spark, d), "region", ["quantity", "discount_rate"], "sales_amount")
    return fits.select(
        "region", "n", F.round("intercept", 2).alias("intercept"), F.round(F.col("coefficients")[0], 3).alias("of_quantity"),
        F.round(F.col("coefficients")[1], 2).alias("of_discount"), F.round("r2", 7).alias("r2"),
    )


# Metric view


def _metrics(spark, d):
    """Sums as DOUBLE, for the check's SQL divides decimals that way."""
    view = sales_metrics(dt.sales(spark, d))
    doubles = {m: f"cast({SALES_MEASURES[m]} as double)" for m in ("total_sales", "total_profit")}
    dims = {**view.dimensions, "order_month": f"cast({view.dimensions['order_month']} as date)"}
    return type(view)(view.source, dims, {**view.measures, **doubles}, view.details)


METRICS_SQL = """CAST(SUM(sales_amount) AS DOUBLE) AS total_sales, CAST(SUM(profit) AS DOUBLE) AS total_profit,
      COUNT(DISTINCT order_id) AS order_count,
      CAST(SUM(profit) AS DOUBLE) / nullif(CAST(SUM(sales_amount) AS DOUBLE), 0) AS profit_margin"""


@query(
    "metric_view",
    dt.SALES_SQL,
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, {METRICS_SQL}
    FROM sales GROUP BY 1 ORDER BY 1 LIMIT 12""",
)
def metric_view(spark, d):
    measures = ["total_sales", "total_profit", "order_count", "profit_margin"]
    return _metrics(spark, d).query(["order_month"], measures).orderBy("order_month").limit(12)


@query(
    "metric_view_two_dimensions",
    dt.SALES_SQL,
    """SELECT region, customer_segment, CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(DISTINCT customer_id) AS customer_count,
      CAST(SUM(sales_amount) AS DOUBLE) / nullif(COUNT(DISTINCT order_id), 0) AS avg_order_value
    FROM sales GROUP BY region, customer_segment""",
)
def metric_view_two_dimensions(spark, d):
    return _metrics(spark, d).query(
        ["region", "customer_segment"], ["total_quantity", "customer_count", "avg_order_value"]
    )


@query(
    "metric_view_formatted",
    dt.SALES_SQL,
    """SELECT strftime(date_trunc('month', order_date), '%Y-%-m-%-d') AS order_month,
      format('{:,}', CAST(round_even(CAST(SUM(sales_amount) AS DOUBLE), 0) AS BIGINT)) AS total_sales,
      format('{:.1f}%', CAST(SUM(profit) AS DOUBLE) / CAST(SUM(sales_amount) AS DOUBLE) * 100) AS profit_margin
    FROM sales GROUP BY date_trunc('month', order_date)""",
)
def metric_view_formatted(spark, d):
    return _metrics(spark, d).query(["order_month"], ["total_sales", "profit_margin"], formatted=True)


def _texts_sql() -> str:
    rows = []
    for name, (shown, comment, synonyms) in fv.METRIC_TEXTS.items():
        kind = "measure" if name in SALES_MEASURES else "dimension"
        rows.append(f"('{kind}', '{name}', '{shown}', '{comment}', '{', '.join(synonyms)}')")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(kind, name, display_name, comment, synonyms)"


@query("metric_view_descriptions", _texts_sql())
def metric_view_descriptions(spark, d):
    """Display names, comments and synonyms, from the metadata that the view's columns carry."""
    view = sales_metrics(dt.sales(spark, d))
    schema = view.query(list(view.dimensions), list(view.measures)).schema
    kinds = {name: kind for kind, name, *_ in view.descriptions()}
    rows = [(kinds[f.name], f.name, f.metadata["display_name"], f.metadata["comment"], ", ".join(f.metadata.get("synonyms", []))) for f in schema]
    return spark.createDataFrame(rows, "kind string, name string, display_name string, comment string, synonyms string")


@query("metric_view_total", dt.SALES_SQL, f"SELECT {METRICS_SQL} FROM sales")
def metric_view_total(spark, d):
    return _metrics(spark, d).query([], ["total_sales", "total_profit", "order_count", "profit_margin"])
