"""The TPC-H-like tables in the shapes the operators work on, and the same in SQL for the checks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnwork.sources.tables import load_tables

SALES_SQL = """sales AS (
  SELECT o_orderkey AS order_id, l_linenumber AS row_id, CAST(o_orderdate AS DATE) AS order_date,
    CAST(l_shipdate AS DATE) AS ship_date, o_orderpriority AS ship_mode, c_custkey AS customer_id,
    c_mktsegment AS customer_segment, n_name AS prefecture, r_name AS region, p_partkey AS product_id,
    p_type AS category, p_brand AS sub_category, CAST(l_extendedprice AS DECIMAL(14,2)) AS sales_amount,
    CAST(l_quantity AS BIGINT) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
    CAST(l_extendedprice AS DECIMAL(14,2))
      * (CAST(0.25 AS DECIMAL(4,2)) - CAST(3 AS DECIMAL(4,0)) * CAST(l_discount AS DECIMAL(4,2))) AS profit,
    CAST(l_quantity AS DECIMAL(14,0)) * CAST(p_retailprice AS DECIMAL(10,2)) AS budget,
    l_returnflag = 'R' AS returned
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""


#: Lines of one task where lines meet orders and are aggregated by order. Their bytes do not tell: what compresses well is large in memory.
LINES_PER_TASK = 100_000


def sales(spark: SparkSession, d: str, first: str | None = None, last: str | None = None, lines_per_task: int = LINES_PER_TASK) -> DataFrame:
    """Sales lines, dealt by order to as many tasks as the number of lines asks for; a period of order days reaches the scan of the orders."""
    line, order, customer, nation, region, part = load_tables(
        spark, d, "lineitem", "orders", "customer", "nation", "region", "part"
    )
    if first:
        order = order.where(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if last:
        order = order.where(F.col("o_orderdate") < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    # What belongs to an order is joined to the orders, a quarter of the lines' size.
    buyers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    bought = order.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # Products of up to 18 digits stay in a LONG.
    price = F.col("l_extendedprice").cast("decimal(14,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    rate = (F.lit("0.25").cast("decimal(4,2)") - F.lit(3).cast("decimal(1,0)") * discount).cast("decimal(5,2)")
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .repartition(max(1, math.ceil(line.count() / lines_per_task)), "l_orderkey")  # counted from the files' footers
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("row_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("o_orderpriority").alias("ship_mode"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("prefecture"),
            F.col("r_name").alias("region"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            price.alias("sales_amount"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            discount.alias("discount_rate"),
            (price * rate).alias("profit"),
            (F.col("l_quantity").cast("decimal(14,0)") * F.col("p_retailprice").cast("decimal(10,2)")).alias("budget"),
            (F.col("l_returnflag") == "R").alias("returned"),
        )
    )


# Some lines get no quantity, no price, an unknown user or an unknown product.
TRANSACTIONS_SQL = """transactions AS (
  SELECT CASE WHEN l_tax = 0.07 THEN -1 - o_custkey ELSE o_custkey END AS user_id,
    CASE WHEN l_discount = 0.09 THEN -1 - l_partkey ELSE l_partkey END AS product_id,
    CASE WHEN l_discount = 0.1 THEN NULL WHEN l_discount = 0.08 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
    CASE WHEN l_tax = 0.08 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS transaction_price,
    l_linestatus AS area
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def transactions(spark: SparkSession, d: str) -> DataFrame:
    line, order = load_tables(spark, d, "lineitem", "orders")
    discount, tax = F.col("l_discount"), F.col("l_tax")
    quantity = F.when(discount == 0.08, 0).when(discount != 0.1, F.col("l_quantity").cast("int"))
    price = F.when(tax == 0.08, F.lit(0)).otherwise(F.col("l_extendedprice")).cast("decimal(14,2)")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(tax == 0.07, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(discount == 0.09, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("product_id"),
        quantity.alias("quantity"),
        price.alias("transaction_price"),
        F.col("l_linestatus").alias("area"),
    )


USERS_SQL = """users AS (
  SELECT c_custkey AS user_id, CAST(c_custkey % 70 + 10 AS INT) AS age,
    CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS region
  FROM customer)"""


def users(spark: SparkSession, d: str) -> DataFrame:
    return load_tables(spark, d, "customer")[0].select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") % 70 + 10).cast("int").alias("age"),
        F.when(F.col("c_acctbal") < 5000, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("region"),
    )


PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS subcategory FROM part)"""


def products(spark: SparkSession, d: str) -> DataFrame:
    return load_tables(spark, d, "part")[0].select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory")
    )


FEED_SQL = """feed AS (
  SELECT user_id, CAST(floor(value) AS INT) AS age, props AS region, ts AS last_updated, event_id,
    CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS operation
  FROM events)"""


def feed(spark: SparkSession, d: str) -> DataFrame:
    return load_tables(spark, d, "events")[0].select(
        "user_id",
        F.floor("value").cast("int").alias("age"),
        F.col("props").alias("region"),
        F.col("ts").alias("last_updated"),
        "event_id",
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("operation"),
    )


# A made-up classifier: dear lines are taken for returned ones.
SCORED_SQL = """scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice / 110000.0 AS probability,
    CASE WHEN l_extendedprice >= 55000 THEN 1 ELSE 0 END AS prediction, l_linestatus AS split
  FROM lineitem)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    return load_tables(spark, d, "lineitem")[0].select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        (F.col("l_extendedprice") / 110000.0).alias("probability"),
        F.when(F.col("l_extendedprice") >= 55000, 1).otherwise(0).alias("prediction"),
        F.col("l_linestatus").alias("split"),
    )


STAFF_SQL = """staff AS (
  SELECT c_custkey AS employee_id, c_name AS name,
    lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' AS email,
    n_name AS department, c_acctbal AS salary, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def staff(spark: SparkSession, d: str) -> DataFrame:
    customer, nation, region = load_tables(spark, d, "customer", "nation", "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("employee_id"),
            F.col("c_name").alias("name"),
            F.expr("lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example'").alias("email"),
            F.col("n_name").alias("department"),
            F.col("c_acctbal").alias("salary"),
            F.col("r_name").alias("region"),
        )
    )
