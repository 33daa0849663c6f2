"""Sources, sinks, layout and generators over the driver tables."""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import group_digits, padded
from tarnwork.operators import aggregates, tables
from tarnwork.operators.versions import IncrementalView, VersionedTable
from tarnwork.operators.zones import ZonedTable, write_zoned
from tarnwork.plans import driver_tables as dt
from tarnwork.plans.registry import query
from tarnwork.session import scratch_database, scratch_dir
from tarnwork.sources import files, star
from tarnwork.sources.chunks import read_chunks
from tarnwork.sources.statements import statement_json_to_df
from tarnwork.sources.tables import load_tables, scan_table_stream, table_detail, table_row_counts
from tarnwork.streaming import flows


def land_csv(spark: SparkSession, df: DataFrame, label: str) -> str:
    """Write a frame as CSV files; times as text, which keeps their microseconds."""
    path = scratch_dir(spark, label)
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    df.withColumns({c: F.col(c).cast("string") for c in times}).write.option("header", True).csv(path)
    return path


def _order_lines(spark, d):
    return load_tables(spark, d, "orders")[0].select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"),
    )


ORDER_DDL = "order_id bigint, order_date date, total double, priority string"
ORDER_SQL = """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total,
  o_orderpriority AS priority FROM orders"""


@query("scan_csv", ORDER_SQL)
def scan_csv(spark, d):
    df = files.scan_csv(spark, land_csv(spark, _order_lines(spark, d), "csv"))
    return df.withColumn("order_id", F.col("order_id").cast("bigint"))


@query("scan_csv_tvf", ORDER_SQL)
def scan_csv_tvf(spark, d):
    path = land_csv(spark, _order_lines(spark, d), "csv")
    return files.scan_csv(spark, path, ORDER_DDL, rescue="_rescued_data").drop("_rescued_data")


@query("stream_csv", ORDER_SQL)
def stream_csv(spark, d):
    source, target = land_csv(spark, _order_lines(spark, d), "csv"), scratch_dir(spark, "orders")
    stream = files.CsvFiles(spark, source, ORDER_DDL, "_rescued")
    flows.append_flows(target, {"all": stream}, scratch_dir(spark, "checkpoints"))
    return flows.read_flows(spark, target).drop("_rescued")


@query(
    "rescued_data",
    """SELECT l_orderkey AS order_id, l_linenumber AS line,
      CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS INT) END AS quantity,
      CASE WHEN l_returnflag = 'A' THEN '{"quantity":"about ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '","flag":"A"}'
        ELSE '{"flag":"' || l_returnflag || '"}' END AS _rescued_data
    FROM lineitem""",
)
def rescued_data(spark, d):
    quantity = F.col("l_quantity").cast("int").cast("string")
    raw = load_tables(spark, d, "lineitem")[0].select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("about "), quantity)).otherwise(quantity).alias("quantity"),
        F.col("l_returnflag").alias("flag"),
    )
    path = land_csv(spark, raw, "csv")
    return files.scan_csv(spark, path, "order_id bigint, line int, quantity int", rescue="_rescued_data")


@query(
    "stream_csv_headers",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS priority,
      CASE WHEN o_orderkey % 3 <> 1 THEN NULL WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer_id,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL
        WHEN o_orderkey % 3 = 1 AND o_orderstatus = 'P' THEN '{"customer_id":"about ' || o_custkey || '","status":"P"}'
        ELSE '{"status":"' || o_orderstatus || '"}' END AS _rescued_data
    FROM orders""",
)
def stream_csv_headers(spark, d):
    """Files of one directory with other columns, or the same in another order, in two micro-batches."""
    orders, base, target, checkpoints = load_tables(spark, d, "orders")[0], scratch_dir(spark, "landing"), scratch_dir(spark, "orders"), scratch_dir(spark, "checkpoints")
    of = lambda k: orders.where(F.col("o_orderkey") % 3 == k)
    key, priority, status = F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
    text = F.col("o_custkey").cast("string")
    customer = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("about "), text)).otherwise(text).alias("Customer_ID")
    landings = [[("plain", of(0).select(key, priority)), ("turned", of(2).select(status, priority, key))], [("other", of(1).select(customer, key, status))]]
    lines = files.CsvFiles(spark, f"{base}/*", "order_id bigint, priority string, customer_id bigint", "_rescued_data")
    for batch in landings:
        for name, rows in batch:
            rows.write.option("header", True).csv(f"{base}/{name}")
        flows.append_flows(target, {"orders": lines}, checkpoints)
    return flows.read_flows(spark, target)


@query(
    "infer_types",
    """SELECT * FROM (VALUES ('order_id', 'int'), ('order_date', 'date'), ('total', 'double'), ('priority', 'string'))
    AS t(column_name, data_type)""",
)
def infer_types(spark, d):
    schema = files.infer_schema(spark, land_csv(spark, _order_lines(spark, d), "csv"))
    rows = [(f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(rows, "column_name string, data_type string")


@query("scan_table", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def scan_table(spark, d):
    return load_tables(spark, d, "lineitem")[0].groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("scan_table_stream", "SELECT event_id, user_id, event_type, value FROM events")
def scan_table_stream_query(spark, d):
    target = scratch_dir(spark, "events")
    # The glob lets the file source take a single file as well as a folder.
    stream = scan_table_stream(spark, f"{d}/event[s].parquet").select("event_id", "user_id", "event_type", "value")
    flows.append_flows(target, {"all": stream}, scratch_dir(spark, "checkpoints"))
    return flows.read_flows(spark, target)


@query(
    "stream_filter_project",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
)
def stream_filter_project(spark, d):
    target = scratch_dir(spark, "events")
    stream = scan_table_stream(spark, f"{d}/event[s].parquet").where("event_type = 'purchase'")
    flows.append_flows(target, {"all": stream.drop("event_type", "ts", "props")}, scratch_dir(spark, "checkpoints"))
    return flows.read_flows(spark, target)


@query(
    "scan_json_array",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT c_custkey, -c_acctbal, 'copy' FROM customer""",
)
def scan_json_array(spark, d):
    path = scratch_dir(spark, "json")
    one = lambda b, s: F.struct(F.col("c_custkey").alias("id"), b.alias("balance"), s.alias("segment"))
    pair = F.array(one(F.col("c_acctbal"), F.col("c_mktsegment")), one(-F.col("c_acctbal"), F.lit("copy")))
    load_tables(spark, d, "customer")[0].select(F.to_json(pair)).write.text(path)
    return files.scan_json_array(spark, path, "id bigint, balance double, segment string", multi_line=False)


@query(
    "statement_json_to_df",
    "SELECT CAST(s_suppkey AS VARCHAR) AS supplier, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier",
)
def statement_documents(spark, d):
    names = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("supplier", "name", "nation")])
    row = F.array(F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"))
    document = F.struct(
        F.struct(
            F.struct(F.struct(names.alias("columns")).alias("schema")).alias("manifest"),
            F.struct(F.array(row).alias("data_array")).alias("result"),
        ).alias("statement_response")
    )
    return statement_json_to_df(load_tables(spark, d, "supplier")[0].select(F.to_json(document).alias("value")))


@query(
    "temp_view",
    "SELECT n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name",
)
def temp_view(spark, d):
    supplier, nation = load_tables(spark, d, "supplier", "nation")
    supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).createOrReplaceTempView("supplier_nation")
    return spark.sql("SELECT n_name, count(*) AS suppliers FROM supplier_nation GROUP BY n_name")


# Generators take ids; here the ids are the keys of a table.


@query(
    "gen_dim_promotion",
    """SELECT o_orderkey + 1 AS promotion_id, 'Promo_' || lpad(CAST(o_orderkey + 1 AS VARCHAR), CAST(greatest(3, length(CAST(o_orderkey + 1 AS VARCHAR))) AS INT), '0') AS promo_name,
      ['TV', 'Web', 'Flyer', 'SNS'][o_orderkey % 4 + 1] AS ad_type,
      ['Percent', 'Fixed', 'BOGO'][o_orderkey % 3 + 1] AS coupon_type,
      ['Discount', 'Bundle'][o_orderkey % 2 + 1] AS price_reduction_type
    FROM orders""",
)
def gen_dim_promotion(spark, d):
    return star.dim_promotion(load_tables(spark, d, "orders")[0].select(F.col("o_orderkey").alias("id")))


@query(
    "gen_dim_customer",
    """SELECT c_custkey + 1 AS customer_id, 'Customer_' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS name,
      ['新宿区','大阪市','名古屋市','札幌市','福岡市','仙台市','横浜市','広島市','京都市','神戸市'][c_custkey % 10 + 1] AS city,
      ['東京都','大阪府','愛知県','北海道','福岡県','宮城県','神奈川県','広島県','京都府','兵庫県'][c_custkey % 10 + 1] AS prefecture,
      lpad(CAST(c_custkey % 999 + 1 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 9999 + 1 AS VARCHAR), 4, '0') AS zip
    FROM customer""",
)
def gen_dim_customer(spark, d):
    return star.dim_customer(load_tables(spark, d, "customer")[0].select(F.col("c_custkey").alias("id")))


@query(
    "gen_dim_time",
    """WITH days AS (SELECT DISTINCT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS id FROM orders)
    SELECT id + 1 AS time_id, CAST(DATE '2021-01-01' + CAST(id AS INT) AS DATE) AS order_date,
      CAST(month(DATE '2021-01-01' + CAST(id AS INT)) AS INT) AS month, CAST(quarter(DATE '2021-01-01' + CAST(id AS INT)) AS INT) AS quarter,
      CAST(year(DATE '2021-01-01' + CAST(id AS INT)) AS INT) AS year
    FROM days""",
)
def gen_dim_time(spark, d):
    days = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("bigint")
    return star.dim_time(load_tables(spark, d, "orders")[0].select(days.alias("id")).distinct())


@query(
    "gen_dim_product",
    """SELECT p_partkey + 1 AS product_id, 'Product_' || lpad(CAST(p_partkey + 1 AS VARCHAR), CAST(greatest(6, length(CAST(p_partkey + 1 AS VARCHAR))) AS INT), '0') AS product_name,
      ['Electronics', 'Grocery', 'Apparel', 'Home', 'Toys'][p_partkey % 5 + 1] AS product_line
    FROM part""",
)
def gen_dim_product(spark, d):
    return star.dim_product(load_tables(spark, d, "part")[0].select(F.col("p_partkey").alias("id"))).drop("unit_price")


def murmur_sql(seed: int, source: str, column: str, name: str, words: int) -> list[str]:
    """SQL columns that lead to ``name``, the 32-bit Murmur3 hash of a whole number of one or two 32-bit words; each may use those before it."""
    whole, steps, h = 1 << 32, [], str(seed)
    times = lambda x, by: f"CAST(CAST({x} AS HUGEINT) * {by} % {whole} AS BIGINT)"
    turned = lambda x, by: f"((({x}) << {by}) | (({x}) >> {32 - by})) & {whole - 1}"

    def step(expression: str) -> str:
        steps.append(f"{expression} AS {name}_{len(steps)}")
        return f"{name}_{len(steps) - 1}"

    for word in range(words):
        part = step(f"({column} >> {32 * word}) & {whole - 1}" if source == "column" else column)
        part = step(times(part, 0xCC9E2D51))
        part = step(times(step(turned(part, 15)), 0x1B873593))
        h = step(f"CAST(({times(step(turned(step(f'xor({h}, {part})'), 13)), 5)} + {0xE6546B64}) % {whole} AS BIGINT)")
    h = step(f"xor({h}, {4 * words})")
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = step(times(step(f"xor({h}, {h} >> {shift})"), factor))
    steps.append(f"xor({h}, {h} >> 16) AS {name}")
    return steps


def _fact_sql() -> str:
    """The generated facts, hashed in SQL: the id with seed 42, then each column's own seed on top."""
    columns = murmur_sql(42, "column", "id", "h", 2)
    domains = {"product_id": fv.N_PRODUCTS, "time_id": fv.N_DAYS, "promotion_id": fv.N_PROMOTIONS, "revenue": 1_000_000, "units_sold": 10}
    shown = []
    for name, seed in fv.FACT_HASH_SEEDS.items():
        columns += murmur_sql("h", "value", str(seed), f"h_{name}", 1)
        modulo = domains.get(name, "(SELECT COUNT(*) FROM customer)")
        value = f"abs(CASE WHEN h_{name} >= {1 << 31} THEN h_{name} - {1 << 32} ELSE h_{name} END) % {modulo}"
        shown.append(f"({value}) / 100.0::DOUBLE AS revenue" if name == "revenue" else f"CAST({value} + 1 AS {'INT' if name == 'units_sold' else 'BIGINT'}) AS {name}")
    return f"SELECT id + 1 AS transaction_id, {', '.join(shown)} FROM (SELECT id, {', '.join(columns)} FROM (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem))"


@query("gen_fact_sales", _fact_sql())
def gen_fact_sales(spark, d):
    """Generated facts for all lines' ids."""
    line, customer = load_tables(spark, d, "lineitem", "customer")
    facts = star.fact_sales(line.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")), customer.count())
    return facts.withColumn("revenue", F.col("revenue").cast("double"))


@query("table_detail", "SELECT CAST(17 AS BIGINT) AS num_files, COUNT(*) AS num_rows, TRUE AS has_bytes FROM lineitem")
def table_details(spark, d):
    """A table written as sixteen files and one file without rows."""
    line, path = load_tables(spark, d, "lineitem")[0], scratch_dir(spark, "lines")
    line.repartition(16).write.parquet(path)
    line.limit(0).coalesce(1).write.mode("append").parquet(path)
    detail = table_detail(spark.read.parquet(path))
    return detail.select("num_files", "num_rows", (F.col("size_in_bytes") > 0).alias("has_bytes"))


@query(
    "table_row_counts",
    """SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'part', COUNT(*) FROM part""",
)
def row_counts(spark, d):
    names = ("lineitem", "customer", "part", "orders")
    return table_row_counts(dict(zip(names, load_tables(spark, d, *names))))


# Sinks: write to a scratch table and give back what was stored.


@query("write_overwrite", ORDER_SQL)
def write_overwrite(spark, d):
    name, orders = f"{scratch_database(spark)}.orders", _order_lines(spark, d)
    tables.write_table(orders.where("total < 0"), name)
    tables.write_table(orders, name)
    return spark.table(name)


@query("write_overwrite_schema", "SELECT o_orderkey AS order_id, o_orderpriority AS priority FROM orders")
def write_overwrite_schema(spark, d):
    name, orders = f"{scratch_database(spark)}.orders", _order_lines(spark, d)
    tables.write_table(orders, name)
    # The new content is read from the table it replaces.
    tables.write_table(spark.table(name).select("order_id", "priority"), name, overwrite_schema=True)
    return spark.table(name)


@query("ctas_if_absent", ORDER_SQL)
def ctas_if_absent(spark, d):
    name, orders = f"{scratch_database(spark)}.orders", _order_lines(spark, d)
    tables.write_table(orders, name, mode="ignore")
    tables.write_table(orders.select("priority"), name, mode="ignore")
    return spark.table(name)


@query(
    "insert_into",
    """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total, o_orderpriority AS priority
    FROM orders UNION ALL SELECT o_orderkey, NULL, -o_totalprice, o_orderpriority FROM orders""",
)
def insert_into(spark, d):
    name, orders = f"{scratch_database(spark)}.orders", _order_lines(spark, d)
    tables.write_table(orders, name)
    tables.insert_rows(orders.select("priority", (-F.col("total")).alias("total"), "order_id"), name)
    return spark.table(name)


@query(
    "materialized_view",
    """SELECT o_orderpriority AS priority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderpriority""",
)
def materialized_view(spark, d):
    name, orders = f"{scratch_database(spark)}.by_priority", _order_lines(spark, d)

    def view():
        total = F.sum(F.col("total").cast("decimal(14,2)")).cast("double")
        return orders.groupBy("priority").agg(F.count("*").alias("n"), total.alias("total"))

    tables.refresh_view(spark, name, view)
    tables.refresh_view(spark, name, view)
    return spark.table(name)


@query(
    "published_versions",
    """SELECT 1 AS version, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) FROM orders""",
)
def published_versions(spark, d):
    """A reader that chose a version before the next was published, beside one that chose afterwards."""
    orders, table = load_tables(spark, d, "orders")[0], VersionedTable(spark, scratch_dir(spark, "orders"))
    is_done = F.col("o_orderstatus") == "F"
    table.publish(orders.where(is_done))
    pinned = table.read()
    table.publish(table.read().unionByName(orders.where(~is_done)))
    total = F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total")
    count = lambda rows, version: rows.agg(F.lit(version).alias("version"), F.count("*").alias("n"), total)
    return count(pinned, 1).union(count(table.read(), 2))


MONTHLY_SQL = """monthly AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_custkey AS customer,
    CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders)"""


def _monthly_view(spark, d):
    """Orders by month, taken in as four batches, the second of them twice."""
    orders = load_tables(spark, d, "orders")[0].select(
        F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.col("o_custkey").alias("customer"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
    )
    view = IncrementalView(
        spark, scratch_dir(spark, "by_month"), ["year", "month"], sums={"total": "price"}, counted="n", least={"smallest": "price"}, most={"largest": "price"},
        distinct={"customers": "customer"}, about_distinct={"customers_about": "customer"},
    )
    for batch in (0, 1, 1, 2, 3):
        view.refresh(orders.where(F.col("order_id") % 4 == batch), "orders", batch)
    return view


@query(
    "incremental_view",
    MONTHLY_SQL,
    """SELECT year, month, COUNT(*) AS n, CAST(SUM(price) AS DOUBLE) AS total, CAST(MIN(price) AS DOUBLE) AS smallest,
      CAST(MAX(price) AS DOUBLE) AS largest, COUNT(DISTINCT customer) AS customers FROM monthly GROUP BY year, month""",
)
def incremental_view(spark, d):
    """Monthly totals and exact distinct customers, refreshed batch by batch without reading earlier rows."""
    doubles = {c: F.col(c).cast("double") for c in ("total", "smallest", "largest")}
    return _monthly_view(spark, d).current().drop("customers_about", "customers_about_error").withColumns(doubles)


@query(
    "distinct_rollup",
    MONTHLY_SQL,
    """SELECT year, COUNT(DISTINCT customer) AS customers, TRUE AS within_three_errors, CAST(0.01625 AS DOUBLE) AS standard_error
    FROM monthly GROUP BY year""",
)
def distinct_rollup(spark, d):
    """Yearly distinct customers from monthly sketches, beside the exact count from the monthly state; no order is read again."""
    yearly = _monthly_view(spark, d).rolled_up(["year"])
    error = F.col("customers_about_error")
    within = F.abs(F.col("customers_about") - F.col("customers")) <= 3 * error * F.col("customers") + 1
    return yearly.select("year", "customers", within.alias("within_three_errors"), F.round(error, 5).alias("standard_error"))


def write_chunks(store: VersionedTable, result: DataFrame, key: str, rows_per_chunk: int = 100_000, least: int = 8) -> int:
    """``result`` as a statement service sends it: chunk files of a bounded number of rows and their manifest. Returns the number of chunks.

    There are more chunks where there are more rows, as a chunk is read by one task. One job writes them all, each by one task.
    """
    n = max(least, math.ceil(result.count() / rows_per_chunk))
    row = F.array(*[F.col(c).cast("string") for c in result.columns])
    rows = result.select(F.pmod(F.xxhash64(key), F.lit(n)).alias("chunk"), F.to_json(row, {"ignoreNullFields": "false"}).alias("row"))
    in_chunk = Window.partitionBy("chunk").orderBy("row")
    begin = F.when(F.lag("row").over(in_chunk).isNull(), "[").otherwise(",")
    end = F.when(F.lead("row").over(in_chunk).isNull(), "]").otherwise("")
    lines = rows.repartition(n, "chunk").select("chunk", "row", F.concat(begin, "row", end).alias("line"))
    lines.sortWithinPartitions("chunk", "row").select("chunk", "line").write.partitionBy("chunk").text(f"{store.path}/chunks")
    counts = {r.chunk: r.n for r in rows.groupBy("chunk").agg(F.count("*").alias("n")).collect()}
    files = {}
    for file in result.sparkSession.read.text(f"{store.path}/chunks").inputFiles():
        folder, name = file.rsplit("/", 2)[1:]
        files[int(folder.removeprefix("chunk="))] = f"chunks/{folder}/{name}"
    manifest = {
        "columns": [{"name": f.name, "type": f.dataType.simpleString()} for f in result.schema],
        "chunks": [{"file": files[k], "row_count": rows_in} for k, rows_in in sorted(counts.items())],
    }
    store.write_text("manifest.json", json.dumps(manifest))
    return len(counts)


@query("statement_chunks", ORDER_SQL)
def statement_chunks(spark, d):
    """A statement's result in chunk files, eight at least, read by a task each."""
    path = scratch_dir(spark, "result")
    write_chunks(VersionedTable(spark, path), _order_lines(spark, d), "order_id")
    return read_chunks(spark, path)


@query(
    "export_csv_single",
    """SELECT n_name AS nation, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def export_csv_single(spark, d):
    customer, nation = load_tables(spark, d, "customer", "nation")
    per_nation = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"))
        .agg(F.count("*").alias("customers"))
    )
    path = scratch_dir(spark, "export")
    tables.export_csv(per_nation, path)
    return files.scan_csv(spark, path, "nation string, customers bigint")


@query("clustered_write", ORDER_SQL)
def clustered_write(spark, d):
    path = scratch_dir(spark, "clustered")
    tables.clustered_write(_order_lines(spark, d), path, ["priority"], 16)
    return spark.read.parquet(path)


@query(
    "files_to_read",
    """SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (o_orderpriority = '2-HIGH') AS found, CAST(16 AS BIGINT) AS plain_opened,
      TRUE AS clustered_opens_under_half FROM orders""",
)
def files_to_read(spark, d):
    """Files an equality filter opens, for the same rows written plainly and clustered."""
    orders = _order_lines(spark, d)
    plain, clustered = scratch_dir(spark, "plain"), scratch_dir(spark, "clustered")
    orders.repartition(16).write.parquet(plain)
    tables.clustered_write(orders, clustered, ["priority"], 16)
    rows = spark.read.parquet(clustered)
    counts = rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("priority") == "2-HIGH").alias("found"))
    opened = [tables.files_to_read(spark.read.parquet(p), "priority", "2-HIGH").select("files_to_read").scalar() for p in (plain, clustered)]
    return counts.select("n_rows", "found", opened[0].alias("plain_opened"), (opened[1] * 2 < opened[0]).alias("clustered_opens_under_half"))


@query(
    "zone_skipping",
    """SELECT COUNT(*) AS n_rows, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total, CAST(5 AS BIGINT) AS files, TRUE AS at_most_two_opened
    FROM orders WHERE o_orderpriority = '2-HIGH'""",
)
def zone_skipping(spark, d):
    """An equality filter that opens one or two of five clustered files, as the files' own ranges and Bloom bits say."""
    path = scratch_dir(spark, "zoned")
    write_zoned(_order_lines(spark, d), path, ["priority"], 5)
    table = ZonedTable(spark, path)
    found = table.read(priority="2-HIGH")
    total = F.sum(F.col("total").cast("decimal(14,2)")).cast("double").alias("total")
    return found.agg(
        F.count("*").alias("n_rows"), total, F.lit(table.files().count()).alias("files"), F.lit(len(found.inputFiles()) <= 2).alias("at_most_two_opened")
    )


@query(
    "zone_join",
    """SELECT c_custkey AS customer_id, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 3 AND c_acctbal > 8500 GROUP BY c_custkey""",
)
def zone_join(spark, d):
    """A join that reads of the orders only files which can hold one of the customers, although they are not partitioned by them."""
    orders, customer = load_tables(spark, d, "orders", "customer")
    path = scratch_dir(spark, "zoned")
    write_zoned(orders, path, ["o_custkey"], 32)
    few = customer.where("c_nationkey = 3 AND c_acctbal > 8500").select("c_custkey")
    read = ZonedTable(spark, path).read_for(few, "o_custkey", "c_custkey")
    total = F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total")
    return read.join(few, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_custkey").alias("customer_id")).agg(F.count("*").alias("n"), total)


@query(
    "statistics_choose_join",
    """SELECT COUNT(*) AS n_rows, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS total, 'SortMergeJoin' AS before_statistics,
      'BroadcastHashJoin' AS with_statistics FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 490000""",
)
def statistics_choose_join(spark, d):
    """Dear orders' lines: stored histograms tell the optimizer that few orders pass the filter, so it broadcasts them."""
    orders, line = load_tables(spark, d, "orders", "lineitem")
    database = scratch_database(spark)
    orders.write.saveAsTable(f"{database}.orders")
    line.write.saveAsTable(f"{database}.lines")
    size = spark.table(f"{database}.orders")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()

    def joined():
        return spark.table(f"{database}.lines").join(spark.table(f"{database}.orders").where("o_totalprice > 490000"), F.expr("l_orderkey = o_orderkey"))

    with tables.settings(spark, {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": str(size // 4)}):
        before = tables.planned_joins(joined())
        for name in ("orders", "lines"):
            tables.analyze_table(spark, f"{database}.{name}", histograms=True)
        after = tables.planned_joins(joined())
    total = F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double").alias("total")
    return joined().agg(F.count("*").alias("n_rows"), total, F.lit(before[0]).alias("before_statistics"), F.lit(after[0]).alias("with_statistics"))


@query(
    "sketch_quantiles",
    """SELECT o_orderpriority AS priority, p AS probability, COUNT(*) AS n, TRUE AS rank_is_near FROM orders, (VALUES (0.25::DOUBLE), (0.5), (0.99)) AS t(p)
    GROUP BY o_orderpriority, p""",
)
def sketch_quantiles(spark, d):
    """Quantiles of order totals by priority from sketches, and whether their exact rank is within two percent of what was asked."""
    orders = _order_lines(spark, d)
    asked = tables.quantiles(orders, "total", [0.25, 0.5, 0.99], ["priority"])
    per = orders.join(asked, "priority").groupBy("priority", "probability").agg(F.count("*").alias("n"), F.count_if(F.col("total") <= F.col("value")).alias("upto"))
    near = F.abs(F.col("upto") / F.col("n") - F.col("probability")) <= 0.02 + 1 / F.col("n")
    return per.select("priority", "probability", "n", near.alias("rank_is_near"))


@query(
    "analyze_columns",
    """SELECT 'c_custkey' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(c_custkey) AS n_nulls,
      COUNT(DISTINCT c_custkey) AS n_distinct, CAST(MIN(c_custkey) AS VARCHAR) AS min_value,
      CAST(MAX(c_custkey) AS VARCHAR) AS max_value FROM customer
    UNION ALL SELECT 'c_name', COUNT(*), COUNT(*) - COUNT(c_name), COUNT(DISTINCT c_name), MIN(c_name), MAX(c_name) FROM customer
    UNION ALL SELECT 'c_mktsegment', COUNT(*), COUNT(*) - COUNT(c_mktsegment), COUNT(DISTINCT c_mktsegment),
      MIN(c_mktsegment), MAX(c_mktsegment) FROM customer
    UNION ALL SELECT 'c_nationkey', COUNT(*), COUNT(*) - COUNT(c_nationkey), COUNT(DISTINCT c_nationkey),
      CAST(MIN(c_nationkey) AS VARCHAR), CAST(MAX(c_nationkey) AS VARCHAR) FROM customer
    UNION ALL SELECT 'cents', COUNT(*), COUNT(*) - COUNT(c_acctbal), COUNT(DISTINCT round(c_acctbal * 100)),
      CAST(CAST(MIN(round(c_acctbal * 100)) AS BIGINT) AS VARCHAR), CAST(CAST(MAX(round(c_acctbal * 100)) AS BIGINT) AS VARCHAR) FROM customer""",
)
def analyze_columns(spark, d):
    """All columns of a table; the balance in cents, since texts of floating point numbers differ between engines."""
    customer = load_tables(spark, d, "customer")[0]
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents")
    return aggregates.column_stats(customer.select("c_custkey", "c_name", "c_nationkey", cents, "c_mktsegment"), exact=True)


@query(
    "union_all",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def union_all(spark, d):
    customer, supplier = load_tables(spark, d, "customer", "supplier")
    named = customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return named.union(supplier.select("s_name", "s_nationkey"))


@query(
    "scalar_functions",
    """SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(4, length(CAST(o_orderkey AS VARCHAR))) AS INT), '0') AS padded,
      strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
      CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(o_orderdate AS DATE) - 730 AS two_years_before,
      replace(o_orderpriority, ' ', '') AS priority,
      format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole_price,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS customer
    FROM orders""",
)
def scalar_functions(spark, d):
    return load_tables(spark, d, "orders")[0].select(
        "o_orderkey",
        padded("o_orderkey", 4).alias("padded"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.date_trunc("MONTH", "o_orderdate").cast("date").alias("month_start"),
        F.quarter("o_orderdate").alias("quarter"),
        F.date_sub("o_orderdate", 730).alias("two_years_before"),
        F.replace("o_orderpriority", F.lit(" "), F.lit("")).alias("priority"),
        group_digits(F.floor("o_totalprice")).alias("whole_price"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_custkey").cast("string")).try_cast("double").alias("customer"),
    )


@query(
    "multi_flow_append",
    dt.TRANSACTIONS_SQL,
    "SELECT user_id, product_id, quantity, CAST(transaction_price AS DOUBLE) AS transaction_price, area FROM transactions",
)
def multi_flow_append(spark, d):
    lines = dt.transactions(spark, d)
    schema = lines.schema
    streams = {}
    for flow, area in (("east", "O"), ("west", "F")):
        path = land_csv(spark, lines.where(F.col("area") == area), flow)
        streams[flow] = files.CsvFiles(spark, path, schema, "_rescued")
    target, checkpoints = scratch_dir(spark, "transactions"), scratch_dir(spark, "checkpoints")
    flows.append_flows(target, {"east": streams["east"]}, checkpoints)
    flows.append_flows(target, streams, checkpoints)  # the first flow has nothing new
    stored = flows.read_flows(spark, target).drop("_rescued")
    return stored.withColumn("transaction_price", F.col("transaction_price").cast("double"))
