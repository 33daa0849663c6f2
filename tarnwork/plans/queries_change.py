"""Change feeds, merges, schema changes, quality rules, governance and the whole pipeline."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import equals_value, mask_constant, mask_email
from tarnwork.operators import cdc, govern, joins, merge, quality, tables
from tarnwork.operators.versions import KeyedTable
from tarnwork.plans import driver_tables as dt
from tarnwork.plans.queries_tables import land_csv
from tarnwork.plans.registry import query
from tarnwork.session import scratch_database, scratch_dir
from tarnwork.sources.files import CsvFiles, stream_csv
from tarnwork.sources.tables import load_tables, table_schema
from tarnwork.streaming import flows
from tarnwork.streaming.medallion import Pipeline, bronze, gold_views, medallion_run, pipeline_from_conf, split_by_flag

KEYS, SEQUENCE = ["user_id"], ["last_updated", "event_id"]

NEWEST_SQL = """newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_updated DESC, event_id DESC) AS rn FROM feed)
  WHERE rn = 1)"""
CURRENT_SQL = "SELECT user_id, age, region, last_updated, event_id FROM newest WHERE operation <> 'DELETE'"


@query("cdc_scd1", dt.FEED_SQL, NEWEST_SQL, CURRENT_SQL)
def cdc_scd1(spark, d):
    changes = cdc.latest_changes(dt.feed(spark, d), KEYS, SEQUENCE, "operation = 'DELETE'", ["operation"])
    return cdc.current_rows(changes)


@query("cdc_tombstones", dt.FEED_SQL, NEWEST_SQL, CURRENT_SQL)
def cdc_tombstones(spark, d):
    """Later changes first: the state must not let the earlier ones undo them."""
    feed = dt.feed(spark, d)
    late = F.col("last_updated") >= F.lit("2024-01-15").cast("timestamp_ntz")
    how = (KEYS, SEQUENCE, "operation = 'DELETE'", ["operation"])
    state = cdc.apply_changes(None, feed.where(late), *how)
    return cdc.current_rows(cdc.apply_changes(state, feed.where(~late), *how))


@query("keyed_table", dt.FEED_SQL, NEWEST_SQL, CURRENT_SQL)
def keyed_table(spark, d):
    """A stored table that takes in the newest changes first, then older ones, then the first again; each run rewrites buckets it has keys of."""
    feed, table = dt.feed(spark, d), KeyedTable(spark, scratch_dir(spark, "users"), KEYS, SEQUENCE, 8)
    late = F.col("last_updated") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for batch, part in enumerate((feed.where(late), feed.where(~late), feed.where(late))):
        table.take(part, "operation = 'DELETE'", ["operation"], "feed", batch)
    return table.current()


@query("cdc_backfill_once", dt.FEED_SQL, NEWEST_SQL, CURRENT_SQL)
def cdc_backfill_once(spark, d):
    """A stream of the feed's deletes and a backfill with the other changes, into one table."""
    feed = dt.feed(spark, d)
    is_delete = F.col("operation") == "DELETE"
    target, checkpoints = scratch_dir(spark, "users"), scratch_dir(spark, "checkpoints")
    for flow, part in (("deletes", feed.where(is_delete)), ("backfill", feed.where(~is_delete))):
        stream = CsvFiles(spark, land_csv(spark, part, flow), feed.schema, "_rescued")
        for _ in range(2):  # the second time there is nothing to do
            started = flows.cdc_flow(
                stream, target, flow, f"{checkpoints}/{flow}", KEYS, SEQUENCE, "operation = 'DELETE'", ["operation", "_rescued"], once=True
            )
            if started:
                flows.finish([started])
                flows.mark_finished(spark, f"{checkpoints}/{flow}")
    return cdc.current_rows(flows.read_changes(spark, target, KEYS, SEQUENCE))


@query("cdc_backfill_resumed", dt.FEED_SQL, NEWEST_SQL, CURRENT_SQL)
def cdc_backfill_resumed(spark, d):
    """A backfill in several batches whose second one fails; the next run takes in what is missing."""
    feed = dt.feed(spark, d)
    path, target, checkpoint = land_csv(spark, feed.repartition(4), "backfill"), scratch_dir(spark, "users"), scratch_dir(spark, "checkpoint")
    reduce = lambda df: cdc.latest_changes(df, KEYS, SEQUENCE, "operation = 'DELETE'", ["operation"])
    whole = flows.batch_writer(target, "backfill", reduce)

    def breaks(batch, batch_id):
        if batch_id:
            raise OSError("no more")
        whole(batch, batch_id)

    def stream():
        return stream_csv(spark, path, feed.schema, "_rescued", max_bytes=1).drop("_rescued")

    try:
        flows.finish([flows.start(stream(), breaks, checkpoint, "backfill")])
    except StreamingQueryException:
        pass
    how = (target, "backfill", checkpoint, KEYS, SEQUENCE, "operation = 'DELETE'", ["operation"])
    flows.finish([flows.cdc_flow(stream(), *how, once=True)])
    flows.mark_finished(spark, checkpoint)
    return cdc.current_rows(flows.read_changes(spark, target, KEYS, SEQUENCE))


@query(
    "stream_rule_counts",
    dt.TRANSACTIONS_SQL,
    """counted AS (SELECT COUNT(*) AS a, COUNT(*) FILTER (NOT COALESCE(quantity >= 1, FALSE)) AS b,
      COUNT(*) FILTER (NOT COALESCE(transaction_price > 0, FALSE)) AS c FROM transactions)""",
    """SELECT 'all' AS flow, 'n_rows' AS name, a AS n FROM counted UNION ALL SELECT 'all', 'quantity_is_more_than_1', b FROM counted
    UNION ALL SELECT 'all', 'transaction_price_is_more_than_0', c FROM counted""",
)
def stream_rule_counts(spark, d):
    """Violations per rule over more micro-batches than a stream's progress keeps."""
    lines = dt.transactions(spark, d).select("quantity", "transaction_price")
    path, target = scratch_dir(spark, "lines"), scratch_dir(spark, "stored")
    lines.repartition(104).write.parquet(path)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(path)
    flows.append_flows(target, {"all": stream}, scratch_dir(spark, "checkpoints"), rules=fv.TRANSACTION_RULES)
    return flows.rule_counts(spark, target)


MERGED_SQL = """updates AS (SELECT s_suppkey AS id, 'supplier' AS segment, s_nationkey AS nation FROM supplier
    UNION ALL SELECT -1 - s_suppkey, 'new', s_nationkey FROM supplier),
  base AS (SELECT c_custkey AS id, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer)"""


def _merge_sides(spark, d):
    customer, supplier = load_tables(spark, d, "customer", "supplier")
    base = customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
    )
    key, nation = F.col("s_suppkey"), F.col("s_nationkey").alias("nation")
    updates = supplier.select(key.alias("id"), F.lit("supplier").alias("segment"), nation)
    inserts = supplier.select((-1 - key).alias("id"), F.lit("new").alias("segment"), nation)
    return base, updates.union(inserts)


@query(
    "merge_upsert",
    MERGED_SQL,
    """SELECT COALESCE(b.id, u.id) AS id, COALESCE(u.segment, b.segment) AS segment, CAST(b.balance AS DOUBLE) AS balance
    FROM base b FULL JOIN updates u ON b.id = u.id""",
)
def merge_upsert(spark, d):
    base, updates = _merge_sides(spark, d)
    merged = merge.merge_upsert(base, updates.drop("nation"), ["id"])
    return merged.withColumn("balance", F.col("balance").cast("double"))


@query(
    "merge_schema_evolution",
    MERGED_SQL,
    """SELECT COALESCE(b.id, u.id) AS id, COALESCE(u.segment, b.segment) AS segment, CAST(b.balance AS DOUBLE) AS balance, u.nation
    FROM base b FULL JOIN updates u ON b.id = u.id""",
)
def merge_schema_evolution(spark, d):
    merged = merge.merge_upsert(*_merge_sides(spark, d), ["id"], evolve=True)
    return merged.withColumn("balance", F.col("balance").cast("double"))


@query(
    "merge_large_source",
    MERGED_SQL,
    """SELECT COALESCE(b.id, u.id) AS id, COALESCE(u.segment, b.segment) AS segment, CAST(b.balance AS DOUBLE) AS balance, u.nation
    FROM base b FULL JOIN updates u ON b.id = u.id""",
)
def merge_large_source(spark, d):
    merged = merge.merge_upsert(*_merge_sides(spark, d), ["id"], evolve=True, large_source=True)
    return merged.withColumn("balance", F.col("balance").cast("double"))


@query(
    "merge_into_partitions",
    """SELECT c_custkey AS id, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END AS DOUBLE) AS balance,
      c_mktsegment AS segment FROM customer
    UNION ALL SELECT -1 - c_custkey, 1, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def merge_into_partitions(spark, d):
    """One of five partitions gets updates and inserts; the others keep their files."""
    segment, key = F.col("c_mktsegment").alias("segment"), F.col("c_custkey")
    customer = load_tables(spark, d, "customer")[0]
    name = f"{scratch_database(spark)}.customers"
    stored = customer.select(key.alias("id"), F.col("c_acctbal").alias("balance"), segment)
    stored.write.partitionBy("segment").saveAsTable(name)
    building = customer.where("c_mktsegment = 'BUILDING'")
    updates = building.select(key.alias("id"), F.lit(0.0).alias("balance"), segment)
    inserts = building.select((-1 - key).alias("id"), F.lit(1.0).alias("balance"), segment)
    tables.merge_into(updates.union(inserts), name, ["id", "segment"])
    return spark.table(name)


@query("add_columns_to_table", "SELECT *, CAST(NULL AS VARCHAR) AS campaign FROM supplier")
def add_columns_to_table(spark, d):
    name = f"{scratch_database(spark)}.suppliers"
    tables.write_table(load_tables(spark, d, "supplier")[0], name)
    tables.add_columns(spark, name, {"campaign": "string"})
    return spark.table(name)


@query(
    "enforce_schema",
    "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS INT) AS nation, s_acctbal AS balance FROM supplier",
)
def enforce_schema(spark, d):
    schema = T.StructType.fromDDL("id bigint, name string, nation int, balance double")
    supplier = load_tables(spark, d, "supplier")[0]
    given = supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"))
    return merge.enforce_schema(given, schema)


@query(
    "enforce_refusals",
    """SELECT change, refused, times * (SELECT COUNT(*) FROM orders) AS row_count, days * (SELECT COUNT(o_orderdate) FROM orders) AS day_count
    FROM (VALUES ('unknown column', TRUE, 1, 1), ('text for a number', TRUE, 1, 1), ('text for a date', TRUE, 1, 1), ('whole number for a decimal', FALSE, 2, 2),
      ('missing column', FALSE, 3, 2), ('narrowing', TRUE, 3, 2), ('drop without name mapping', TRUE, 3, 2)) AS t(change, refused, times, days)""",
)
def enforce_refusals(spark, d):
    """Writes of all orders into a table of orders, one after the other: which are refused, and what the table then holds."""
    orders = load_tables(spark, d, "orders")[0].select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(22,2)").alias("total"), F.col("o_orderdate").cast("date").alias("day")
    )
    text = lambda c: orders.withColumn(c, F.col(c).cast("string"))
    name = f"{scratch_database(spark)}.orders"
    tables.write_table(orders, name)
    insert = lambda df: tables.insert_rows(merge.enforce_schema(df, orders.schema), name)
    replace = lambda **change: tables.replace_table(merge.evolve(spark.table(name), **change), name)
    tries = {
        "unknown column": lambda: insert(orders.withColumn("campaign", F.lit("x"))),
        "text for a number": lambda: insert(text("total")),
        "text for a date": lambda: insert(text("day")),
        "whole number for a decimal": lambda: insert(orders.withColumn("total", F.col("id"))),
        "missing column": lambda: insert(orders.drop("day")),
        "narrowing": lambda: replace(widen={"id": "int"}, type_widening=True),
        "drop without name mapping": lambda: replace(drop=["day"]),
    }

    def refused(change) -> bool:
        try:
            change()
        except merge.SchemaError:
            return True
        return False

    rows = [(change, refused(attempt), *spark.table(name).agg(F.count("*"), F.count("day")).first()) for change, attempt in tries.items()]
    return spark.createDataFrame(rows, "change string, refused boolean, row_count bigint, day_count bigint")


@query(
    "insert_new_column",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL::VARCHAR AS campaign FROM supplier
    UNION ALL SELECT -1 - s_suppkey, NULL, NULL, NULL, 'spring' FROM supplier""",
)
def insert_new_column(spark, d):
    """A column is added to the table, then rows that have it are inserted by name."""
    name, supplier = f"{scratch_database(spark)}.suppliers", load_tables(spark, d, "supplier")[0]
    tables.write_table(supplier, name)
    tables.add_columns(spark, name, {"campaign": "string"})
    tables.insert_rows(supplier.select(F.lit("spring").alias("campaign"), (-1 - F.col("s_suppkey")).alias("s_suppkey")), name)
    return spark.table(name)


@query(
    "overwrite_keeps_layout",
    """SELECT * FROM (VALUES ('s_suppkey', 'bigint', 'the key', FALSE), ('s_name', 'string', NULL, FALSE), ('s_acctbal', 'double', NULL, FALSE),
      ('s_nationkey', 'int', NULL, TRUE), ('(table)', 'suppliers by nation', 'retention=30', NULL)) AS t(name, data_type, comment, is_partition)""",
)
def overwrite_keeps_layout(spark, d):
    """What is left of columns, comments, partitioning and properties after the content is replaced twice."""
    name, supplier = f"{scratch_database(spark)}.suppliers", load_tables(spark, d, "supplier")[0]
    supplier.write.partitionBy("s_nationkey").saveAsTable(name)
    tables.annotate_table(spark, name, "suppliers by nation", {"s_suppkey": "the key"})
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('retention' = '30')")
    tables.write_table(supplier.where("s_acctbal > 0"), name)
    tables.write_table(spark.table(name), name)
    columns = [(c.name, c.dataType, c.description, c.isPartition) for c in spark.catalog.listColumns(name)]
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    table = ("(table)", spark.catalog.getTable(name).description, f"retention={kept.get('retention')}", None)
    return spark.createDataFrame([*columns, table], "name string, data_type string, comment string, is_partition boolean")


@query(
    "annotate",
    """SELECT * FROM (VALUES (0, 's_suppkey', 'bigint', 'the key'), (1, 's_name', 'string', NULL), (2, 's_nationkey', 'int', 'where it is'),
      (3, 's_acctbal', 'double', NULL)) AS t(position, column_name, data_type, comment)""",
)
def annotate(spark, d):
    """Column comments set on a frame, read back from the table saved from it."""
    name = f"{scratch_database(spark)}.suppliers"
    comments = {"s_suppkey": "the key", "s_nationkey": "where it is"}
    tables.write_table(tables.annotate(load_tables(spark, d, "supplier")[0], comments), name)
    return table_schema(spark, spark.table(name))


@query(
    "table_schema",
    """SELECT * FROM (VALUES (0, 'event_id', 'bigint', NULL), (1, 'ts', 'timestamp_ntz', NULL), (2, 'user_id', 'bigint', NULL),
      (3, 'event_type', 'string', NULL), (4, 'value', 'double', NULL), (5, 'props', 'string', NULL)) AS t(position, column_name, data_type, comment)""",
)
def table_schema_query(spark, d):
    return table_schema(spark, load_tables(spark, d, "events")[0])


@query("add_columns", "SELECT *, CAST(NULL AS VARCHAR) AS campaign FROM supplier")
def add_columns(spark, d):
    return merge.evolve(load_tables(spark, d, "supplier")[0], add={"campaign": "string"})


@query("drop_column", "SELECT * EXCLUDE (s_name) FROM supplier")
def drop_column(spark, d):
    return merge.evolve(load_tables(spark, d, "supplier")[0], drop=["s_name"], name_mapping=True)


@query("rename_column", "SELECT * RENAME (s_name AS shop) FROM supplier")
def rename_column(spark, d):
    return merge.evolve(load_tables(spark, d, "supplier")[0], rename={"s_name": "shop"}, name_mapping=True)


@query("widen_type", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def widen_type(spark, d):
    return merge.evolve(load_tables(spark, d, "supplier")[0], widen={"s_nationkey": "bigint"}, type_widening=True)


@query(
    "key_check",
    """WITH k AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL)
    SELECT CAST(SUM(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_key_rows,
      COUNT(*) FILTER (n > 1) AS repeated_keys, CAST(SUM(n - 1) AS BIGINT) AS surplus_rows FROM k""",
)
def key_check(spark, d):
    return quality.key_check(load_tables(spark, d, "lineitem")[0], ["l_orderkey", "l_linenumber"])


@query(
    "not_null_constraint",
    dt.TRANSACTIONS_SQL,
    """SELECT COUNT(*) FILTER (user_id IS NULL) AS user_id, COUNT(*) FILTER (quantity IS NULL) AS quantity FROM transactions""",
)
def not_null_constraint(spark, d):
    return quality.null_counts(dt.transactions(spark, d), ["user_id", "quantity"])


# Quality rules

LINE_SQL = "user_id, product_id, quantity, CAST(transaction_price AS DOUBLE) AS price"


def _lines(df):
    return df.select("user_id", "product_id", "quantity", F.col("transaction_price").cast("double").alias("price"))


@query("expect_all", dt.TRANSACTIONS_SQL, f"SELECT {LINE_SQL} FROM transactions")
def expect_all(spark, d):
    return _lines(quality.expect(dt.transactions(spark, d), fv.TRANSACTION_RULES, "warn"))


@query(
    "expect_all_or_drop",
    dt.TRANSACTIONS_SQL,
    f"SELECT {LINE_SQL} FROM transactions WHERE quantity >= 1 AND transaction_price > 0",
)
def expect_all_or_drop(spark, d):
    return _lines(quality.expect(dt.transactions(spark, d), fv.TRANSACTION_RULES, "drop"))


@query("expect_all_or_fail", "SELECT l_orderkey, l_quantity FROM lineitem")
def expect_all_or_fail(spark, d):
    line = load_tables(spark, d, "lineitem")[0].select("l_orderkey", "l_quantity")
    return quality.expect(line, {"some": "l_quantity >= 1", "keyed": "l_orderkey IS NOT NULL"}, "fail")


@query(
    "quarantine_split",
    dt.TRANSACTIONS_SQL,
    f"""SELECT {LINE_SQL}, CASE WHEN quantity >= 1 AND transaction_price > 0 THEN 'valid' ELSE 'invalid' END AS part
    FROM transactions""",
)
def quarantine_split(spark, d):
    valid, invalid = quality.quarantine_stored(dt.transactions(spark, d), fv.TRANSACTION_RULES)
    return _lines(valid).withColumn("part", F.lit("valid")).union(_lines(invalid).withColumn("part", F.lit("invalid")))


@query(
    "quarantine_split_unknown_dropped",
    dt.TRANSACTIONS_SQL,
    f"""SELECT {LINE_SQL}, CASE WHEN quantity >= 1 AND transaction_price > 0 THEN 'valid' ELSE 'invalid' END AS part
    FROM transactions WHERE (quantity >= 1 AND transaction_price > 0) IS NOT NULL""",
)
def quarantine_split_unknown_dropped(spark, d):
    valid, invalid = quality.quarantine_stored(dt.transactions(spark, d), fv.TRANSACTION_RULES, null_as="drop")
    return _lines(valid).withColumn("part", F.lit("valid")).union(_lines(invalid).withColumn("part", F.lit("invalid")))


@query(
    "dq_report",
    dt.TRANSACTIONS_SQL,
    """SELECT 'quantity_is_more_than_1' AS rule, COUNT(*) FILTER (quantity >= 1) AS passed,
      COUNT(*) FILTER (NOT quantity >= 1) AS failed, COUNT(*) FILTER ((quantity >= 1) IS NULL) AS unknown FROM transactions
    UNION ALL SELECT 'transaction_price_is_more_than_0', COUNT(*) FILTER (transaction_price > 0),
      COUNT(*) FILTER (NOT transaction_price > 0), COUNT(*) FILTER ((transaction_price > 0) IS NULL) FROM transactions""",
)
def dq_report(spark, d):
    return quality.dq_report(dt.transactions(spark, d), fv.TRANSACTION_RULES)


# Governance


@query(
    "mask_email",
    dt.STAFF_SQL,
    """SELECT employee_id, left(email, 1) || repeat('*', strpos(email, '@') - 3) || substr(email, strpos(email, '@') - 1) AS email
    FROM staff""",
)
def mask_email_query(spark, d):
    return dt.staff(spark, d).select("employee_id", mask_email("email").alias("email"))


@query("mask_constant", dt.STAFF_SQL, "SELECT employee_id, -99.99::DOUBLE AS salary FROM staff")
def mask_constant_query(spark, d):
    return dt.staff(spark, d).select("employee_id", mask_constant().alias("salary"))


@query("row_filter", dt.STAFF_SQL, "SELECT employee_id, region = 'ASIA' AS visible FROM staff")
def row_filter(spark, d):
    return dt.staff(spark, d).select("employee_id", equals_value("region", "ASIA").alias("visible"))


@query(
    "sql_functions",
    dt.STAFF_SQL,
    """SELECT employee_id, left(email, 1) || repeat('*', strpos(email, '@') - 3) || substr(email, strpos(email, '@') - 1) AS email,
      -99.99::DOUBLE AS salary, region = 'APAC' AS visible FROM staff""",
)
def sql_functions(spark, d):
    govern.register_functions(spark)
    dt.staff(spark, d).createOrReplaceTempView("staff")
    return spark.sql(
        "SELECT employee_id, mask_email(email) AS email, mask_salary(salary) AS salary, is_apac_region(region) AS visible FROM staff"
    )


@query(
    "apply_policies",
    dt.STAFF_SQL,
    """SELECT employee_id, name, left(email, 1) || repeat('*', strpos(email, '@') - 3) || substr(email, strpos(email, '@') - 1) AS email,
      department, -99.99::DOUBLE AS salary, region FROM staff WHERE region = 'ASIA'""",
)
def apply_policies(spark, d):
    tags = {"email": "pii_email", "salary": "salary", "region": "region_asia"}
    tagged = govern.tag_columns(dt.staff(spark, d), {c: {fv.TAG_KEY: t} for c, t in tags.items()})
    asia = govern.Policy("filter", (fv.TAG_KEY, "region_asia"), lambda c: equals_value(c, "ASIA"), frozenset({"auditors"}))
    return govern.apply_policies(tagged, [*govern.EMPLOYEE_POLICIES, asia], groups=["analysts"])


# The pipeline from files to gold tables

PIPELINE_USERS_SQL = """users_now AS (SELECT user_id, age, 'F' AS gender, region FROM newest WHERE operation <> 'DELETE')"""
PIPELINE_SQL = (
    dt.FEED_SQL,
    NEWEST_SQL,
    PIPELINE_USERS_SQL,
    dt.PRODUCTS_SQL,
    """events_bought AS (SELECT user_id, event_id % (SELECT COUNT(*) FROM part) AS product_id,
      CAST(floor(value / 10) AS INT) AS quantity, CAST(value AS DECIMAL(14,2)) AS transaction_price
      FROM events)""",
)


def pipeline(spark, d, **options) -> Pipeline:
    """Every event is a purchase; the same events are the users' change feed."""
    events, part = load_tables(spark, d, "events", "part")
    bought = events.select(
        "user_id",
        F.pmod("event_id", F.lit(part.count())).alias("product_id"),
        F.floor(F.col("value") / 10).cast("int").alias("quantity"),
        F.col("value").cast("decimal(14,2)").alias("transaction_price"),
        "event_type",
    )
    feed = dt.feed(spark, d).drop("event_id").withColumn("gender", F.lit("F"))
    is_east = F.col("event_type").isin("click", "view")
    lines = bought.drop("event_type")
    east = land_csv(spark, bought.where(is_east).drop("event_type"), "east")
    west = land_csv(spark, bought.where(~is_east).drop("event_type"), "west")
    return Pipeline(
        root=scratch_dir(spark, "pipeline"),
        transactions={"east": east, "west": west},
        transaction_schema=lines.schema,
        users=land_csv(spark, feed, "users"),
        user_schema=feed.schema,
        products=dt.products(spark, d),
        **options,
    )


@query(
    "medallion_run",
    *PIPELINE_SQL,
    """SELECT CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group, gender, region,
      CAST(SUM(transaction_price) AS DOUBLE) AS sum_revenue
    FROM events_bought b LEFT JOIN users_now u ON b.user_id = u.user_id WHERE quantity >= 1 AND transaction_price > 0
    GROUP BY 1, 2, 3""",
)
def medallion(spark, d):
    p = pipeline(spark, d, rules=fv.TRANSACTION_RULES)
    medallion_run(spark, p)
    revenue = gold_views(spark, p)["revenue_by_user_segment"].current()
    return revenue.withColumn("sum_revenue", F.col("sum_revenue").cast("double"))


@query(
    "stream_static_left",
    *PIPELINE_SQL,
    """SELECT b.user_id, b.product_id, b.quantity, CAST(b.transaction_price AS DOUBLE) AS price, p.category
    FROM events_bought b LEFT JOIN products p ON b.product_id = p.product_id""",
)
def stream_static_left(spark, d):
    p = pipeline(spark, d)
    stream = stream_csv(spark, p.transactions["east"], p.transaction_schema, "_rescued")
    west = stream_csv(spark, p.transactions["west"], p.transaction_schema, "_rescued")
    enriched = joins.enrich(stream.unionByName(west), [(p.products, "product_id")])
    flows.append_flows(p.table("enriched"), {"all": enriched}, p.checkpoint("enriched"))
    stored = flows.read_flows(spark, p.table("enriched"))
    return stored.select(
        "user_id", "product_id", "quantity", F.col("transaction_price").cast("double").alias("price"), "category"
    )


@query(
    "stream_quarantine",
    *PIPELINE_SQL,
    """SELECT user_id, product_id, quantity, CAST(transaction_price AS DOUBLE) AS price FROM events_bought
    WHERE NOT (quantity >= 1 AND transaction_price > 0)""",
)
def stream_quarantine(spark, d):
    p = pipeline(spark, d, rules=fv.TRANSACTION_RULES)
    bronze(spark, p)
    split_by_flag(spark, p)  # nothing new the second time
    return _lines(flows.read_flows(spark, p.table("transactions_invalid")))


@query(
    "pipeline_conf",
    """SELECT * FROM (VALUES ('root', 'main/shop/tables'), ('east', 'main/shop/raw_data/transactions_east'),
      ('west', 'main/shop/raw_data/transactions_west'), ('users', 'main/shop/raw_data/users')) AS t(name, place)
    UNION ALL SELECT 'products', CAST(COUNT(*) AS VARCHAR) FROM part""",
)
def pipeline_conf(spark, d):
    """Where a pipeline named by the session's settings finds its files, and how many products it has."""
    database, base = scratch_database(spark), scratch_dir(spark, "volumes")
    dt.products(spark, d).write.saveAsTable(f"{database}.products_source")
    with tables.settings(spark, {"catalog_name": "main", "schema_name": database}):
        p = pipeline_from_conf(spark, base, "user_id bigint", "user_id bigint")
    places = {"root": p.root, **p.transactions, "users": p.users}
    rows = [(name, place.removeprefix(f"{base}/").replace(database, "shop")) for name, place in places.items()]
    counted = p.products.agg(F.lit("products").alias("name"), F.count("*").cast("string").alias("place"))
    return spark.createDataFrame(rows, "name string, place string").union(counted)
