"""What Spark plans: filters at the scan, few columns, small sides broadcast, no Python where none is needed."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tarnwork.operators import cdc, joins
from tarnwork.plans import driver_tables as dt, retail
from tarnwork.sources.tables import load_tables

QUERIES = entry.queries()
WITHOUT_PYTHON = [
    "apply_policies", "mask_email", "segment_performance", "metric_view", "kpi_totals", "cdc_scd1", "merge_schema_evolution",
    "quarantine_split", "dq_report", "percent_of_total", "stratified_split", "one_hot", "standardize", "roc_auc",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WITHOUT_PYTHON)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_the_period_and_the_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["segment_performance"](spark, sf_dir))
    orders = next(line for line in text.splitlines() if "Scan parquet" in line and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThan(o_orderdate" in orders
    assert "o_totalprice" not in text and "p_name" not in text and "l_tax" not in text


def test_sums_combine_before_the_shuffle(spark, sf_dir):
    text = plan(retail.category_totals(dt.sales(spark, sf_dir)))
    assert text.index("functions=[partial_") > text.index("Exchange")


def test_sales_are_dealt_by_the_number_of_lines(spark, sf_dir):
    lines = load_tables(spark, sf_dir, "lineitem")[0].count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = dt.sales(spark, sf_dir, lines_per_task=500)
        sizes = sales.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert len(sizes) == -(-lines // 500) and sum(sizes) == lines and max(sizes) <= 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_changes_combine_before_the_shuffle(spark, sf_dir):
    text = plan(cdc.latest_changes(dt.feed(spark, sf_dir), ["user_id"], ["last_updated"], "operation = 'DELETE'"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text[text.index("Exchange hashpartitioning") :]


def test_totals_need_no_single_task_window(spark, sf_dir):
    text = plan(QUERIES["percent_of_total"](spark, sf_dir))
    assert "Window" not in text and "Subquery" in text


def test_rows_are_not_shuffled_by_their_class(spark, sf_dir):
    text = plan(QUERIES["stratified_split"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_a_filtered_dimension_is_broadcast(spark, sf_dir):
    text = plan(QUERIES["star_inner_filter"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_large_side_is_not_broadcast(spark, sf_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dims = [(dt.users(spark, sf_dir), "user_id")]
        assert "BroadcastHashJoin" not in plan(joins.enrich(dt.transactions(spark, sf_dir), dims))
        # The hot-key split broadcasts the hot keys' rows alone.
        line, customer = load_tables(spark, sf_dir, "orders", "customer")
        hot = line.withColumn("c_custkey", F.when(F.col("o_orderstatus") == "F", 7).otherwise(F.col("o_custkey")))
        text = plan(joins.left_join_skewed(hot, customer, "c_custkey", 0.2))
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dynamic_pruning_of_a_partitioned_fact(spark, sf_dir, tmp_path):
    line, supplier = load_tables(spark, sf_dir, "lineitem", "supplier")
    fact_path, dim_path = str(tmp_path / "fact"), str(tmp_path / "dim")
    line.withColumn("nation", F.pmod("l_suppkey", F.lit(5)).cast("int")).write.partitionBy("nation").parquet(fact_path)
    supplier.selectExpr("s_nationkey AS nation", "s_name").write.parquet(dim_path)
    fact, dim = spark.read.parquet(fact_path), spark.read.parquet(dim_path)
    joined = fact.join(dim.where("s_name = 'nobody' OR s_name LIKE '%1'"), "nation")
    assert "dynamicpruning" in plan(joined)


def test_a_small_source_does_not_move_the_target(spark, sf_dir):
    text = plan(QUERIES["merge_schema_evolution"](spark, sf_dir))
    assert "SortMergeJoin" not in text


def test_a_hot_key_is_split_at_run_time(spark, tmp_path):
    """Without the hot-key split, AQE cuts the skewed partition of a shuffled join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "20",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    path = str(tmp_path / "fact")
    spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 1, id) AS k", "sha2(cast(id as string), 256) AS v").repartition(
        8
    ).write.parquet(path)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        dim = spark.range(60_000).selectExpr("id AS k", "id AS w")
        joined = joins.enrich(spark.read.parquet(path), [(dim, "k")])
        assert joined.count() == 60_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 60_000 and "skew=true" in plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
