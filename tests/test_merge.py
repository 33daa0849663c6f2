from decimal import Decimal

import pytest
from conftest import day
from pyspark.sql import functions as F, types as T

from tarnwork.operators import merge, tables

SALES = "sale_id bigint, store_id string, product_id string, amount decimal(10,2), sale_date date"


def sales(spark):
    return spark.createDataFrame(
        [
            (1, "S001", "P100", Decimal("1200.00"), day("2026-07-01")),
            (2, "S001", "P101", Decimal("850.00"), day("2026-07-01")),
            (3, "S002", "P100", Decimal("1500.00"), day("2026-07-02")),
        ],
        SALES,
    )


@pytest.fixture
def table(spark, request):
    name = "sales_" + request.node.name.split("[")[0]
    tables.write_table(sales(spark), name)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def fourth(spark, **other):
    values = {"sale_id": 4, "store_id": "S002", "product_id": "P102", "amount": "980.00", "sale_date": "2026-07-03", **other}
    cast = {"sale_id": "bigint", "amount": "decimal(10,2)", "sale_date": "date"}
    cast = {c: t for c, t in cast.items() if c not in other}
    df = spark.createDataFrame([tuple(map(str, values.values()))], list(values))
    return df.withColumns({c: df[c].cast(t) for c, t in cast.items()})


def test_unknown_column_is_refused(spark, table):
    with pytest.raises(Exception, match="TOO_MANY_DATA_COLUMNS|campaign_id"):
        tables.insert_rows(fourth(spark, campaign_id="CP001"), table)
    with pytest.raises(merge.SchemaError, match="campaign_id"):
        merge.enforce_schema(fourth(spark, campaign_id="CP001"), spark.table(table).schema)
    assert spark.table(table).count() == 3


def test_text_for_a_number_is_refused(spark, table):
    bad = fourth(spark, amount="not_a_number")
    with pytest.raises(Exception, match="CANNOT_SAFELY_CAST"):
        tables.insert_rows(bad, table)
    with pytest.raises(merge.SchemaError, match="amount"):
        merge.enforce_schema(bad, spark.table(table).schema)
    assert spark.table(table).count() == 3


def test_the_whole_story(spark, table, rows):
    tables.add_columns(spark, table, {"campaign_id": "string"})
    tables.insert_rows(fourth(spark, campaign_id="CP001"), table)
    updates = spark.createDataFrame(
        [
            (2, "S001", "P101", Decimal("800.00"), day("2026-07-01"), Decimal("0.05")),
            (6, "S004", "P104", Decimal("3300.00"), day("2026-07-05"), Decimal("0.15")),
        ],
        SALES + ", discount_rate decimal(5,4)",
    )
    with pytest.raises(merge.SchemaError, match="discount_rate"):
        merge.merge_upsert(spark.table(table), updates, ["sale_id"])
    tables.replace_table(merge.merge_upsert(spark.table(table), updates, ["sale_id"], evolve=True), table)
    assert spark.table(table).columns[-2:] == ["campaign_id", "discount_rate"]
    assert spark.table(table).schema["discount_rate"].dataType == T.DecimalType(5, 4)
    assert rows(spark.table(table)) == [
        (1, "S001", "P100", Decimal("1200.00"), day("2026-07-01"), None, None),
        (2, "S001", "P101", Decimal("800.00"), day("2026-07-01"), None, Decimal("0.0500")),
        (3, "S002", "P100", Decimal("1500.00"), day("2026-07-02"), None, None),
        (4, "S002", "P102", Decimal("980.00"), day("2026-07-03"), "CP001", None),
        (6, "S004", "P104", Decimal("3300.00"), day("2026-07-05"), None, Decimal("0.1500")),
    ]
    now = spark.table(table)
    with pytest.raises(merge.SchemaError, match="name_mapping"):
        merge.evolve(now, drop=["campaign_id"])
    tables.replace_table(merge.evolve(now, drop=["campaign_id"], name_mapping=True), table)
    tables.replace_table(merge.evolve(spark.table(table), rename={"store_id": "shop_id"}, name_mapping=True), table)
    tables.replace_table(merge.evolve(spark.table(table), add={"visits": "int"}), table)
    with pytest.raises(merge.SchemaError, match="type_widening"):
        merge.evolve(spark.table(table), widen={"visits": "bigint"})
    tables.replace_table(merge.evolve(spark.table(table), widen={"visits": "bigint"}, type_widening=True), table)
    assert spark.table(table).dtypes == [
        ("sale_id", "bigint"), ("shop_id", "string"), ("product_id", "string"), ("amount", "decimal(10,2)"),
        ("sale_date", "date"), ("discount_rate", "decimal(5,4)"), ("visits", "bigint"),
    ]
    assert spark.table(table).count() == 5


@pytest.mark.parametrize("large", [False, True])
def test_null_keys_and_null_updates(spark, rows, large):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    source = spark.createDataFrame([(1, None), (None, "n"), (None, "m")], "k int, v string")
    merged = merge.merge_upsert(target, source, ["k"], large_source=large)
    assert rows(merged) == [(None, "b"), (None, "m"), (None, "n"), (1, None), (2, "c")]


def test_two_source_rows_for_one_target_row(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(merge.SchemaError, match="more than one source row"):
        merge.merge_upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])
    both = merge.merge_upsert(target, spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string"), ["k"])
    assert rows(both) == [(1, "a"), (5, "x"), (5, "y")]


@pytest.mark.parametrize("large", [False, True])
def test_repeated_target_keys_are_all_updated(spark, rows, large):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, own int")
    source = spark.createDataFrame([(1, "z"), (9, "q")], "k int, v string")
    assert rows(merge.merge_upsert(target, source, ["k"], large_source=large)) == [(1, "z", 1), (1, "z", 2), (2, "c", 3), (9, "q", None)]


@pytest.mark.parametrize(
    "old, new, ok",
    [
        ("int", "bigint", True), ("bigint", "int", False), ("int", "decimal(10,0)", True), ("int", "decimal(9,0)", False),
        ("decimal(10,2)", "decimal(12,2)", True), ("decimal(10,2)", "decimal(10,4)", False),
        ("decimal(10,2)", "decimal(12,4)", True), ("float", "double", True), ("double", "float", False),
        ("string", "int", False), ("date", "timestamp_ntz", True), ("bigint", "double", False), ("int", "double", True),
    ],
)
def test_widening(old, new, ok):
    assert merge.can_widen(T.DataType.fromDDL(old), T.DataType.fromDDL(new)) is ok


@pytest.mark.parametrize(
    "change",
    [
        {"widen": {"amount": "decimal(9,2)"}},
        {"drop": ["nothing"]},
        {"rename": {"store_id": "product_id"}},
        {"add": {"amount": "int"}},
    ],
)
def test_refused_changes(spark, change):
    with pytest.raises(merge.SchemaError):
        merge.evolve(sales(spark), name_mapping=True, type_widening=True, **change)


def test_overwrite_keeps_the_schema_unless_told(spark, table):
    with pytest.raises(ValueError, match="overwrite_schema"):
        tables.write_table(sales(spark).drop("amount"), table)
    assert "amount" in spark.table(table).columns
    tables.write_table(sales(spark).drop("amount"), table, overwrite_schema=True)
    assert "amount" not in spark.table(table).columns


def test_a_failing_write_leaves_the_table(spark, table):
    from tarnwork.operators.quality import expect

    with pytest.raises(Exception, match="rule big is violated"):
        tables.write_table(expect(spark.table(table), {"big": "amount > 1000"}, "fail"), table)
    assert spark.table(table).count() == 3


def test_comments(spark, table):
    tables.annotate_table(spark, table, "it's the sales", {"store_id": "the shop's id"})
    described = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    assert described["store_id"] == "the shop's id"
    noted = tables.annotate(spark.table(table), {"amount": "yen"})
    assert noted.schema["amount"].metadata["comment"] == "yen"
    tables.analyze_table(spark, table)


def test_clustering_splits_a_hot_key(spark, tmp_path):
    df = spark.range(9_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 50 as string)) AS k")
    path, plain = str(tmp_path / "c"), str(tmp_path / "p")
    tables.clustered_write(df, path, ["k"], 9)
    df.repartition(9).write.parquet(plain)
    files = tables.file_ranges(spark.read.parquet(path), "k").collect()
    assert len(files) == 9 and max(f["n_rows"] for f in files) < 2_000
    clustered = tables.files_to_read(spark.read.parquet(path), "k", "7").first()
    assert (clustered["files"], clustered["files_to_read"] <= 2) == (9, True)
    assert tables.files_to_read(spark.read.parquet(plain), "k", "7").first()["files_to_read"] == 9
    assert spark.read.parquet(path).exceptAll(df).isEmpty()


@pytest.fixture
def shops(spark):
    spark.sql("DROP TABLE IF EXISTS shops")
    df = spark.createDataFrame(
        [(1, "a", "east"), (2, "b", "east"), (3, "c", "west"), (4, "d", None)], "id int, v string, area string"
    )
    df.coalesce(1).write.partitionBy("area").saveAsTable("shops")
    yield "shops"
    spark.sql("DROP TABLE IF EXISTS shops")


def files_of(spark, name, where):
    return {r[0] for r in spark.table(name).where(where).select("_metadata.file_path").distinct().collect()}


def test_only_touched_partitions_are_rewritten(spark, shops, rows):
    west = files_of(spark, shops, "area = 'west'")
    source = spark.createDataFrame([(1, "A", "east"), (9, "N", "north"), (4, "D", None)], "id int, v string, area string")
    tables.merge_into(source, shops, ["id", "area"])
    # A NULL never equals a NULL, so row 4 is inserted beside the old one, which stays.
    assert rows(spark.table(shops)) == [
        (1, "A", "east"), (2, "b", "east"), (3, "c", "west"), (4, "D", None), (4, "d", None), (9, "N", "north")
    ]
    assert files_of(spark, shops, "area = 'west'") == west


def test_merge_into_with_a_new_column(spark, shops, rows):
    source = spark.createDataFrame([(3, "C", "west", 7)], "id int, v string, area string, n int")
    with pytest.raises(merge.SchemaError, match="no column n"):
        tables.merge_into(source, shops, ["id", "area"])
    with pytest.raises(ValueError, match="partition columns area"):
        tables.merge_into(source, shops, ["id"], evolve=True)
    tables.merge_into(source, shops, ["id", "area"], evolve=True)
    found = rows(spark.table(shops).select("id", "v", "n", "area"))
    assert found == [(1, "a", None, "east"), (2, "b", None, "east"), (3, "C", 7, "west"), (4, "d", None, None)]


def test_merge_into_a_table_without_partitions(spark, table):
    tables.merge_into(spark.table(table).where("sale_id = 1").withColumn("amount", F.lit(1)), table, ["sale_id"])
    assert spark.table(table).where("amount = 1").count() == 1 and spark.table(table).count() == 3


def test_overwrite_keeps_partitions_comments_and_properties(spark, shops):
    tables.annotate_table(spark, shops, "all shops", {"id": "the key"})
    spark.sql(f"ALTER TABLE {shops} SET TBLPROPERTIES ('keeper' = 'o\\'neil')")
    tables.write_table(spark.table(shops), shops)
    columns = {c.name: (c.isPartition, c.description) for c in spark.catalog.listColumns(shops)}
    assert columns["area"][0] and columns["id"] == (False, "the key")
    assert spark.catalog.getTable(shops).description == "all shops"
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {shops}").collect()}["keeper"] == "o'neil"


def test_an_interrupted_swap_is_finished(spark, table, rows):
    before = rows(spark.table(table))
    spark.table(table).write.saveAsTable(f"{table}__new")
    spark.sql(f"ALTER TABLE {table}__new SET TBLPROPERTIES ('{tables.COMPLETE}' = 'true')")
    spark.sql(f"DROP TABLE {table}")
    tables.recover_table(spark, table)
    assert rows(spark.table(table)) == before and not spark.catalog.tableExists(f"{table}__new")
    spark.table(table).limit(1).write.saveAsTable(f"{table}__new")  # never completed
    tables.write_table(spark.table(table), table)
    assert rows(spark.table(table)) == before


def test_names_match_in_any_case(spark, rows):
    target = spark.createDataFrame([(1, 5), (2, 6)], "id int, amount int")
    source = spark.createDataFrame([(2, 7), (3, 8)], "ID int, Amount int")
    merged = merge.merge_upsert(target, source, ["id"], evolve=True)
    assert merged.columns == ["id", "amount"] and rows(merged) == [(1, 5), (2, 7), (3, 8)]


def test_null_keys_stay_apart_in_a_large_merge(spark, rows):
    target = spark.createDataFrame([(1, 5), (None, 6)], "id int, amount int")
    source = spark.createDataFrame([(1, 7, "a"), (None, 8, "b"), (None, 8, "b")], "id int, amount int, note string")
    merged = merge.merge_upsert(target, source, ["id"], evolve=True, large_source=True)
    assert rows(merged) == rows(merge.merge_upsert(target, source, ["id"], evolve=True))
    assert merged.count() == 4


def test_merge_reads_touched_partitions_alone(spark, shops):
    source = spark.table(shops).limit(1)
    area = source.first()["area"]
    read = []
    original = tables.merge_upsert
    tables.merge_upsert = lambda target, *how, **more: (read.append(target), original(target, *how, **more))[1]
    try:
        tables.merge_into(spark.createDataFrame(source.collect(), source.schema), shops, ["id", "area"])
    finally:
        tables.merge_upsert = original
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert (str(area) if area is not None else "isnull") in filters
