import json

import pytest
from pyspark.sql import functions as F

from tarnwork.plans import retail
from tarnwork.sources import files, star, tables
from tarnwork.sources.statements import statement_json_to_df

SCHEMA = "id int, price decimal(10,2), day date, note string"


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_rescue(spark, tmp_path, rows):
    path = write(
        tmp_path / "in",
        "a.csv",
        "id,price,day,note,extra\n"
        "1,2.50,2024-01-01,fine,\n"
        "x,2.50,2024-01-01,bad id,\n"
        "3,cheap,soon,two bad,more\n"
        "4,,,,\n"
        "5,1.00,2024-01-01,short\n"
        '6,1.00,2024-01-01,"a ""quoted"" one, yes",,7\n',
    )
    found = rows(files.scan_csv(spark, path, SCHEMA, rescue="_rescued", escape='"'))
    rescued = {r[0]: json.loads(r[-1]) if r[-1] else None for r in found}
    assert rescued[1] is None and rescued[4] is None
    assert rescued[None] == {"id": "x"}
    assert rescued[3] == {"price": "cheap", "day": "soon", "extra": "more"}
    assert files.CORRUPT in rescued[5] and files.CORRUPT in rescued[6]
    assert [r for r in found if r[0] == 6][0][3] == 'a "quoted" one, yes'


def test_leading_zeros_and_missing_column(spark, tmp_path, rows):
    path = write(tmp_path / "in", "a.csv", "note,id\n007,1\n")
    assert rows(files.scan_csv(spark, path, "id int, note string, day date", rescue="r")) == [(1, "007", None, None)]


def test_files_with_other_headers(spark, tmp_path, rows):
    """Without a rescue column they stop the read, with one each file is read by its own header."""
    write(tmp_path / "in", "a.csv", "id,note\n1,x\n")
    path = write(tmp_path / "in", "b.csv", "note,id\ny,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        files.scan_csv(spark, path, "id string, note string").collect()
    assert rows(files.scan_csv(spark, path, "id string, note string", rescue="r")) == [("1", "x", None), ("2", "y", None)]


def test_inference(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", "id,price,day\n1,2.5,2024-01-01\n2,3,2024-01-02\n")
    assert files.infer_schema(spark, path).simpleString() == "struct<id:int,price:double,day:date>"
    assert files.scan_csv(spark, path).count() == 2


def test_json_array_file(spark, tmp_path, rows):
    text = json.dumps([{"id": 1, "total": "9.5"}, {"id": 2, "total": "null"}], indent=1)
    path = write(tmp_path / "in", "a.json", text)
    assert rows(files.scan_json_array(spark, path, "id int, total string")) == [(1, "9.5"), (2, "null")]


def statement(names, data):
    columns = [{"name": n, "type_text": "STRING"} for n in names]
    return json.dumps({"statement_response": {"manifest": {"schema": {"columns": columns}}, "result": {"data_array": data}}})


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_statement(spark, rows):
    docs = frame(spark, statement(["b", "a"], [["1", "x"], [None, "y"]]), statement(["b", "a"], [["3", "z"]]))
    found = statement_json_to_df(docs)
    assert found.columns == ["b", "a"]
    assert rows(found) == [(None, "y"), ("1", "x"), ("3", "z")]


@pytest.mark.parametrize(
    "texts",
    [
        (statement([], [["1"]]),),
        (statement(["a"], []),),
        ("{}",),
        ("not json",),
        (statement(["a"], [["1"]]), statement(["b"], [["1"]])),
        (statement(["a"], [["1"]]), statement(["a"], [])),
    ],
)
def test_bad_statements(spark, texts):
    with pytest.raises(ValueError):
        statement_json_to_df(frame(spark, *texts))


def test_statement_row_of_wrong_width(spark):
    with pytest.raises(Exception, match="more or fewer values"):
        statement_json_to_df(frame(spark, statement(["a"], [["1", "2"]]))).collect()


def murmur3(value, seed):
    """Murmur3 of one LONG, as its public description has it."""

    def mix(k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        return k * 0x1B873593 & 0xFFFFFFFF

    h = seed & 0xFFFFFFFF
    for word, size in ((value & 0xFFFFFFFF, 0), (value >> 32 & 0xFFFFFFFF, 0)):
        h ^= mix(word)
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    return finish(h, 8)


def murmur3_int(value, seed):
    k = value & 0xFFFFFFFF
    k = k * 0xCC9E2D51 & 0xFFFFFFFF
    k = (k << 15 | k >> 17) & 0xFFFFFFFF
    h = (seed & 0xFFFFFFFF) ^ (k * 0x1B873593 & 0xFFFFFFFF)
    h = (h << 13 | h >> 19) & 0xFFFFFFFF
    return finish((h * 5 + 0xE6546B64) & 0xFFFFFFFF, 4)


def finish(h, size):
    h ^= size
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def test_fact_keys_follow_the_hash(spark):
    n = 1000
    for row in star.fact_sales(spark.range(300), n).collect():
        value = row["transaction_id"] - 1

        def draw(seed, modulo):
            return abs(murmur3_int(seed, murmur3(value, 42))) % modulo

        assert row["customer_id"] == draw(31, n) + 1
        assert row["product_id"] == draw(37, 10_000) + 1
        assert row["time_id"] == draw(41, 1_826) + 1
        assert row["promotion_id"] == draw(43, 100) + 1
        assert int(row["revenue"] * 100) == draw(47, 1_000_000)
        assert row["units_sold"] == draw(53, 10) + 1


def test_star_schema(spark, rows):
    made = star.gen_star_schema(spark, n_fact=5_000, n_customers=1_000)
    counts = {r["table_name"]: r["row_count"] for r in tables.table_row_counts(made).collect()}
    assert counts == {"dim_customer": 1_000, "dim_product": 10_000, "dim_promotion": 100, "dim_time": 1_826, "fact_sales": 5_000}
    last = made["dim_time"].orderBy(F.desc("time_id")).first()
    assert (str(last["order_date"]), last["quarter"]) == ("2025-12-31", 4)
    per_prefecture = made["dim_customer"].groupBy("prefecture").count().collect()
    assert len(per_prefecture) == 10 and {r["count"] for r in per_prefecture} == {100}
    first = made["dim_customer"].where("customer_id = 1").first()
    assert (first["name"], first["city"], first["zip"]) == ("Customer_000000001", "新宿区", "001-0001")
    prices = made["dim_product"].agg(F.min("unit_price"), F.max("unit_price")).first()
    assert 100 <= prices[0] < 110 and 9_990 < prices[1] <= 10_000
    joined = made["fact_sales"].join(made["dim_customer"], "customer_id").join(made["dim_time"], "time_id")
    assert joined.count() == 5_000


def test_clean_sales(spark, tmp_path, rows):
    from tarnwork import fixed_values as fv

    headers = {v: k for k, v in fv.SALES_COLUMN_NAMES.items()}
    lines = [
        {"order_id": "A", "profit": "5", "returned": "○"},
        {"order_id": "B", "profit": "0", "returned": ""},
        {"order_id": "C", "profit": "-1", "returned": ""},
        {"order_id": "D", "profit": "", "returned": "○"},
    ]
    head = list(reversed(fv.SALES_COLUMNS))
    text = ",".join(headers[c] for c in head) + "\n"
    text += "".join(",".join(line.get(c, "1") for c in head) + "\n" for line in lines)
    silver = retail.clean_sales(files.scan_csv(spark, write(tmp_path / "in", "a.csv", text)))
    assert silver.columns == fv.SALES_COLUMNS
    assert rows(silver.select("order_id", "profit", "returned")) == [("A", 5, True), ("B", 0, False)]


def test_table_detail_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    detail = tables.table_detail(spark.read.parquet(path)).first()
    assert (detail["num_files"], detail["num_rows"]) == (5, 100)
    assert detail["size_in_bytes"] > 0
    assert [tuple(r)[1:3] for r in tables.table_schema(spark, spark.read.parquet(path)).collect()] == [("id", "bigint")]


def test_values_that_lose_something_are_rescued(spark, tmp_path):
    (tmp_path / "1.csv").write_text("d,m,x,t\n2024-01-01 junk,1.239,12d,2024-01-01 10:00:00 x\n2024-1-2,1.2300,12,2024-01-01 10:00:00\n,-.5,1e3,2024-01-01\n")
    schema = "d date, m decimal(10,2), x double, t timestamp_ntz"
    found = files.scan_csv(spark, str(tmp_path), schema, rescue="r").collect()
    assert [str(f.m) for f in found] == ["None", "1.23", "-0.50"] and [f.x for f in found] == [None, 12.0, 1000.0]
    assert json.loads(found[0].r) == {"d": "2024-01-01 junk", "m": "1.239", "x": "12d", "t": "2024-01-01 10:00:00 x"}
    assert found[1].r is None and found[2].r is None and found[0].d is None


def chunked(tmp_path, chunks, columns=(("id", "bigint"), ("a b", "string"), ("price", "decimal(9,2)"), ("on", "date"))):
    listed = []
    for i, (rows, count) in enumerate(chunks):
        (tmp_path / f"c{i}.json").write_text(rows if isinstance(rows, str) else json.dumps(rows))
        listed.append({"file": f"c{i}.json", "row_count": count})
    (tmp_path / "manifest.json").write_text(json.dumps({"columns": [{"name": n, "type": t} for n, t in columns], "chunks": listed}))
    return str(tmp_path)


def test_chunks(spark, tmp_path, rows):
    from tarnwork.sources.chunks import read_chunks

    path = chunked(tmp_path, [([[str(i), f"x{i}", "1.50", "2024-01-02"] for i in range(k * 10, k * 10 + 10)], 10) for k in range(5)] + [([["99", None, None, None]], 1), ([], 0)])
    df = read_chunks(spark, path)
    assert df.rdd.getNumPartitions() == 7
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "decimal(9,2)", "date"]
    assert df.count() == 51 and rows(df.where("id = 99")) == [(99, None, None, None)]
    assert str(df.where("id = 42").first()) == "Row(id=42, a b='x42', price=Decimal('1.50'), on=datetime.date(2024, 1, 2))"
    assert rows(read_chunks(spark, path, typed=False).where("id = '42'")) == [("42", "x42", "1.50", "2024-01-02")]


@pytest.mark.parametrize(
    "rows, count, told", [('[["1","x"', 1, "cut off"), ([["1", "x", "1", "2024-01-01"]], 2, "has 1 rows, the manifest says 2"), ([["1"]], 1, "1 values for 4 columns")]
)
def test_broken_chunks_stop_the_read(spark, tmp_path, rows, count, told):
    from tarnwork.sources.chunks import read_chunks

    with pytest.raises(Exception, match=told):
        read_chunks(spark, chunked(tmp_path, [([["0", "x", "1", "2024-01-01"]], 1), (rows, count)])).collect()


def test_more_rows_make_more_chunks(spark, tmp_path):
    from tarnwork.operators.versions import VersionedTable
    from tarnwork.plans.queries_tables import write_chunks
    from tarnwork.sources.chunks import read_chunks

    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, NULL, concat('\"a\\n,]', id)) AS v", "id / 7 AS d").unionByName(spark.sql("SELECT 5L AS id, 'twice' AS v, 0D AS d"))
    n = write_chunks(VersionedTable(spark, str(tmp_path)), df, "id", rows_per_chunk=50)
    found = read_chunks(spark, str(tmp_path))
    sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert n == len(sizes) == 41 and max(sizes) <= 100
    assert found.exceptAll(df).isEmpty() and df.exceptAll(found).isEmpty()


def test_values_that_are_none_of_their_type_stop_the_read(spark, tmp_path):
    from tarnwork.sources.chunks import read_chunks

    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_chunks(spark, chunked(tmp_path, [([["one", "x", "1", "2024-01-01"]], 1)])).collect()
