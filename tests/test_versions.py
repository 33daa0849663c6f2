import random

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.versions import Conflict, IncrementalView, KeyedTable, VersionedTable

FEED = "user_id int, age int, at int, gone boolean"


def test_readers_keep_their_version(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.versions() == []
    with pytest.raises(ValueError, match="no version yet"):
        table.read()
    table.publish(spark.createDataFrame([(1,)], "a int"))
    pinned = table.read()
    table.publish(table.read().union(spark.createDataFrame([(2,)], "a int")))
    assert rows(pinned) == [(1,)] == rows(table.read(1))
    assert rows(table.read()) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no version 7"):
        table.read(7)


def test_a_run_that_stops_before_the_switch_changes_nothing(spark, tmp_path, rows, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.publish(spark.createDataFrame([(1,)], "a int"))

    def stop(manifest):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(table, "_switch", stop)
        with pytest.raises(OSError):
            table.publish(spark.createDataFrame([(2,)], "a int"))
    assert rows(VersionedTable(spark, table.path).read()) == [(1,)]
    table.publish(spark.createDataFrame([(3,)], "a int"))
    assert rows(table.read()) == [(3,)]


def test_two_writers_of_one_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    old = table.manifest()
    table.publish(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Conflict):
        table._switch({**old, "schema": None})


def test_vacuum(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(4):
        table.publish(spark.createDataFrame([(i,)], "a int"))
    assert table.vacuum(2) == [3, 4] == table.versions()
    assert rows(table.read(3)) == [(2,)] and rows(table.read()) == [(3,)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_one_change_rewrites_one_bucket(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["user_id"], ["at"], buckets=8)
    first = table.take(spark.createDataFrame([(i, 20, 1, False) for i in range(100)], FEED), "gone", ["gone"])
    assert first == list(range(8))
    before = table.manifest()["parts"]
    (bucket,) = table.take(spark.createDataFrame([(7, 30, 2, False)], FEED), "gone", ["gone"])
    after = table.manifest()["parts"]
    assert {b for b in after if after[b] != before[b]} == {str(bucket)}
    assert table.current().where("user_id = 7").first().age == 30 and table.current().count() == 100


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_batches_gives_the_newest(spark, tmp_path, rows, seed):
    r = random.Random(seed)
    feed = [(r.randint(1, 20), i, r.randint(1, 50), r.random() < 0.3) for i in range(120)] + [(None, 5, 3, False)]
    newest = {}
    for user, age, at, gone in feed:
        newest[user] = max(newest.get(user, (-1,)), (at, gone, age))
    table = KeyedTable(spark, str(tmp_path / "t"), ["user_id"], ["at"], buckets=4)
    r.shuffle(feed)
    for i in range(0, len(feed), 50):
        table.take(spark.createDataFrame(feed[i : i + 50], FEED), "gone", ["gone"], "f", i)
        assert table.take(spark.createDataFrame(feed[i : i + 50], FEED), "gone", ["gone"], "f", i) == []  # taken in before
    wanted = [(u, age, at) for u, (at, gone, age) in newest.items() if not gone]
    assert rows(table.current()) == sorted(wanted, key=lambda t: [(v is not None, str(v)) for v in t])


def test_empty_changes_and_new_columns(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), ["a"], ["at"], buckets=4)
    assert table.take(spark.createDataFrame([], "a int, at int")) == [] and rows(table.current()) == []
    table.take(spark.createDataFrame([(1, 1), (2, 1)], "a int, at int"))
    table.take(spark.createDataFrame([(1, 2, "x")], "a int, at int, b string"))
    assert rows(table.current().select("a", "at", "b")) == [(1, 2, "x"), (2, 1, None)]


def view(spark, path, **options):
    return IncrementalView(
        spark, str(path), ["year", "month"], sums={"total": "price"}, counted="n", least={"low": "price"}, most={"high": "price"},
        distinct={"users": "user"}, about_distinct={"about": "user"}, buckets=4, **options,
    )


def sales(spark, seed, n=300):
    r = random.Random(seed)
    data = [(r.choice([2023, 2024, None]), r.randint(1, 3), r.choice([None, *range(60)]), r.choice([None, "1.50", "2.25", "9.99"])) for _ in range(n)]
    return spark.createDataFrame(data, "year int, month int, user int, price string").withColumn("price", F.col("price").cast("decimal(9,2)"))


def test_views_equal_a_full_recompute(spark, tmp_path, rows):
    v, parts = view(spark, tmp_path / "v"), [sales(spark, i) for i in range(3)]
    everything = parts[0]
    for i, part in enumerate(parts):
        v.refresh(part, "f", i)
        v.refresh(part, "f", i)  # repeated, counted once
        everything = everything if not i else everything.union(part)
        def whole(*keys):
            return everything.groupBy(*keys).agg(
                F.count("*").alias("n"), F.sum("price").cast("double").alias("total"), F.min("price").alias("low"), F.max("price").alias("high"), F.count_distinct("user").alias("users")
            )
        shown = ["n", F.col("total").cast("double").alias("total"), "low", "high", "users"]
        assert rows(v.current().select("year", "month", *shown)) == rows(whole("year", "month"))
        assert rows(v.rolled_up(["year"]).select("year", *shown)) == rows(whole("year"))
        assert rows(v.rolled_up([]).select(*shown)) == rows(whole())
    for row in v.rolled_up(["year"]).collect():
        assert abs(row.about - row.users) <= 4 * row.about_error * row.users + 1
    assert str(v.read().schema["total"].dataType) == "DecimalType(38,2)"


def test_a_refresh_reads_the_new_rows_only(spark, tmp_path):
    """The base rows may be gone; one new group rewrites one bucket."""
    path = str(tmp_path / "base")
    sales(spark, 1).write.parquet(path)
    v = view(spark, tmp_path / "v")
    v.refresh(spark.read.parquet(path))
    before = v.manifest()["parts"]
    spark.createDataFrame([], "year int, month int, user int, price decimal(9,2)").write.mode("overwrite").parquet(path)
    one = spark.createDataFrame([(2030, 1, 1, None)], "year int, month int, user int, price decimal(9,2)")
    assert len(v.refresh(one)) == 1
    assert sum(before.get(b) != f for b, f in v.manifest()["parts"].items()) == 1
    assert v.current().agg(F.sum("n")).first()[0] == 301


def test_keys_the_view_does_not_have(spark, tmp_path):
    v = view(spark, tmp_path / "v")
    v.refresh(sales(spark, 1))
    with pytest.raises(ValueError, match="no key day"):
        v.rolled_up(["day"])
