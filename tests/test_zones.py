import datetime

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.zones import ZonedTable, write_zoned

SCHEMA = "id int, name string, at date, price decimal(9,2)"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zones") / "a b")
    day = datetime.date(2024, 1, 1)
    rows = [(i, f"n{i % 7}", day + datetime.timedelta(i // 10), None if i % 11 == 0 else i) for i in range(1000)] + [(None, None, None, None)] * 3
    df = spark.createDataFrame([(i, n, d, str(p) if p is not None else None) for i, n, d, p in rows], "id int, name string, at date, price string")
    df = df.withColumn("price", F.col("price").cast("decimal(9,2)"))
    write_zoned(df, path, ["name", "id"], 10, ["name", "id", "at", "price"])
    return df, ZonedTable(spark, path)


def names(files):
    return {r.file for r in files.collect()}


@pytest.mark.parametrize(
    "wanted",
    [
        {"name": "n3"}, {"id": 77}, {"id": 5000}, {"name": "zz"}, {"id": (100, 120)}, {"id": (None, 3)}, {"id": (990, None)}, {"at": datetime.date(2024, 1, 5)},
        {"name": "n3", "id": (0, 50)}, {"price": 12}, {"price": (1, 2)}, {},
    ],
)
def test_rows_are_those_of_the_filter(table, rows, wanted):
    df, zoned = table
    plain = df
    for column, value in wanted.items():
        if isinstance(value, tuple):
            plain = plain.where((F.col(column) >= value[0]) if value[0] is not None else F.lit(True)).where((F.col(column) <= value[1]) if value[1] is not None else F.lit(True))
        else:
            plain = plain.where(F.col(column) == value)
    found = zoned.read(**wanted)
    assert rows(found) == rows(plain) and found.schema.simpleString() == df.schema.simpleString()
    # What is opened is what is read.
    assert len(found.inputFiles()) == len(names(zoned.opened(**wanted)))


def test_few_files_are_opened(table):
    _, zoned = table
    n = zoned.files().count()
    assert n == 10
    assert zoned.opened(name="n3").count() <= 3
    assert zoned.opened(id=77).count() <= 2  # spread over all names' ranges, told by the Bloom bits
    assert zoned.opened(id=5000).count() == 0 and zoned.read(id=5000).count() == 0


def test_files_for_a_join(spark, table, rows):
    df, zoned = table
    keys = spark.createDataFrame([(77,), (78,), (None,), (9999,)], "k int")
    part = zoned.read_for(keys, "id", "k")
    assert len(part.inputFiles()) < 8
    wanted = df.join(keys, df["id"] == keys["k"])
    assert rows(part.join(keys, part["id"] == keys["k"])) == rows(wanted)
    by_range = zoned.read_for(keys, "id", "k", most_keys=1)
    assert rows(by_range.join(keys, by_range["id"] == keys["k"])) == rows(wanted)
    assert zoned.read_for(keys.limit(0), "id", "k").count() == 0


def test_refused(spark, table, tmp_path):
    with pytest.raises(ValueError, match="no column x"):
        write_zoned(table[0], str(tmp_path / "t"), ["id"], 2, ["x"])
    write_zoned(table[0], str(tmp_path / "u"), ["id"], 2)
    with pytest.raises(ValueError, match="no column name"):
        ZonedTable(spark, str(tmp_path / "u")).opened(name="n1")


def test_empty_table(spark, tmp_path):
    write_zoned(spark.createDataFrame([], SCHEMA), str(tmp_path / "t"), ["id"], 4)
    assert ZonedTable(spark, str(tmp_path / "t")).read(id=1).collect() == []
