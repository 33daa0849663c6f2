import pytest
from pyspark.sql import Observation, functions as F

from tarnwork import fixed_values as fv
from tarnwork.operators import joins, project, quality

RULES = fv.TRANSACTION_RULES
LINES = [(1, 1, 10.0), (2, 0, 10.0), (3, None, 10.0), (4, 5, None), (5, 2, 0.0), (6, None, 0.0), (7, 0, None)]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(LINES, "id int, quantity int, transaction_price double")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_flag_can_be_unknown(lines):
    flags = {r["id"]: r["valid"] for r in project.with_rule_flag(lines, RULES).collect()}
    assert flags == {1: True, 2: False, 3: None, 4: None, 5: False, 6: False, 7: False}


def test_a_rule_with_or_keeps_its_meaning(spark):
    df = spark.createDataFrame([(1, 5, 0.0)], "id int, quantity int, transaction_price double")
    flag = project.with_rule_flag(df, {"a": "quantity = 5 OR quantity = 6", "b": "transaction_price > 0"})
    assert flag.first()["valid"] is False


def test_quarantine(lines):
    valid, invalid = quality.quarantine(lines, RULES)
    assert (ids(valid), ids(invalid)) == ([1], [2, 3, 4, 5, 6, 7])
    valid, invalid = quality.quarantine(lines, RULES, null_as="drop")
    assert (ids(valid), ids(invalid)) == ([1], [2, 5, 6, 7])
    assert valid.columns == lines.columns


def test_warn_counts_while_rows_pass(lines):
    seen = Observation("rules")
    assert quality.expect(lines, RULES, "warn", seen).count() == 7
    assert seen.get == {"n_rows": 7, "quantity_is_more_than_1": 4, "transaction_price_is_more_than_0": 4}
    lenient = Observation("lenient")
    quality.expect(lines, RULES, "warn", lenient, null_as="valid").count()
    assert lenient.get["quantity_is_more_than_1"] == 2


def test_drop(lines):
    assert ids(quality.expect(lines, RULES, "drop")) == [1]
    assert ids(quality.expect(lines, RULES, "drop", null_as="valid")) == [1, 3, 4]


def test_fail_writes_nothing(lines, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="rule .* is violated"):
        # The check holds although no rule column is read afterwards.
        quality.expect(lines, RULES, "fail").select("id").write.parquet(path)
    assert not list((tmp_path / "out").glob("part-*"))
    quality.expect(lines.where("id = 1"), RULES, "fail").write.mode("overwrite").parquet(path)


@pytest.mark.parametrize("bad", [{"on_fail": "ignore"}, {"null_as": "drop"}])
def test_bad_options(lines, bad):
    with pytest.raises(ValueError):
        quality.expect(lines, RULES, **{"on_fail": "drop", **bad}).collect()


def test_report(lines):
    report = {r["rule"]: tuple(r)[1:] for r in quality.dq_report(lines, RULES).collect()}
    assert report == {"quantity_is_more_than_1": (3, 2, 2), "transaction_price_is_more_than_0": (3, 2, 2)}


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "a")], "k int, v string")
    assert tuple(quality.key_check(df, ["k"]).first()) == (6, 2, 1, 2)
    assert tuple(quality.key_check(df, ["k", "v"]).first()) == (6, 2, 1, 2)
    assert tuple(quality.key_check(df.limit(0), ["k"]).first()) == (0, 0, 0, 0)
    assert quality.null_counts(df, ["k", "v"]).first().asDict() == {"k": 2, "v": 0}
    with pytest.raises(Exception, match="column k must not be NULL"):
        quality.require_not_null(df, ["k"]).select("v").collect()
    assert quality.require_not_null(df, ["v"]).count() == 6


@pytest.fixture
def star(spark):
    rows = [(i, 7 if i % 2 else (None if i % 5 == 0 else i % 40)) for i in range(400)]
    fact = spark.createDataFrame(rows, "id int, k int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(30)], "k int, name string")
    return fact, dim


def test_skewed_join_equals_the_plain_one(star, rows):
    fact, dim = star
    assert joins.hot_keys(fact, "k", 0.2) == [7]
    wanted = rows(fact.join(dim, "k", "left"))
    for share in (0.2, 0.9, 0.01):
        assert rows(joins.left_join_skewed(fact, dim, "k", share).select("k", "id", "name")) == wanted
    assert rows(joins.enrich(fact, [(dim, "k")], hot_share=0.2).select("k", "id", "name")) == wanted


def test_skewed_join_with_a_dimension_that_repeats_the_hot_key(star, rows, monkeypatch):
    fact, dim = star
    twice = dim.union(dim.where("k = 7").withColumn("name", F.lit("again")))
    wanted = rows(fact.join(twice, "k", "left"))
    assert rows(joins.left_join_skewed(fact, twice, "k", 0.2).select("k", "id", "name")) == wanted
    monkeypatch.setattr(joins, "MAX_HOT_DIM_ROWS", 1)
    assert rows(joins.left_join_skewed(fact, twice, "k", 0.2).select("k", "id", "name")) == wanted


def test_audit_and_unmatched(star):
    fact, dim = star
    audited = joins.match_audit(fact, [(dim.union(dim), "k")])
    assert audited.count() == 400
    lost = audited.where("NOT k_matched").count()
    assert lost == joins.unmatched(fact, dim, "k").count() == fact.where("k IS NULL OR k >= 30").count() > 0


def test_star_totals(star):
    fact, dim = star
    for first in (False, True):
        row = joins.star_totals(fact, dim, "k", "name = 'n7'", "id", ("n", "total"), first).first()
        assert tuple(row) == (200 + fact.where("k = 7 AND id % 2 = 0").count(), row["total"])
        none = joins.star_totals(fact, dim, "k", "name = 'nobody'", "id", ("n", "total"), first).first()
        assert tuple(none) == (0, None)


@pytest.mark.parametrize("later", ["quantity > 3", "id > 100"])
def test_a_later_filter_hides_no_violation(spark, tmp_path, later):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 0), (2, 5)], "id int, quantity int").coalesce(1).write.parquet(path)
    checked = quality.expect(spark.read.parquet(path), {"some": "quantity > 1"}, "fail")
    with pytest.raises(Exception, match="rule some is violated"):
        checked.where(later).collect()
    with pytest.raises(Exception, match="must not be NULL"):
        quality.require_not_null(spark.read.parquet(path).withColumn("x", F.expr("if(id = 1, NULL, id)")), ["x"]).where(later).collect()
