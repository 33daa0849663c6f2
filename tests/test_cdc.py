import random

from hypothesis import given, settings, strategies as st

from tarnwork.operators import cdc

DDL = "user_id int, age int, region string, operation string, last_updated int"
HOW = (["user_id"], ["last_updated"], "operation = 'DELETE'", ["operation"])


def feed(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_newest_wins_and_deletes(spark, rows):
    changes = [
        (1, 20, "a", "INSERT", 1),
        (1, 22, "c", "UPDATE", 3),
        (1, 21, "b", "UPDATE", 2),
        (2, 30, "a", "INSERT", 1),
        (2, None, None, "DELETE", 2),
        (3, 40, None, None, 1),
    ]
    found = cdc.current_rows(cdc.latest_changes(feed(spark, changes), *HOW))
    assert found.columns == ["user_id", "age", "region", "last_updated"]
    assert rows(found) == [(1, 22, "c", 3), (3, 40, None, 1)]


def test_a_late_row_does_not_undo_a_delete(spark, rows):
    state = cdc.apply_changes(None, feed(spark, [(1, None, None, "DELETE", 5)]), *HOW)
    state = cdc.apply_changes(state, feed(spark, [(1, 20, "a", "UPDATE", 4)]), *HOW)
    assert rows(cdc.current_rows(state)) == []
    state = cdc.apply_changes(state, feed(spark, [(1, 23, "b", "UPDATE", 6)]), *HOW)
    assert rows(cdc.current_rows(state)) == [(1, 23, "b", 6)]


def test_ties(spark, rows):
    tied = [(1, 20, "a", "UPDATE", 1), (1, 21, "a", "UPDATE", 1), (2, 20, "a", "UPDATE", 1), (2, 20, "a", "DELETE", 1)]
    for order in (tied, tied[::-1]):
        assert rows(cdc.current_rows(cdc.latest_changes(feed(spark, order), *HOW))) == [(1, 21, "a", 1)]


def test_new_columns_in_a_later_feed(spark, rows):
    state = cdc.apply_changes(None, feed(spark, [(1, 20, "a", "UPDATE", 1)]), *HOW)
    later = spark.createDataFrame([(2, 30, "b", "UPDATE", 2, "x")], DDL + ", extra string")
    state = cdc.apply_changes(state, later, *HOW)
    assert rows(cdc.current_rows(state)) == [(1, 20, "a", 1, None), (2, 30, "b", 2, "x")]


change = st.tuples(
    st.integers(1, 4),
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["UPDATE", "DELETE"]),
    st.integers(1, 5),
)


@settings(max_examples=8, deadline=None)
@given(changes=st.lists(change, min_size=1, max_size=25), cut=st.integers(0, 25), seed=st.integers(0, 99))
def test_any_order_and_any_batches_give_the_same(spark, changes, cut, seed):
    whole = sorted(map(str, cdc.apply_changes(None, feed(spark, changes), *HOW).collect()))
    shuffled = random.Random(seed).sample(changes, len(changes))
    state = None
    for part in (shuffled[:cut], shuffled[cut:], shuffled[:3]):  # the last is a replay
        state = cdc.apply_changes(state, feed(spark, part), *HOW)
    assert sorted(map(str, state.collect())) == whole
    newest = {}
    for row in changes:
        if row[0] not in newest or row[4] > newest[row[0]]:
            newest[row[0]] = row[4]
    assert {(r["user_id"], r["last_updated"]) for r in state.collect()} == set(newest.items())


def test_map_columns(spark):
    feed = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1, 'b', 2)), (1, 2, map('b', 2)), (2, 1, NULL), (1, 2, map('c', 0)) AS t(id, seq, extra)")
    found = {r.id: r.extra for r in cdc.latest_changes(feed, ["id"], ["seq"]).collect()}
    assert found == {1: {"c": 0}, 2: None}
