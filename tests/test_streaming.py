import shutil
import time

import pytest
from pyspark.sql import functions as F

from tarnwork import fixed_values as fv
from tarnwork.operators import cdc
from tarnwork.sources.files import CsvFiles, stream_csv
from tarnwork.streaming import flows
from tarnwork.streaming.medallion import Pipeline, gold_views, medallion_run, pipeline_from_conf, products_table, users_table

TRANSACTIONS = "user_id int, product_id string, quantity int, transaction_price double"
USERS = "user_id int, age int, gender string, region string, operation string, last_updated timestamp_ntz"
LIMIT = 120


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


HEAD = "user_id,product_id,quantity,transaction_price"
USER_HEAD = "user_id,age,gender,region,operation,last_updated"


@pytest.fixture
def raw(spark, tmp_path):
    put(tmp_path / "east", "1.csv", HEAD, "1,p1,2,10.0", "2,p2,0,20.0", "1,p1,,5.0")
    put(tmp_path / "west", "1.csv", HEAD, "9,p1,1,40.0", "2,zz,3,cheap", "1,p2,1,0")
    put(
        tmp_path / "users", "1.csv", USER_HEAD,
        "1,30,F,N,INSERT,2024-01-02 00:00:00", "2,60,M,S,INSERT,2024-01-01 00:00:00", "3,40,M,S,DELETE,2024-01-05 00:00:00",
    )
    return tmp_path


def pipeline(spark, raw, **options):
    products = spark.createDataFrame([("p1", "c1", "s1"), ("p2", "c2", "s2")], "product_id string, category string, subcategory string")
    options = {"timeout": LIMIT, **options}
    return Pipeline(
        root=str(raw / "tables"),
        transactions={f: str(raw / f) for f in ("east", "west")},
        transaction_schema=TRANSACTIONS,
        users=str(raw / "users"),
        user_schema=USERS,
        products=products,
        **options,
    )


def read(spark, p, name):
    return flows.read_flows(spark, p.table(name))


def test_the_pipeline(spark, raw, rows):
    p = pipeline(spark, raw)
    medallion_run(spark, p)
    enriched = read(spark, p, "transactions_enriched")
    assert enriched.count() == 6
    rescued = enriched.where("_rescued_data_transactions IS NOT NULL").select("user_id", "_rescued_data_transactions")
    assert rows(rescued) == [(2, '{"transaction_price":"cheap"}')]
    by_segment = rows(gold_views(spark, p)["revenue_by_user_segment"].current())
    assert by_segment == [("シニア層", None, None, 40.0), ("シニア層", "M", "S", 20.0), ("若年層", "F", "N", 15.0)]
    assert rows(gold_views(spark, p)["revenue_by_subcategory"].current()) == [(None, None), ("s1", 55.0), ("s2", 20.0)]

    # Nothing new: nothing changes.
    medallion_run(spark, p)
    assert read(spark, p, "transactions_enriched").count() == 6

    # New files: a late change older than a delete, a newer change, one more sale of user 2.
    put(raw / "users", "2.csv", USER_HEAD, "3,41,M,S,UPDATE,2024-01-04 00:00:00", "2,20,M,W,UPDATE,2024-02-01 00:00:00")
    put(raw / "east", "2.csv", HEAD, "2,p1,1,7.0", "3,p1,1,8.0")
    medallion_run(spark, p)
    assert rows(users_table(spark, p).current().select("user_id", "age")) == [(1, 30), (2, 20)]
    ages = read(spark, p, "transactions_enriched").where("user_id = 2").select("transaction_price", "age")
    # Rows enriched before keep what was known then.
    assert rows(ages) == [(None, 60), (20.0, 60), (7.0, 20)]
    assert read(spark, p, "transactions_enriched").where("user_id = 3 AND age IS NULL").count() == 1


@pytest.mark.parametrize("null_as, invalid", [("invalid", 4), ("drop", 2)])
def test_quarantine_in_the_pipeline(spark, raw, null_as, invalid):
    p = pipeline(spark, raw, rules=fv.TRANSACTION_RULES, null_as=null_as)
    counts = medallion_run(spark, p)
    quantity, price = fv.TRANSACTION_RULES
    assert counts == {"east": {"n_rows": 3, quantity: 2, price: 0}, "west": {"n_rows": 3, quantity: 0, price: 2}}
    assert medallion_run(spark, p) == {"east": {}, "west": {}}
    assert read(spark, p, "transactions").count() == 2
    assert read(spark, p, "transactions_invalid").count() == invalid
    assert "valid" not in read(spark, p, "transactions").columns
    assert read(spark, p, "transactions_enriched").count() == 2


def test_unknown_masters_stop_the_pipeline(spark, raw):
    p = pipeline(spark, raw, check_masters=True)
    with pytest.raises(Exception, match="_id_is_not_null is violated"):
        medallion_run(spark, p)
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read(spark, p, "transactions_enriched").count()
    put(raw / "users", "2.csv", USER_HEAD, "9,50,F,N,INSERT,2024-01-02 00:00:00")
    more = p.products.union(spark.createDataFrame([("zz", "c", "s")], p.products.schema))
    repaired = Pipeline(**{**p.__dict__, "products": more})
    medallion_run(spark, repaired)
    assert read(spark, repaired, "transactions_enriched").count() == 6


def test_backfill_runs_once_and_never_wins_over_newer_rows(spark, raw, rows):
    put(
        raw / "old", "1.csv", USER_HEAD,
        "1,10,F,N,INSERT,2020-01-01 00:00:00", "3,11,F,N,INSERT,2020-01-01 00:00:00", "4,12,F,N,INSERT,2020-01-01 00:00:00",
    )
    p = pipeline(spark, raw)
    medallion_run(spark, p)
    with_backfill = pipeline(spark, raw, users_backfill=str(raw / "old"))
    medallion_run(spark, with_backfill)
    wanted = [(1, 30), (2, 60), (4, 12)]
    assert rows(users_table(spark, p).current().select("user_id", "age")) == wanted
    put(raw / "old", "2.csv", USER_HEAD, "5,12,F,N,INSERT,2020-01-01 00:00:00")
    medallion_run(spark, with_backfill)
    assert rows(users_table(spark, p).current().select("user_id", "age")) == wanted


def test_compaction(spark, raw, rows):
    p = pipeline(spark, raw)
    medallion_run(spark, p)
    keys = (["user_id"], ["last_updated"])
    new = str(raw / "compacted")
    flows.compact_changes(spark, p.table("users_changes"), new, *keys)
    before = flows.read_changes(spark, p.table("users_changes"), *keys)
    assert rows(flows.read_changes(spark, new, *keys)) == rows(before)
    assert before.where(cdc.DELETED).count() == 1


def test_an_interrupted_batch_is_replaced(spark, raw):
    """A batch written but not committed is written again in place, not twice."""
    target, checkpoints = str(raw / "t"), str(raw / "c")

    def stream():
        return stream_csv(spark, str(raw / "east"), TRANSACTIONS, "r")

    flows.append_flows(target, {"east": stream()}, checkpoints, LIMIT)
    (raw / "c" / "east" / "commits" / "0").unlink()
    for left in (raw / "c" / "east" / "commits").glob(".0*"):
        left.unlink()
    flows.append_flows(target, {"east": stream(), "west": stream_csv(spark, str(raw / "west"), TRANSACTIONS, "r")}, checkpoints, LIMIT)
    assert flows.read_flows(spark, target).count() == 6


def test_rule_counts_of_a_stream(spark, raw):
    for i in range(3):
        shutil.copy(raw / "east" / "1.csv", raw / "east" / f"more{i}.csv")
    for _ in range(2):  # the second run has nothing new to count
        stream = stream_csv(spark, str(raw / "east"), TRANSACTIONS, "r", max_bytes=1)
        (query,) = flows.append_flows(str(raw / "t"), {"east": stream}, str(raw / "c"), LIMIT, fv.TRANSACTION_RULES)
    assert flows.counts_by_flow(spark, str(raw / "t")) == {
        "east": {"n_rows": 12, "quantity_is_more_than_1": 8, "transaction_price_is_more_than_0": 0}
    }
    assert flows.counts_by_flow(spark, str(raw / "nothing")) == {}


def test_reserved_names_are_refused(spark, raw):
    put(raw / "odd", "1.csv", "user_id,batch,flow", "1,2,x")
    columns = "user_id int, batch int, flow string"
    flows.append_flows(str(raw / "t"), {"a": stream_csv(spark, str(raw / "odd"), columns, "r")}, str(raw / "c"), LIMIT)
    assert [tuple(r) for r in flows.read_flows(spark, str(raw / "t")).select("user_id", "batch", "flow").collect()] == [(1, 2, "x")]
    taken = stream_csv(spark, str(raw / "odd"), columns, "Tarnwork_Flow")
    with pytest.raises(Exception, match="cannot have a column of this name"):
        flows.append_flows(str(raw / "t2"), {"a": taken}, str(raw / "c2"), LIMIT)


def test_an_interrupted_backfill_goes_on(spark, raw):
    put(raw / "users", "2.csv", USER_HEAD, "7,30,F,N,INSERT,2024-01-02 00:00:00")
    target, checkpoint = str(raw / "t"), str(raw / "c" / "old")

    def feed():
        return stream_csv(spark, str(raw / "users"), USERS, "r", max_bytes=1)

    whole = flows.batch_writer(target, "old", lambda df: cdc.latest_changes(df, ["user_id"], ["last_updated"], "operation = 'DELETE'"))

    def breaks(batch, batch_id):
        if batch_id:
            raise OSError("disk full")
        whole(batch, batch_id)

    with pytest.raises(Exception, match="disk full"):
        flows.finish([flows.start(feed(), breaks, checkpoint, "old")], LIMIT)
    how = (target, "old", checkpoint, ["user_id"], ["last_updated"], "operation = 'DELETE'")
    flows.finish([flows.cdc_flow(feed(), *how, once=True)], LIMIT)
    flows.mark_finished(spark, checkpoint)
    assert flows.read_flows(spark, target).count() == 4
    assert flows.cdc_flow(feed(), *how, once=True) is None


def test_all_streams_stop_when_one_fails(spark, raw):
    def breaks(batch, batch_id):
        raise OSError("gone")

    def never_ends(batch, batch_id):
        time.sleep(60)

    streams = [stream_csv(spark, str(raw / f), TRANSACTIONS, "r") for f in ("east", "west")]
    queries = [flows.start(s, w, str(raw / "c" / w.__name__), w.__name__) for s, w in zip(streams, (breaks, never_ends))]
    with pytest.raises(Exception, match="gone"):
        flows.finish(queries, LIMIT)
    assert not any(q.isActive for q in queries)


def test_many_batches(spark, raw, rows):
    for i in range(4):
        shutil.copy(raw / "east" / "1.csv", raw / "east" / f"more{i}.csv")
    stream = stream_csv(spark, str(raw / "east"), TRANSACTIONS, "r", max_bytes=100)
    (query,) = flows.append_flows(str(raw / "t"), {"east": stream}, str(raw / "c"), LIMIT)
    stored = spark.read.parquet(str(raw / "t"))
    assert stored.select("tarnwork_batch").distinct().count() > 1
    assert stored.count() == 15


def test_a_slow_stream_is_stopped(spark, raw):
    import time

    def slow(batch, _):
        time.sleep(6)

    query = flows.start(stream_csv(spark, str(raw / "east"), TRANSACTIONS, "r"), slow, str(raw / "c"), "slow")
    with pytest.raises(TimeoutError):
        flows.finish([query], 1)
    assert not query.isActive


def test_enrich_takes_streams(spark, raw):
    from tarnwork.operators.joins import enrich

    users = spark.createDataFrame([(1, 30)], "user_id int, age int")
    joined = enrich(stream_csv(spark, str(raw / "east"), TRANSACTIONS, "r"), [(users, "user_id")], hot_share=0.1)
    assert joined.isStreaming
    flows.append_flows(str(raw / "t"), {"e": joined}, str(raw / "c"), LIMIT)
    assert flows.read_flows(spark, str(raw / "t")).where(F.col("age") == 30).count() == 2


def test_a_stream_before_its_first_file(spark, raw):
    (raw / "later").mkdir()

    def run():
        stream = stream_csv(spark, str(raw / "later"), TRANSACTIONS, "r")
        flows.append_flows(str(raw / "t"), {"later": stream}, str(raw / "c"), LIMIT)

    run()
    put(raw / "later", "1.csv", HEAD, "1,p1,2,10.0")
    run()
    assert flows.read_flows(spark, str(raw / "t")).count() == 1


def test_hot_keys_in_the_pipeline(spark, raw, rows):
    p = pipeline(spark, raw, hot_share=0.3)
    medallion_run(spark, p)
    assert read(spark, p, "transactions_enriched").count() == 6
    by_segment = rows(gold_views(spark, p)["revenue_by_user_segment"].current())
    assert by_segment == [("シニア層", None, None, 40.0), ("シニア層", "M", "S", 20.0), ("若年層", "F", "N", 15.0)]


def test_the_pipeline_named_in_the_session(spark, raw, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    pipeline(spark, raw).products.write.mode("overwrite").saveAsTable("shop.products_source")
    home = tmp_path / "volumes" / "main" / "shop"
    for old, new in {"east": "transactions_east", "west": "transactions_west", "users": "users"}.items():
        shutil.copytree(raw / old, home / "raw_data" / new)
    spark.conf.set("catalog_name", "main")
    spark.conf.set("schema_name", "shop")
    p = pipeline_from_conf(spark, str(tmp_path / "volumes"), TRANSACTIONS, USERS, timeout=LIMIT)
    medallion_run(spark, p)
    assert read(spark, p, "transactions_enriched").count() == 6
    assert p.root == str(home / "tables")


def test_the_pipeline_before_its_first_user(spark, raw, rows):
    (raw / "nobody").mkdir()
    p = Pipeline(**{**pipeline(spark, raw).__dict__, "users": str(raw / "nobody")})
    medallion_run(spark, p)
    assert read(spark, p, "transactions_enriched").where("age IS NULL").count() == 6


def test_a_run_rewrites_what_it_has_changes_for(spark, raw):
    p = pipeline(spark, raw, buckets=8)
    medallion_run(spark, p)
    users, view = users_table(spark, p), gold_views(spark, p)["revenue_by_subcategory"]
    before, groups = users.manifest()["parts"], view.manifest()["parts"]
    put(raw / "users", "2.csv", USER_HEAD, "2,20,M,W,UPDATE,2024-02-01 00:00:00")
    put(raw / "east", "2.csv", HEAD, "2,p1,1,7.0")
    medallion_run(spark, p)
    assert sum(before[b] != f for b, f in users.manifest()["parts"].items() if b in before) == 1
    assert sum(groups[b] != f for b, f in view.manifest()["parts"].items() if b in groups) == 1


def test_readers_keep_the_old_version_when_a_run_stops(spark, raw, rows, monkeypatch):
    """Killed between writing and switching: users, products and gold show what they showed, and the next run makes up for it."""
    from tarnwork.operators.versions import VersionedTable

    p = pipeline(spark, raw)
    medallion_run(spark, p)
    tables = [users_table(spark, p), products_table(spark, p), *gold_views(spark, p).values()]
    shown = [rows(t.read()) for t in tables]
    put(raw / "users", "2.csv", USER_HEAD, "2,20,M,W,UPDATE,2024-02-01 00:00:00")
    put(raw / "east", "2.csv", HEAD, "2,p1,1,7.0")
    switch = VersionedTable._switch
    for name in ("users", "products", "revenue_by_subcategory", "revenue_by_user_segment"):

        def stop(self, manifest, name=name):
            if self.path.endswith(name):
                raise OSError("killed")
            return switch(self, manifest)

        monkeypatch.setattr(VersionedTable, "_switch", stop)
        with pytest.raises(Exception, match="killed"):
            medallion_run(spark, p)
        stopped = [t for t in tables if t.path.endswith(name)]
        assert [rows(t.read()) for t in stopped] == [s for t, s in zip(tables, shown, strict=True) if t in stopped]
    monkeypatch.setattr(VersionedTable, "_switch", switch)
    medallion_run(spark, p)
    assert rows(users_table(spark, p).current().select("user_id", "age")) == [(1, 30), (2, 20)]
    assert rows(gold_views(spark, p)["revenue_by_subcategory"].current()) == [(None, None), ("s1", 62.0), ("s2", 20.0)]


def test_files_with_headers_of_their_own(spark, raw, rows):
    put(raw / "many", "1.csv", "user_id,note,quantity", "1,hi,2")
    put(raw / "many", "2.csv", "quantity,USER_ID,product_id", "3,2,p1", "x,2,p1", "4,2")
    put(raw / "many", "3.csv", "user_id,quantity")

    def run():
        flows.append_flows(str(raw / "t"), {"a": CsvFiles(spark, str(raw / "many"), TRANSACTIONS, "r")}, str(raw / "c"), LIMIT)
        return rows(flows.read_flows(spark, str(raw / "t")).select("user_id", "product_id", "quantity", "r"))

    first = [
        (1, None, 2, '{"note":"hi"}'), (2, None, 4, '{"_corrupt_record":"4,2"}'), (2, "p1", None, '{"quantity":"x"}'), (2, "p1", 3, None)
    ]
    assert run() == first
    put(raw / "many", "4 [new] 50%.csv", "transaction_price,extra,user_id", '1.5,"a,b",9')
    put(raw / "many", "empty.csv")
    (raw / "many" / "empty.csv").write_text("")
    assert run() == [*first, (9, None, None, '{"extra":"a,b"}')]
