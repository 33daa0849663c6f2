"""The retail pipeline: raw files to bronze, silver and gold tables under one root folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tarnwork.functions.scalars import age_bucket
from tarnwork.operators.joins import enrich, match_audit
from tarnwork.operators.project import with_rule_flag
from tarnwork.operators.quality import expect
from tarnwork.operators.versions import IncrementalView, KeyedTable, VersionedTable, refresh_each
from tarnwork.sources.files import CsvFiles
from tarnwork.streaming import flows

MASTER_RULES = {"product_id_is_not_null": "product_id_matched", "user_id_is_not_null": "user_id_matched"}


@dataclass(frozen=True)
class Pipeline:
    """Where the raw files are, what they hold and where the tables go.

    ``rules`` sends transactions that break them to ``transactions_invalid``.
    ``check_masters`` stops the run at a transaction of an unknown user or product.
    ``hot_share`` is the share of a batch above which a key is joined apart.
    ``buckets`` folders hold the users, and a view's groups; a run rewrites those it has changes for.
    """

    root: str
    transactions: Mapping[str, str]
    transaction_schema: T.StructType | str
    users: str
    user_schema: T.StructType | str
    products: DataFrame
    users_backfill: str | None = None
    rules: Mapping[str, str] = field(default_factory=dict)
    null_as: str = "invalid"
    check_masters: bool = False
    hot_share: float | None = None
    buckets: int = 4
    max_bytes: int | None = None
    timeout: int | None = None

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def pipeline_from_conf(
    spark: SparkSession,
    base: str,
    transaction_schema: T.StructType | str,
    user_schema: T.StructType | str,
    backfill: bool = False,
    **options,
) -> Pipeline:
    """The pipeline of the catalog and schema named in the session's ``catalog_name`` and ``schema_name``.

    Raw files lie under ``<base>/<catalog>/<schema>/raw_data``; products come from the table ``products_source``.
    """
    schema = spark.conf.get("schema_name")
    home = f"{base}/{spark.conf.get('catalog_name')}/{schema}"
    return Pipeline(
        root=f"{home}/tables",
        transactions={flow: f"{home}/raw_data/transactions_{flow}" for flow in ("east", "west")},
        transaction_schema=transaction_schema,
        users=f"{home}/raw_data/users",
        user_schema=user_schema,
        products=spark.read.table(f"{schema}.products_source"),
        users_backfill=f"{home}/raw_data/users_backfill" if backfill else None,
        **options,
    )


USER_KEY, USER_SEQUENCE = ["user_id"], ["last_updated"]


def users_table(spark: SparkSession, p: Pipeline) -> KeyedTable:
    """Users as the change feeds left them; ``users_changes`` keeps the feeds' newest changes by micro-batch."""
    return KeyedTable(spark, p.table("users"), USER_KEY, USER_SEQUENCE, p.buckets)


def products_table(spark: SparkSession, p: Pipeline) -> VersionedTable:
    return VersionedTable(spark, p.table("products"))


def bronze(spark: SparkSession, p: Pipeline) -> dict[str, dict[str, int]]:
    """Take in new files; gives per flow how many new rows broke each rule."""
    landing = "transactions_all" if p.rules else "transactions"

    def flagged(batch: DataFrame) -> DataFrame:
        return with_rule_flag(batch, p.rules, "valid") if p.rules else batch

    before = flows.counts_by_flow(spark, p.table(landing)) if p.rules else {}
    started = []
    for flow, path in p.transactions.items():
        files = CsvFiles(spark, path, p.transaction_schema, "_rescued_data_transactions", p.max_bytes)
        write = flows.batch_writer(p.table(landing), flow, flagged, p.rules, read=files.rows)
        started.append(flows.start(files.stream(), write, p.checkpoint(f"{landing}/{flow}"), flow))
    feeds, users = {"users": (p.users, False)}, users_table(spark, p)
    if p.users_backfill:
        feeds["backfill"] = (p.users_backfill, True)
    for flow, (path, once) in feeds.items():
        query = flows.cdc_flow(
            CsvFiles(spark, path, p.user_schema, "_rescued_data_users", p.max_bytes),
            p.table("users_changes"),
            flow,
            p.checkpoint(f"users/{flow}"),
            USER_KEY,
            USER_SEQUENCE,
            "operation = 'DELETE'",
            ["operation"],
            once,
            users,
        )
        started += [query] if query else []
    flows.finish(started, p.timeout)
    if p.users_backfill:
        flows.mark_finished(spark, p.checkpoint("users/backfill"))
    if not users.versions():  # no change has come yet
        nothing = spark.createDataFrame([], "line string, file string, first_block boolean")
        users.take(CsvFiles(spark, p.users, p.user_schema, "_rescued_data_users").rows(nothing), "operation = 'DELETE'", ["operation"])
    products_table(spark, p).publish(p.products)
    if p.rules:
        split_by_flag(spark, p)
    after = flows.counts_by_flow(spark, p.table(landing)) if p.rules else {}
    new = {f: {name: n - before.get(f, {}).get(name, 0) for name, n in after.get(f, {}).items()} for f in p.transactions}
    return {f: counts if counts.get("n_rows") else {} for f, counts in new.items()}


def split_by_flag(spark: SparkSession, p: Pipeline) -> None:
    """Two streams over the landing table: valid rows to one table, the others to another."""
    flag = F.col("valid") if p.null_as == "drop" else F.coalesce("valid", F.lit(False))
    started = []
    for name, keep in {"transactions": flag, "transactions_invalid": ~flag}.items():
        rows = flows.stream_flows(spark, p.table("transactions_all")).where(keep).drop("valid")
        started.append(flows.start(rows, flows.batch_writer(p.table(name), name), p.checkpoint(name), name))
    flows.finish(started, p.timeout)


def silver(spark: SparkSession, p: Pipeline) -> None:
    """Each micro-batch of transactions meets the users and products as they are at that time."""

    def add_masters(batch: DataFrame) -> DataFrame:
        session = batch.sparkSession
        dims = [(users_table(session, p).current(), "user_id"), (products_table(session, p).read(), "product_id")]
        enriched = enrich(batch, dims, p.hot_share)
        if not p.check_masters:
            return enriched
        flags = [f"{key}_matched" for _, key in dims]
        return expect(match_audit(enriched, dims), MASTER_RULES, "fail").drop(*flags)

    stream = flows.stream_flows(spark, p.table("transactions"))
    write = flows.batch_writer(p.table("transactions_enriched"), "enrich", add_masters)
    flows.finish([flows.start(stream, write, p.checkpoint("transactions_enriched"), "enrich")], p.timeout)


def gold_views(spark: SparkSession, p: Pipeline) -> dict[str, IncrementalView]:
    """Revenue by subcategory, and by age group, gender and region."""
    revenue = {"sum_revenue": "transaction_price"}
    keys = {"revenue_by_subcategory": ["subcategory"], "revenue_by_user_segment": ["age_group", "gender", "region"]}
    return {name: IncrementalView(spark, p.table(name), k, revenue, buckets=p.buckets) for name, k in keys.items()}


def gold(spark: SparkSession, p: Pipeline) -> None:
    """The views take in the rows that were enriched since the last run."""
    rows = flows.stream_flows(spark, p.table("transactions_enriched")).withColumn("age_group", age_bucket("age"))
    refresh = refresh_each(list(gold_views(spark, p).values()), "gold")
    flows.finish([flows.start(rows, refresh, p.checkpoint("gold"), "gold")], p.timeout)


def medallion_run(spark: SparkSession, p: Pipeline) -> dict[str, dict[str, int]]:
    """Bring all tables up to date. A run without new files changes nothing. Gives bronze's rule counts."""
    counts = bronze(spark, p)
    silver(spark, p)
    gold(spark, p)
    return counts
