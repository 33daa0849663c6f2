"""Streams that run until their input is used up, each with its own checkpoint.

A micro-batch goes into a folder named after its flow and number and replaces
what an interrupted try left there, so every input row is stored exactly once.
How many of its rows break each rule is stored beside it in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnwork.operators.cdc import latest_changes
from tarnwork.operators.quality import violation_counts
from tarnwork.operators.versions import KeyedTable
from tarnwork.sources.files import CsvFiles

#: Folder columns of a table; no row may have columns of these names.
FLOW_COLUMNS = ("tarnwork_flow", "tarnwork_batch")


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def finish(queries: Sequence[StreamingQuery], timeout: int | None = None) -> None:
    """Wait for all queries. If one fails or is out of time, all that still run are stopped and the first error is raised."""
    try:
        for query in queries:
            if query.awaitTermination(timeout) is False:
                raise TimeoutError(f"stream {query.name} did not finish in {timeout} s")
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def _folder(target: str, flow: str, batch: int) -> str:
    return f"{target}/{FLOW_COLUMNS[0]}={flow}/{FLOW_COLUMNS[1]}={batch}"


def _counts(target: str) -> str:
    return f"{target}_rule_counts"


def batch_writer(
    target: str,
    flow: str,
    change: Callable[[DataFrame], DataFrame] = lambda df: df,
    rules: Mapping[str, str] | None = None,
    null_as: str = "invalid",
    read: Callable[[DataFrame], DataFrame] = lambda df: df,
):
    """Store each micro-batch, and with ``rules`` a row of how many of its rows there are and break each rule.

    ``read`` makes rows of what the stream hands on (``CsvFiles.rows``). The counts are taken while the rows are
    written, with no further scan.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = read(batch)
        taken = [c for c in batch.columns if c.lower() in FLOW_COLUMNS]
        if taken:
            raise ValueError(f"{', '.join(taken)}: a stored row cannot have a column of this name")
        seen = Observation()
        if rules:
            batch = batch.observe(seen, F.count("*").alias("n_rows"), *violation_counts(rules, null_as))
        change(batch).write.mode("overwrite").parquet(_folder(target, flow, batch_id))
        if rules:
            row = [(name, n) for name, n in seen.get.items()]
            counts = batch.sparkSession.createDataFrame(row, "name string, n bigint")
            counts.coalesce(1).write.mode("overwrite").parquet(_folder(_counts(target), flow, batch_id))

    return write


def source_of(source: DataFrame | CsvFiles) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A stream, and what makes rows of its micro-batches."""
    return (source.stream(), source.rows) if isinstance(source, CsvFiles) else (source, lambda df: df)


def append_flows(
    target: str,
    flows: Mapping[str, DataFrame | CsvFiles],
    checkpoints: str,
    timeout: int | None = None,
    rules: Mapping[str, str] | None = None,
) -> list[StreamingQuery]:
    """Append several streams to one table. A flow added later leaves the others' progress alone."""
    queries = []
    for flow, source in flows.items():
        stream, read = source_of(source)
        queries.append(start(stream, batch_writer(target, flow, rules=rules, read=read), f"{checkpoints}/{flow}", flow))
    finish(queries, timeout)
    return queries


def read_flows(spark: SparkSession, target: str) -> DataFrame:
    """All rows the flows of a table have stored."""
    return spark.read.parquet(target).drop(*FLOW_COLUMNS)


def stream_flows(spark: SparkSession, target: str) -> DataFrame:
    """The same table as a stream. Start it after the flows that fill it have finished."""
    schema = spark.read.parquet(target).schema
    return spark.readStream.schema(schema).parquet(target).drop(*FLOW_COLUMNS)


def cdc_flow(
    feed: DataFrame | CsvFiles,
    target: str,
    flow: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | None = None,
    except_columns: Sequence[str] = (),
    once: bool = False,
    into: KeyedTable | None = None,
) -> StreamingQuery | None:
    """Store the newest change per key of each micro-batch of a change feed.

    Nothing stored is read or rewritten: newest-of-newest is taken on reading
    (``read_changes``), so flows and backfills may run in any order. ``into`` is a keyed table that
    takes the same changes in, so that reading it does not grow with the feed's age. With ``once``
    a flow that ``mark_finished`` was called for does nothing, whatever files have come; one
    that was interrupted goes on where its checkpoint stands.
    """
    feed, read = source_of(feed)
    if once and has_finished(feed.sparkSession, checkpoint):
        return None

    def reduce(batch: DataFrame) -> DataFrame:
        return latest_changes(batch, keys, sequence_by, delete_when, except_columns)

    store = batch_writer(target, flow, reduce, read=read)

    def write(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if into is not None:
            into.take(batch.sparkSession.read.parquet(_folder(target, flow, batch_id)), flow=flow, batch=batch_id)

    return start(feed, write, checkpoint, flow)


def _marker(checkpoint: str) -> str:
    return f"{checkpoint}_finished"


def mark_finished(spark: SparkSession, checkpoint: str) -> None:
    """Note that a flow which runs once has taken in all its input; call it after ``finish``."""
    spark.range(1).write.mode("overwrite").parquet(_marker(checkpoint))


def has_finished(spark: SparkSession, checkpoint: str) -> bool:
    """Whether ``mark_finished`` was called for the checkpoint."""
    try:
        return not spark.read.parquet(_marker(checkpoint)).isEmpty()
    except AnalysisException:
        return False


def read_changes(spark: SparkSession, target: str, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The newest change per key over all flows and batches, tombstones included."""
    return latest_changes(read_flows(spark, target), keys, sequence_by)


def compact_changes(
    spark: SparkSession, target: str, new_target: str, keys: Sequence[str], sequence_by: Sequence[str]
) -> None:
    """Write the newest changes alone to a new folder, where the flows then go on."""
    read_changes(spark, target, keys, sequence_by).write.mode("overwrite").parquet(
        _folder(new_target, "compacted", 0)
    )


def rule_counts(spark: SparkSession, target: str) -> DataFrame:
    """Per flow of a table: rows stored (``n_rows``) and rows that broke each rule, as ``flow, name, n`` over all micro-batches."""
    stored = spark.read.schema(f"name string, n bigint, {FLOW_COLUMNS[0]} string, {FLOW_COLUMNS[1]} bigint").parquet(_counts(target))
    return stored.groupBy(F.col(FLOW_COLUMNS[0]).alias("flow"), "name").agg(F.sum("n").alias("n"))


def counts_by_flow(spark: SparkSession, target: str) -> dict[str, dict[str, int]]:
    """The same as a dictionary by flow; a table without counts gives an empty one."""
    try:
        rows = rule_counts(spark, target).collect()  # one row per flow and rule
    except AnalysisException:
        return {}
    found: dict[str, dict[str, int]] = {}
    for r in rows:
        found.setdefault(r.flow, {})[r["name"]] = r.n
    return found
