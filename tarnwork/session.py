"""Session settings and the scratch folder shared by the whole cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "tarnwork") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Tables written there are read back by every executor, so a machine-local
    folder is only taken where the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-tarnwork-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table in the scratch folder.

    For a result that several later steps read: it is computed once, and a lost
    executor costs a read instead of a recomputation.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession, rows: int = 1000) -> str:
    """From now on Python workers get at most ``rows`` rows at a time; gives the setting from before.

    For steps that send whole texts: Spark's 10,000 rows would be held as a whole, by the executor and by its worker.
    """
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    return before


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """``limit_batches`` for what is run inside."""
    before = limit_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def scratch_database(spark: SparkSession) -> str:
    """A new database whose managed tables lie in the scratch folder."""
    name = f"tarnwork_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'tables')}'")
    return name
