"""Writing tables and laying out their files."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnwork.operators.merge import SchemaError, in_target_spelling, merge_upsert


def write_table(df: DataFrame, name: str, mode: str = "overwrite", overwrite_schema: bool = False) -> None:
    """Save as a managed table: ``overwrite``, ``append``, ``ignore`` (only if absent) or ``error``.

    Overwriting keeps the table's columns unless ``overwrite_schema``.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    if mode == "overwrite" and spark.catalog.tableExists(name):
        old = spark.table(name).schema
        by_name = lambda schema: sorted((f.name, f.dataType.json()) for f in schema)
        same = by_name(old) == by_name(df.schema)
        if not same and not overwrite_schema:
            raise ValueError(f"{name} has other columns; pass overwrite_schema=True to replace them")
        replace_table(df, name)
    else:
        df.write.mode(mode).saveAsTable(name)


COMPLETE = "tarnwork.complete"


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish a replacement that was interrupted after the old content went; a copy that was never completed is dropped."""
    staging = f"{name}__new"
    if not spark.catalog.tableExists(staging):
        return
    complete = any(r.key == COMPLETE for r in spark.sql(f"SHOW TBLPROPERTIES {staging}").collect())
    if complete and not spark.catalog.tableExists(name):
        _take_place(spark, staging, name)
    else:
        spark.sql(f"DROP TABLE {staging}")


def _take_place(spark: SparkSession, staging: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{COMPLETE}')")


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a table's content and columns; ``df`` may read the table itself.

    Comments, properties and partition columns are kept as far as the new content has the columns.
    The new content is complete under another name before the old one goes. A
    job that fails before leaves the table as it was; one that fails between is
    finished by the next ``write_table``, ``replace_table`` or ``recover_table``.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    staging = f"{name}__new"
    partition_by, comment, kept = [], None, {}
    if spark.catalog.tableExists(name):
        columns = {c.name: c for c in spark.catalog.listColumns(name)}
        partition_by = [c for c, old in columns.items() if old.isPartition and c in df.columns]
        df = annotate(df, {c: old.description for c, old in columns.items() if old.description and c in df.columns})
        comment = spark.catalog.getTable(name).description
        kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    df.write.partitionBy(*partition_by).saveAsTable(staging)
    annotate_table(spark, staging, comment, {})
    for key, value in {**kept, COMPLETE: "true"}.items():
        spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _take_place(spark, staging, name)


def refresh_view(spark: SparkSession, name: str, query: Callable[[], DataFrame]) -> None:
    """Recompute a stored result in full."""
    write_table(query(), name, overwrite_schema=True)


def insert_rows(df: DataFrame, name: str) -> None:
    """Append by column name. Unknown columns and unsafe casts are refused, nothing is written then."""
    df.sparkSession.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=df)


def add_columns(spark: SparkSession, name: str, columns: Mapping[str, str]) -> None:
    """Add columns to a table's schema alone; rows stored before read NULL. No file is touched."""
    added = ", ".join(f"`{column}` {data_type}" for column, data_type in columns.items())
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")


def merge_into(source: DataFrame, name: str, keys: Sequence[str], evolve: bool = False) -> None:
    """Upsert into a table, rewriting only the partitions the source has rows for.

    The table's partition columns must be among the keys, so that no row
    changes its partition; a table without partitions is replaced as a whole.
    Spark writes the partitions aside and swaps them in when all are written.
    """
    spark = source.sparkSession
    target = spark.table(name)
    source = in_target_spelling(source, target.columns)
    new = {f.name: f.dataType.simpleString() for f in source.schema if f.name not in target.columns}
    if new and not evolve:
        raise SchemaError(f"the table has no column {', '.join(new)}")
    partition_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not partition_by:
        replace_table(merge_upsert(target, source, keys, evolve), name)
        return
    if not set(partition_by) <= set(keys):
        raise ValueError(f"the keys must include the partition columns {', '.join(partition_by)}")
    if new:
        add_columns(spark, name, new)
        target = spark.table(name)
    # As many rows as the source has partitions: one list of literals, which prunes the files of the others. Rows without
    # a partition value lie in a partition of their own; a struct finds it, as its fields are compared null-safe.
    touched = source.select(*partition_by).distinct().collect()
    kinds = {c: target.schema[c].dataType for c in partition_by}
    there = [F.struct(*[F.lit(r[c]).cast(kinds[c]).alias(c) for c in partition_by]) for r in touched]
    wanted = F.struct(*partition_by).isin(*there) if there else F.lit(False)
    merged = merge_upsert(target.where(wanted), source, keys)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        merged.select(*target.columns).write.mode("overwrite").insertInto(name)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """The session's settings changed for a while."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _setting(spark: SparkSession, key: str, value: str):
    return settings(spark, {key: value})


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header line, quotes doubled; for results that the caller knows to be small.

    Only the result goes into one task; what computes it stays spread.
    """
    df.repartition(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


def clustered_write(df: DataFrame, path: str, keys: Sequence[str], n_files: int) -> None:
    """Write so that rows with equal keys lie in few files, sorted within each.

    The row's place in the input breaks ties, so a key that holds a large
    share of the rows is cut over several files instead of filling one.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(n_files, *keys, "_place").sortWithinPartitions(*keys)
    ranged.drop("_place").write.mode("overwrite").parquet(path)


def file_ranges(table: DataFrame, column: str) -> DataFrame:
    """Per file: rows, smallest and largest value of a column."""
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("n_rows"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )


def files_to_read(table: DataFrame, column: str, value: Column | str | int) -> DataFrame:
    """How many files an equality filter has to open, by each file's range of values."""
    wanted = value if isinstance(value, Column) else F.lit(value)
    return file_ranges(table, column).agg(
        F.count("*").alias("files"),
        F.count_if(wanted.between(F.col("min_value"), F.col("max_value"))).alias("files_to_read"),
    )


def analyze_table(spark: SparkSession, name: str, histograms: bool = False) -> None:
    """Store column statistics for the optimizer, with ``histograms`` of equal height too, which tell how much a range filter leaves.

    The optimizer goes by them where ``spark.sql.cbo.enabled`` is set.
    """
    with _setting(spark, "spark.sql.statistics.histogram.enabled", str(histograms).lower()):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_histogram(spark: SparkSession, name: str, column: str) -> DataFrame:
    """``bin, lower, upper, n_distinct`` of a column's stored histogram, whose bins hold equally many rows; no rows without one."""
    told = spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").where("info_name LIKE 'bin\\_%'")
    part = lambda label: F.regexp_extract("info_value", rf"{label}: ([^,]+)", 1)
    return told.select(
        F.substring("info_name", 5, 9).cast("int").alias("bin"), part("lower_bound").cast("double").alias("lower"),
        part("upper_bound").cast("double").alias("upper"), part("distinct_count").cast("bigint").alias("n_distinct"),
    )


def planned_joins(df: DataFrame) -> list[str]:
    """The joins that the optimizer has chosen by what it knows before the run."""
    return re.findall(r"\w+Join\b", df._jdf.queryExecution().sparkPlan().toString())


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float], keys: Sequence[str] = (), k: int = 200) -> DataFrame:
    """``keys..., probability, value``: quantiles by mergeable KLL sketches of some kilobytes, their ranks within about 1.65 / ``k`` (99 %).

    One pass, combined map-side; NULLs count nowhere, groups without a value have none.
    """
    sketches = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("_sketch"))
    found = [F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias("value")) for p in probabilities]
    return sketches.where("_sketch IS NOT NULL").select(*keys, F.inline(F.array(*found)))


def annotate(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments, carried with the frame and into tables saved from it."""
    for name, comment in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": comment})
    return df


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def annotate_table(spark: SparkSession, name: str, comment: str | None, comments: Mapping[str, str]) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    for column, text in comments.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_quoted(text)}")
