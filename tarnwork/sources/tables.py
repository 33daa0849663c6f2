"""Tables read as a batch or a stream, and what they look like on disk."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_tables(spark: SparkSession, directory: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{directory}/{name}.parquet") for name in names]


def scan_table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A parquet directory as an append stream, its schema pinned at the start."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def table_detail(table: DataFrame) -> DataFrame:
    """Number of files, rows and bytes of a file-backed table; files without rows count.

    Reads no data column: names and sizes come from the file listing.
    """
    files = table.sparkSession.read.format("binaryFile").load(sorted(set(table.inputFiles()))).select("length")
    sizes = files.agg(F.count("*").alias("num_files"), F.sum("length").alias("size_in_bytes"))
    rows = table.agg(F.count("*").alias("num_rows"))
    return sizes.select("num_files", rows.scalar().alias("num_rows"), "size_in_bytes")


def table_schema(spark: SparkSession, table: DataFrame) -> DataFrame:
    """Column names and types of a frame, in order."""
    rows = [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment")) for i, f in enumerate(table.schema)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, comment string")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its name and number of rows, by name."""
    counts = [t.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
