"""Zone maps: what each file holds of some columns, stored beside the rows, so that a reader opens only files that can have what it looks for.

A zone map is a table under ``<path>/_zones`` (readers of the rows pass over it): per file and column the least and
largest value, whether there are NULLs, and Bloom bits. A file that is passed over can hold no wanted row; one that is opened may.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tarnwork.operators.tables import clustered_write
from tarnwork.sources.files import literal_path

#: Bits of one bitmap of Spark's; a file's Bloom filter has several of them.
BITMAP_BITS = 8 * 4096
HASHES = 3


def _columns_of(schema: T.StructType, names: Sequence[str]) -> list[T.StructField]:
    unknown = [n for n in names if n not in schema.names]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}")
    return [schema[n] for n in names]


def _bits(value: Column, bitmaps: int) -> Column:
    """The places that a value sets in a filter of ``bitmaps`` times ``BITMAP_BITS`` bits."""
    return F.array(*[F.pmod(F.xxhash64(value, F.lit(k)), F.lit(bitmaps * BITMAP_BITS)) for k in range(HASHES)])


def write_zoned(df: DataFrame, path: str, keys: Sequence[str], n_files: int, zoned: Sequence[str] | None = None, bitmaps: int = 4) -> None:
    """Write rows clustered by ``keys`` into ``n_files`` files, and the zone map of the columns ``zoned`` (by default the keys).

    ``bitmaps`` times 4 KB hold a file's Bloom bits of a column: at 8 bits a distinct value one in thirty foreign values passes.
    """
    spark, fields = df.sparkSession, _columns_of(df.schema, zoned or keys)
    clustered_write(df, path, keys, n_files)
    stored = spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_path").alias("file"), *[f"`{f.name}`" for f in fields])
    ranges, blooms = [], []
    for field in fields:
        value = F.col(f"`{field.name}`")
        ranges.append(
            stored.groupBy("file").agg(F.min(value).cast("string").alias("least"), F.max(value).cast("string").alias("most"), F.count_if(value.isNull()).alias("nulls"))
            .withColumn("column", F.lit(field.name))
        )
        # Equal values meet before their bits are set; each (file, bitmap) is 4 KB, set map-side.
        bits = stored.where(value.isNotNull()).select("file", F.explode(_bits(value, bitmaps)).alias("bit"))
        blooms.append(
            bits.groupBy("file", F.floor(F.col("bit") / BITMAP_BITS).cast("int").alias("bitmap"))
            .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bits")).withColumn("column", F.lit(field.name))
        )
    _union(ranges).write.mode("overwrite").parquet(f"{path}/_zones/ranges")
    _union(blooms).write.mode("overwrite").parquet(f"{path}/_zones/blooms")
    about = json.dumps({"schema": df.schema.jsonValue(), "bitmaps": bitmaps, "zoned": [f.name for f in fields]})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_zones/about")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class ZonedTable:
    """Rows with a zone map. ``opened`` gives the files a search has to open, ``read`` their rows that meet it."""

    spark: SparkSession
    path: str

    def _about(self) -> dict:
        return json.loads(self.spark.read.parquet(f"{self.path}/_zones/about").first()[0])

    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/_zones/ranges").select("file").distinct()

    def _survivors(self, about: Mapping, column: str, low, high) -> DataFrame:
        kind = T.StructType.fromJson(about["schema"])[column].dataType
        if column not in about["zoned"]:
            raise ValueError(f"the zone map has no column {column}")
        ranges = self.spark.read.parquet(f"{self.path}/_zones/ranges").where(F.col("column") == column)
        typed = lambda c: F.col(c).cast(kind)
        if low is not None:
            ranges = ranges.where(typed("most") >= F.lit(low).cast(kind))
        if high is not None:
            ranges = ranges.where(typed("least") <= F.lit(high).cast(kind))
        return ranges.select("file")

    def opened(self, **wanted) -> DataFrame:
        """``file``: those that can hold rows with the wanted values: ``column=value``, or ``column=(low, high)`` with None for an open end."""
        about, files = self._about(), self.files()
        for column, value in wanted.items():
            if isinstance(value, tuple):
                files = files.join(self._survivors(about, column, *value), "file", "left_semi")
            else:
                keys = self.spark.range(1).select(F.lit(value).cast(T.StructType.fromJson(about["schema"])[column].dataType).alias("key"))
                files = files.join(self._survivors(about, column, value, value), "file", "left_semi").join(self._bloomed(about, column, keys), "file", "left_semi")
        return files

    def _bloomed(self, about: Mapping, column: str, keys: DataFrame) -> DataFrame:
        """Files whose bits hold all bits of some key: bits of keys meet the files' bitmaps by their number, never key by key."""
        of_keys = keys.select("key", F.explode(_bits(F.col("key"), about["bitmaps"])).alias("bit")).distinct()
        of_keys = of_keys.withColumn("bitmap", F.floor(F.col("bit") / BITMAP_BITS).cast("int"))
        blooms = self.spark.read.parquet(f"{self.path}/_zones/blooms").where(F.col("column") == column).select("file", "bitmap", "bits")
        place = (F.col("bit") % BITMAP_BITS).cast("int")
        byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, CAST(bit % 8 AS INT))")) != 0
        wanted = of_keys.groupBy("key").agg(F.count("*").alias("wanted"))
        hits = of_keys.join(blooms, "bitmap").where(is_set).groupBy("file", "key").agg(F.count("*").alias("found"))
        return hits.join(wanted, "key").where("found = wanted").select("file").distinct()

    def _rows(self, files: DataFrame, about: Mapping) -> DataFrame:
        names = sorted(literal_path(r.file) for r in files.collect())  # as many as the table has files, as Spark lists them
        schema = T.StructType.fromJson(about["schema"])
        return self.spark.read.schema(schema).parquet(*names) if names else self.spark.createDataFrame([], schema)

    def read(self, **wanted) -> DataFrame:
        """The rows that meet the search; only files of ``opened`` are read."""
        about, rows = self._about(), None
        rows = self._rows(self.opened(**wanted), about)
        for column, value in wanted.items():
            c = F.col(f"`{column}`")
            if not isinstance(value, tuple):
                rows = rows.where(c == F.lit(value))
                continue
            rows = rows.where(c >= F.lit(value[0])) if value[0] is not None else rows
            rows = rows.where(c <= F.lit(value[1])) if value[1] is not None else rows
        return rows

    def read_for(self, keys: DataFrame, column: str, key: str, most_keys: int = 1_000_000) -> DataFrame:
        """Rows of files that can hold one of the keys, for a join on a column the files are not partitioned by.

        Keys beyond ``most_keys`` are looked for by their range alone. All rows that have a partner among the keys are there; others may be.
        """
        about = self._about()
        values = keys.select(F.col(key).cast(T.StructType.fromJson(about["schema"])[column].dataType).alias("key")).where("key IS NOT NULL").distinct()
        low, high, n = values.agg(F.min("key"), F.max("key"), F.count("*")).first()
        if not n:
            return self._rows(self.files().limit(0), about)
        files = self.files().join(self._survivors(about, column, low, high), "file", "left_semi")
        if n <= most_keys:
            files = files.join(self._bloomed(about, column, values), "file", "left_semi")
        return self._rows(files, about)
