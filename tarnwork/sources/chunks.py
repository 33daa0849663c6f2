"""Statement results that come in chunk files, as a Spark data source: one partition for each chunk.

A result is a folder with ``manifest.json`` (``columns`` with ``name`` and ``type``, ``chunks`` with ``file`` and ``row_count``)
and the chunk files, each a JSON array of rows. A chunk is read by one task; one that is cut off, or holds more or fewer rows than
the manifest says, stops the read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType, VariantType

FORMAT = "statement_chunks"
_NESTED = (ArrayType, MapType, StructType, BinaryType, VariantType)


def read_text(path: str) -> str:
    """A file's text; a bare path or ``file:`` is a mounted folder."""
    store, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    with store.open_input_stream(place) as stream:
        return stream.read().decode()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Chunk(InputPartition):
    def __init__(self, file: str, row_count: int) -> None:
        super().__init__(file)
        self.file, self.row_count = file, row_count


class StatementChunks(DataSource):
    """``spark.read.format("statement_chunks").load(folder)``; all columns are text, as the service delivers them."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def manifest(self) -> dict:
        return json.loads(read_text(f"{self.options['path'].rstrip('/')}/manifest.json"))

    def schema(self) -> str:
        return ", ".join(f"{_quoted(c['name'])} string" for c in self.manifest()["columns"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ChunkReader(self.options["path"].rstrip("/"), self.manifest(), len(schema))


class ChunkReader(DataSourceReader):
    def __init__(self, path: str, manifest: dict, width: int) -> None:
        self.path, self.chunks, self.width = path, manifest["chunks"], width

    def partitions(self) -> list[InputPartition]:
        return [Chunk(c["file"], c["row_count"]) for c in self.chunks]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        try:
            rows = json.loads(read_text(f"{self.path}/{partition.file}"))
        except ValueError as e:
            raise ValueError(f"chunk {partition.file} is cut off or no JSON: {e}") from e
        if len(rows) != partition.row_count:
            raise ValueError(f"chunk {partition.file} has {len(rows)} rows, the manifest says {partition.row_count}")
        for row in rows:
            if len(row) != self.width:
                raise ValueError(f"chunk {partition.file}: a row has {len(row)} values for {self.width} columns")
            yield tuple(None if v is None else v if isinstance(v, str) else json.dumps(v) for v in row)


def read_chunks(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """The whole result; with ``typed`` in the manifest's types, where a text that is none stops the read."""
    spark.dataSource.register(StatementChunks)
    df = spark.read.format(FORMAT).load(path)
    if not typed:
        return df
    columns = json.loads(read_text(f"{path.rstrip('/')}/manifest.json"))["columns"]
    schema = StructType.fromDDL(", ".join(f"{_quoted(c['name'])} {c['type']}" for c in columns))
    if nested := [f.name for f in schema if isinstance(f.dataType, _NESTED)]:
        raise ValueError(f"columns of these types are not read: {', '.join(nested)}")
    return df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in schema])
