"""CSV and JSON readers, type inference and rescue of values that do not fit.

Keyword options go to Spark's CSV reader: ``escape='"'`` for files that double
their quotes, ``encoding``, ``sep`` and so on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"
Schema = T.StructType | str


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def header_columns(spark: SparkSession, path: str, **options) -> list[str]:
    """Column names from the header line; reads the head of one file."""
    return spark.read.options(**{**options, "header": True}).csv(path).columns


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0, **options) -> T.StructType:
    """Types guessed from a one-off batch read.

    On a large directory pass a small ratio: values that turn out not to fit
    the guess are rescued, not lost.
    """
    reader = spark.read.options(**{**options, "header": True, "inferSchema": True})
    return reader.option("samplingRatio", sampling_ratio).csv(path).schema


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


# Header names are checked against the schema file by file, so a file whose
# columns come in another order stops the read instead of shifting values.
_CSV = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    rescue: str | None = None,
    sampling_ratio: float = 1.0,
    **options,
) -> DataFrame:
    """CSV with a header line; types inferred unless given.

    With ``rescue`` a column of that name keeps what does not fit the schema, and each file is read by its own header.
    """
    if schema is None:
        schema = infer_schema(spark, path, sampling_ratio, **options)
    if rescue is None:
        return spark.read.options(**{**options, **_CSV}).schema(schema).csv(path)
    files = CsvFiles(spark, path, schema, rescue, options=options)
    return files.rows(files.lines(spark.read))


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: Schema,
    rescue: str,
    max_bytes: int | None = None,
    **options,
) -> DataFrame:
    """New CSV files of a directory as a stream, each read once per checkpoint.

    ``max_bytes`` bounds one micro-batch.
    """
    schema = _struct(schema)
    try:
        columns = header_columns(spark, path, **options)
    except AnalysisException:  # no file has come yet
        columns = schema.names
    reader = spark.readStream.schema(_text_schema(columns))
    reader = reader.options(**{**options, **_CSV})
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return with_rescue(reader.csv(path), schema, rescue)


@dataclass(frozen=True)
class CsvFiles:
    """CSV files of a directory, each with a header of its own: other columns, or the same in another order.

    A stream hands on the files' lines; ``rows`` reads the files that a micro-batch of them comes from. Files are
    grouped by their first line, each group is read in its own columns, and the groups are united by name. Names that
    differ from the schema's in case only count as the schema's; columns it does not know go to ``rescue``.
    ``max_bytes`` bounds one micro-batch. The driver holds one path and header for each of a batch's files, as Spark's own file list does.
    """

    spark: SparkSession
    path: str
    schema: Schema
    rescue: str
    max_bytes: int | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    def lines(self, reader) -> DataFrame:
        """``line, file, first_block`` by ``spark.read`` or ``spark.readStream``."""
        separator = self.options.get("lineSep")
        reader = reader.option("lineSep", separator) if separator else reader
        return reader.schema("value string").text(self.path).select(
            F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("first_block")
        )

    def stream(self) -> DataFrame:
        reader = self.spark.readStream
        return self.lines(reader.option("maxBytesPerTrigger", self.max_bytes) if self.max_bytes else reader)

    def rows(self, lines: DataFrame) -> DataFrame:
        """The typed rows of the files that the lines come from."""
        first = lines.where("first_block").select("file", "line").mapInArrow(_first_lines, "file string, line string")
        groups: dict[str, set[str]] = {}
        for row in first.collect():
            groups.setdefault(row.line, set()).add(literal_path(row.file))
        schema = _struct(self.schema)
        known = {f.name.lower(): f.name for f in schema}
        parts = []
        for _, paths in sorted(groups.items()):
            names = header_columns(self.spark, min(paths), **self.options)
            raw = self.spark.read.options(**{**self.options, **_CSV, "enforceSchema": True}).schema(_text_schema(names)).csv(sorted(paths))
            spelled = []
            for name in names:
                spelled.append(name if name.lower() in spelled else known.setdefault(name.lower(), name))
            parts.append(raw.toDF(*spelled, CORRUPT))
        if not parts:
            parts = [self.spark.createDataFrame([], _text_schema(schema.names))]
        return with_rescue(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), schema, self.rescue)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each file's first row; a file's first block lies in one task, its lines in order. (Built-in aggregates of texts would sort them all.)"""
    last = None
    for batch in batches:
        files = batch.column("file")
        ends = pc.run_end_encode(files).run_ends.to_pylist()
        for at in [0, *ends[:-1]] if len(files) else []:
            if files[at].as_py() != last:
                last = files[at].as_py()
                yield batch.slice(at, 1)


def literal_path(uri: str) -> str:
    """A file's address as a reader takes it: decoded, with the signs that readers take for patterns marked."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*([+-]?Infinity|NaN)\s*$"
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"


def _form(data_type: T.DataType) -> str | None:
    """What a text must look like where Spark's cast would take more than the type says: suffixes, rest of a line, lost digits."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _NUMBER
    if isinstance(data_type, T.DecimalType):
        s = data_type.scale
        return rf"^\s*[+-]?(\d+(\.\d{{0,{s}}}0*)?|\.\d{{1,{max(1, s)}}}0*)\s*$"
    if isinstance(data_type, T.DateType):
        return rf"^\s*{_DAY}\s*$"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return rf"^\s*{_DAY}([ T]\d{{1,2}}:\d{{1,2}}(:\d{{1,2}}(\.\d{{1,6}}0*)?)?\s?(Z|[+-]\d{{1,2}}:?\d{{2}})?)?\s*$"
    return None


def read_as(text: Column, data_type: T.DataType) -> Column:
    """The value a text stands for, NULL unless it has the type's form and loses nothing."""
    form = _form(data_type)
    value = text.try_cast(data_type)
    return F.when(text.rlike(form), value) if form else value


def with_rescue(df: DataFrame, schema: Schema, rescue: str) -> DataFrame:
    """Type a frame of texts, keeping what is left over as JSON in one column.

    Left over are texts that cannot be read as the declared type, columns the
    schema does not know, and whole lines with too many or too few values.
    The column is NULL for rows that fit.
    """
    schema = _struct(schema)
    typed, leftover = [], []
    for field in schema:
        if field.name not in df.columns:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = _quoted(field.name)
        value = read_as(text, field.dataType)
        typed.append(value.alias(field.name))
        leftover.append(F.when(text.isNotNull() & value.isNull(), text).alias(field.name))
    leftover += [_quoted(c).alias(c) for c in df.columns if c not in schema.names]
    rescued = F.nullif(F.to_json(F.struct(*leftover)), F.lit("{}"))
    return df.select(*typed, rescued.alias(rescue))


def scan_json_array(
    spark: SparkSession, path: str, schema: Schema | None = None, multi_line: bool = True
) -> DataFrame:
    """JSON arrays of flat objects, one row per object.

    A file is one array; with ``multi_line=False`` each line is, and large
    files are split among tasks.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)
