"""Result documents of a SQL statement service as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

STATEMENT_DDL = (
    "statement_response struct<"
    "manifest: struct<schema: struct<columns: array<struct<name: string>>>>, "
    "result: struct<data_array: array<array<string>>>>"
)


def statement_json_to_df(documents: DataFrame, column: str = "value") -> DataFrame:
    """Rows of result documents, one JSON text per input row, as one table.

    Columns come in the order of the manifest and keep their values as
    delivered (text). All documents must share one manifest. Raises
    ``ValueError`` where a document has no columns or no rows.
    """
    doc = F.from_json(column, STATEMENT_DDL)["statement_response"]
    parsed = documents.select(
        doc["manifest"]["schema"]["columns"]["name"].alias("names"),
        doc["result"]["data_array"].alias("data"),
    )
    is_empty = lambda c: F.coalesce(F.size(c) < 1, F.lit(True))
    heads = parsed.select("names", (is_empty("names") | is_empty("data")).alias("empty")).distinct().limit(3).collect()
    if not heads or any(h["empty"] for h in heads):
        raise ValueError("a result document has no columns or no rows")
    if len(heads) > 1:
        raise ValueError("the result documents have different columns")
    names = heads[0]["names"]
    row = F.when(F.size("row") == len(names), F.col("row")).otherwise(
        F.raise_error(F.lit("a row has more or fewer values than the manifest has columns"))
    )
    return (
        parsed.select(F.explode("data").alias("row"))
        .select(row.alias("row"))
        .select(*[F.col("row")[i].alias(name) for i, name in enumerate(names)])
    )
