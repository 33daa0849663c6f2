"""Contiguous shards of near equal byte size, cut by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, global_prefix, table
from tarnwork.llm.registry import query


def balanced_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """One row per row of ``df``: ``id, size, text_crc32, shard, slot``.

    Rows stand in one global order (id, then checksum and size of the text; NULL
    ids first). Byte sizes are summed per contiguous range of that order, the
    ranges' totals give each row its global offset, and the byte line is cut at
    ``n_shards`` equal targets; a row goes where its middle byte lies, so a shard
    misses its target by less than one row's size. ``slot`` counts from 0 within the shard.

    Equal texts are not kept together: their ids decide where they go. A NULL text counts as no bytes. A row larger than a target leaves the shards
    it spans empty. Repeated rows each get a slot of their own. An empty table
    gives no rows. Other columns are ignored, whatever they are called.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    text = F.coalesce(col(text_col), F.lit(""))
    rows = df.select(col(id_col).alias("id"), (F.octet_length(text).cast("long") + overhead).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = global_prefix(rows, [F.col("id"), F.col("text_crc32"), F.col("size")], ["size"], "shards")
    # Twice the middle byte against twice the total: all in whole numbers.
    at = F.expr(f"(2 * CAST(size_before AS DECIMAL(38, 0)) + size) * {n_shards} div (2 * size_total)")
    cut = placed.withColumn("shard", F.least(at.cast("int"), F.lit(n_shards - 1)))
    firsts = cut.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return cut.join(F.broadcast(firsts), "shard").select(  # firsts: one row per shard
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("rank") - F.col("first_rank")).alias("slot")
    )


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near equal bytes."""
    return balanced_shards(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
