"""Helpers that several operators of this folder share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.session import settle

#: A word of the contracts: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_prefix(df: DataFrame, order: list[Column], sums: list[str] = (), label: str = "ordered") -> DataFrame:
    """``df`` with its place in one order over all rows, found without one task seeing all rows.

    Rows are cut into contiguous ranges of the order; each range adds up its own
    rows, and the ranges' totals (one row per range, so at most as many as there
    are shuffle partitions) give the offsets. Adds ``rank`` (from 0), and for
    every name in ``sums`` ``<name>_before`` (sum of all earlier rows) and
    ``<name>_total``. Rows that the order leaves tied get places in no stated
    order, so ``order`` should end in whatever tells rows apart. ``df`` must not
    have columns of these names or one called ``range_no``.
    """
    spark = df.sparkSession
    width = shuffle_width(spark)
    keys = [f"order_key_{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order, strict=True)))
    # Written once, so the ranges stay as they are whatever is recomputed later.
    placed = settle(keyed.repartitionByRange(width, *keys).withColumn("range_no", F.spark_partition_id()), label)
    totals = placed.groupBy("range_no").agg(F.count(F.lit(1)).alias("rank_sum"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum") for c in sums])
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range_no",
        F.coalesce(F.sum("rank_sum").over(earlier), F.lit(0)).alias("rank_offset"),
        *[F.coalesce(F.sum(f"{c}_sum").over(earlier), F.lit(0)).alias(f"{c}_offset") for c in sums],
        *[F.sum(f"{c}_sum").over(everything).alias(f"{c}_total") for c in sums],
    )
    within = Window.partitionBy("range_no").orderBy(*keys)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("rank_local", F.row_number().over(within) - 1)
    for c in sums:
        local = local.withColumn(f"{c}_local", F.sum(c).over(upto) - F.col(c))
    joined = local.join(F.broadcast(offsets), "range_no")  # at most one row per shuffle partition
    result = joined.withColumn("rank", (F.col("rank_offset") + F.col("rank_local")).cast("long"))
    for c in sums:
        result = result.withColumn(f"{c}_before", F.col(f"{c}_offset") + F.col(f"{c}_local"))
    drop = [*keys, "range_no", "rank_local", "rank_offset", *[f"{c}_{k}" for c in sums for k in ("local", "offset")]]
    return result.drop(*drop)


def slices_for(rows: int, rows_per_slice: int) -> int:
    return max(1, math.ceil(rows / rows_per_slice))
