"""Enrichment joins that keep every fact row, also where one key holds a large share of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 0.02
MAX_HOT_DIM_ROWS = 10_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of all rows: at most ``1/share`` of them.

    The counts are combined map-side, so a hot key costs one row per task.
    """
    if not 0 < share <= 1:
        raise ValueError("share is a part of all rows")
    total = df.agg(F.count("*"))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return [r[0] for r in counts.where(F.col("n") > total.scalar() * share).select(key).collect()]


def left_join_skewed(
    fact: DataFrame, dim: DataFrame, key: str, share: float = HOT_SHARE, max_hot_rows: int = MAX_HOT_DIM_ROWS
) -> DataFrame:
    """Left join whose hot keys are not sent to one task each.

    Rows with a hot key or a NULL key stay where they are and meet a broadcast
    of the dimension rows of the hot keys alone. There are at most ``1/share``
    such keys, and the rows are counted before the broadcast; a dimension that
    repeats hot keys on more than ``max_hot_rows`` rows is joined by shuffle, where AQE splits the
    skewed partitions. All other rows take the ordinary join.
    """
    hot = hot_keys(fact, key, share)
    hot_dim = dim.where(F.col(key).isin(hot)) if hot else dim.limit(0)
    if hot and hot_dim.limit(max_hot_rows + 1).count() > max_hot_rows:
        return fact.join(dim, key, "left")
    is_hot = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    spread = fact.where(~is_hot).join(dim, key, "left")
    kept = fact.where(is_hot).join(F.broadcast(hot_dim), key, "left")
    return spread.unionByName(kept)


def enrich(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], hot_share: float | None = None
) -> DataFrame:
    """Left-join each ``(dimension, key)`` in turn; works on streams too.

    Spark broadcasts a dimension below its size limit by itself. ``hot_share``
    turns on the hot-key split for batch frames whose dimensions are beyond it.
    """
    for dim, key in dims:
        if hot_share is None or fact.isStreaming:
            fact = fact.join(dim, key, "left")
        else:
            fact = left_join_skewed(fact, dim, key, hot_share)
    return fact


def match_audit(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """The fact with one flag ``<key>_matched`` per dimension, false where the key is unknown."""
    for dim, key in dims:
        known = dim.select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"{key}_matched", F.lit(True))
        fact = fact.join(known, key, "left").na.fill(False, subset=[f"{key}_matched"])
    return fact


def unmatched(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows without a dimension row, a NULL key included."""
    return fact.join(dim.select(key), key, "left_anti")


def star_totals(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    where: str,
    amount: str,
    names: tuple[str, str],
    combine_first: bool = False,
) -> DataFrame:
    """COUNT and SUM over the fact rows whose dimension row passes a filter.

    A filtered dimension below Spark's broadcast limit prunes the fact where it
    is read, with no shuffle. For larger ones ``combine_first`` sums the fact
    per key before the join: what is shuffled is one row per key and task, and
    a hot key weighs no more than any other.
    """
    n, total = names
    kept = dim.where(where).select(key)
    if not combine_first:
        return fact.join(kept, key).agg(F.count("*").alias(n), F.sum(amount).alias(total))
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"), F.sum(amount).alias("_amount"))
    return per_key.join(kept, key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(n), F.sum("_amount").alias(total))
