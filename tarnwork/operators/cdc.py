"""Change feeds: the newest row per key wins, whatever the order of arrival.

"Newest" is a maximum, so partial results combine in any order and any number
of times. One operator therefore serves a batch, a micro-batch and a merge of
what several flows have stored, and replaying a batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

DELETED = "_deleted"


def latest_changes(
    feed: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per key: its newest change, with ``_deleted`` telling a delete.

    A delete stays as a tombstone, so an older row that arrives late does not
    bring the key back. Among changes of the same sequence a delete wins, then
    the largest values, which makes the choice independent of arrival order.
    Each task first reduces its own rows to one per key.
    """
    if delete_when is None:
        delete = F.col(DELETED) if DELETED in feed.columns else F.lit(False)
    else:
        delete = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    feed = feed.withColumn(DELETED, F.coalesce(delete, F.lit(False))).drop(*except_columns)
    rest = [c for c in feed.columns if c not in {*keys, *sequence_by, DELETED}]
    maps = {f.name for f in feed.schema if isinstance(f.dataType, T.MapType)}
    if maps:  # maps have no order, their sorted entries have
        order = F.struct(*sequence_by, DELETED, *[F.sort_array(F.map_entries(c)) if c in maps else F.col(c) for c in rest])
        newest = F.max_by(F.struct(*sequence_by, DELETED, *rest), order).alias("_newest")
    else:
        newest = F.max(F.struct(*sequence_by, DELETED, *rest)).alias("_newest")
    return feed.groupBy(*keys).agg(newest).select(*[c if c in keys else F.col("_newest")[c].alias(c) for c in feed.columns])


def current_rows(changes: DataFrame) -> DataFrame:
    """What the table shows: newest rows without the deleted keys."""
    return changes.where(~F.col(DELETED)).drop(DELETED)


def apply_changes(
    target: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """New state (tombstones included) from the stored state and a feed."""
    changes = latest_changes(feed, keys, sequence_by, delete_when, except_columns)
    if target is None:
        return changes
    return latest_changes(target.unionByName(changes, allowMissingColumns=True), keys, sequence_by)
