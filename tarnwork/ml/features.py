"""Feature columns for a classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import to_number
from tarnwork.operators.project import clean_names, drop_null_rows, label_column

MAX_LEVELS = 200


def category_levels(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """The sorted values of each categorical column, from one pass.

    Raises for a column with more values than a category has; no more than
    that many values ever reach the driver.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    found = df.select(pairs.alias("p")).select("p.*").where("v is not null").distinct()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found.limit(max_levels * len(columns) + 1).collect():
        levels[row["c"]].append(row["v"])
    wide = [c for c, vs in levels.items() if len(vs) > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} values in {', '.join(wide)}")
    return {c: sorted(vs) for c, vs in levels.items()}


def _indicator(column: str, value: str) -> Column:
    return F.coalesce(F.col(column).cast("string") == F.lit(value), F.lit(False)).cast("bigint")


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    levels: Mapping[str, Sequence[str]] | None = None,
    drop_first: bool = False,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """Replace categorical columns by 0/1 columns ``column_value``; a NULL or new value is 0 in all.

    Pass the ``levels`` of the training data to give other data the same
    columns; without them a column of more than ``max_levels`` values is refused.
    ``drop_first`` leaves out the first value of each column.
    """
    levels = levels or category_levels(df, columns, max_levels)
    kept = [F.col(c) for c in df.columns if c not in columns]
    flags = [_indicator(c, v).alias(f"{c}_{v}") for c in columns for v in levels[c][1 if drop_first else 0 :]]
    return df.select(*kept, *flags)


def churn_features(
    raw: DataFrame,
    levels: Mapping[str, Sequence[str]] | None = None,
    max_levels: int = MAX_LEVELS,
    keep_unknown: bool = False,
) -> DataFrame:
    """Customer table to model input: id, four numbers, the label ``churn`` and one column per category value.

    Requests without a label give the same columns but for ``churn``. With ``keep_unknown`` rows that
    lack a number stay, for a model that fills it.
    """
    df = raw.withColumn("totalCharges", to_number("totalCharges"))
    df = one_hot(df, fv.CHURN_CATEGORIES, levels, max_levels=max_levels)
    if "churnString" in df.columns:
        df = label_column(df, "churnString", {"Yes": 1, "No": 0}, "churn")
    df = clean_names(df)
    return df if keep_unknown else drop_null_rows(df)


def feature_columns(df: DataFrame, label: str = "churn", ids: Sequence[str] = ("customerID",)) -> list[str]:
    return [c for c in df.columns if c != label and c not in ids]


def _means(df: DataFrame, columns: Sequence[str], deviation: bool) -> Column:
    """One row of statistics as a scalar subquery: computed once, no join."""
    stats = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    if deviation:
        stats += [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]
    return df.agg(F.struct(*stats).alias("stats")).scalar()


def impute_mean(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs by the column's mean (of the training frame, if given)."""
    stats = _means(fitted_on or df, columns, False)
    filled = {c: F.coalesce(F.col(c).cast("double"), stats[f"m{i}"]) for i, c in enumerate(columns)}
    return df.withColumns(filled)


def standardize(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation; a constant column becomes 0."""
    stats = _means(fitted_on or df, columns, True)
    scaled = {}
    for i, c in enumerate(columns):
        spread = F.when(stats[f"s{i}"] == 0, F.lit(1.0)).otherwise(stats[f"s{i}"])
        scaled[c] = (F.col(c) - stats[f"m{i}"]) / spread
    return df.withColumns(scaled)
