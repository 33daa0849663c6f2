"""Group totals, distributions, column profiles and running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnwork import fixed_values as fv
from tarnwork.session import settle


def sum_by(df: DataFrame, keys: Sequence[str | Column], value: str | Column, name: str) -> DataFrame:
    """Sum per group; NULL keys form a group of their own."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def percent_of_total(df: DataFrame, key: str, count_name: str = "n", percent_name: str = "pct") -> DataFrame:
    """Rows per group and their share of all rows in percent, one decimal, largest first.

    The total is a scalar subquery over the groups' counts, whose shuffle it
    shares: a window over the whole result would put all groups into one task.
    """
    counts = df.groupBy(key).agg(F.count("*").alias(count_name))
    share = F.col(count_name).cast("decimal(20,0)") * 100 / counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn(percent_name, F.round(share, 1)).orderBy(F.desc(count_name), key)


def sum_where(value: str, condition: Column, name: str) -> Column:
    """Sum over the rows that meet a condition; other rows, unknown ones included, add 0."""
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).alias(name)


def category_quantities(
    users: DataFrame, lines: DataFrame, first: str = fv.CATEGORY_FOOD, second: str = fv.CATEGORY_DAILY
) -> DataFrame:
    """Per user: quantity bought in two named categories and in all others.

    Lines are summed per user first and joined after, which neither multiplies
    a user's lines nor shuffles them. A line without a category counts nowhere.
    """
    category = F.col("category")
    names = ["food_quantity", "daily_quantity", "other_quantity"]
    per_user = lines.groupBy("user_id").agg(
        sum_where("quantity", category == first, names[0]),
        sum_where("quantity", category == second, names[1]),
        sum_where("quantity", ~category.isin(first, second), names[2]),
    )
    return users.join(per_user, "user_id", "left").na.fill(0, subset=names)


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct values, smallest and largest value as text.

    One pass. Distinct values are estimated unless ``exact``; the exact count
    first reduces to distinct (column, value) pairs, spread over all tasks.
    """
    columns = list(columns or df.columns)
    stats = []
    for c in columns:
        stats.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("n_rows"),
                (F.count("*") - F.count(c)).alias("n_nulls"),
                F.approx_count_distinct(c).alias("n_distinct"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            )
        )
    profile = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    if not exact:
        return profile
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("p")
    ).select("p.*")
    # COUNT(DISTINCT) shuffles by (column, value), so no column is one task's work.
    exact_counts = pairs.groupBy("column_name").agg(F.countDistinct("v").alias("n_distinct"))
    return profile.drop("n_distinct").join(exact_counts, "column_name").select(*profile.columns)


def monthly_rollup(df: DataFrame, date: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates per calendar month (``yyyy-MM``), in order of month."""
    month = F.date_format(date, "yyyy-MM").alias("month")
    return df.groupBy(month).agg(*[a.alias(n) for n, a in aggregates.items()]).orderBy("month")


def per_group_linear_fit(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """A least-squares line per group, all groups in one aggregation.

    The sums behind the fit combine map-side, so the size of a group does not matter.
    """
    return df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def per_group_least_squares(df: DataFrame, group: str, features: Sequence[str], target: str) -> DataFrame:
    """A linear model of several features per group: ``group, n, intercept, coefficients, r2`` with one coefficient for each feature.

    One aggregation gives every group's Gram matrix and its products with the target; they combine map-side, so a hot group
    costs no more than others, and each group's system is then solved where its one row is. Rows with a NULL
    are left out. A group whose system has no single solution gets the one of least length.
    """
    if not features:
        raise ValueError("a model needs a feature")
    columns = [F.col(f"`{c}`").cast("double") for c in (*features, target)]
    rows = df.select(F.col(f"`{group}`").alias("_group"), *[c.alias(f"_x{i}") for i, c in enumerate(columns)]).na.drop("any", subset=[f"_x{i}" for i in range(len(columns))])
    k = len(columns)
    products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(k) for j in range(i, k)]
    moments = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"_x{i}") for i in range(k)]).alias("sums"), F.array(*products).alias("products"))

    @F.pandas_udf("intercept double, coefficients array<double>, r2 double")
    def solve(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        out = []
        upper = np.triu_indices(k)
        for count, total, product in zip(n, sums, products, strict=True):
            gram = np.zeros((k, k))
            gram[upper] = product
            gram = gram + np.triu(gram, 1).T
            # About the means: the intercept drops out, and the sums lose fewer digits.
            mean = np.asarray(total) / count
            spread = gram - count * np.outer(mean, mean)
            beta = np.linalg.lstsq(spread[:-1, :-1], spread[:-1, -1], rcond=1e-12)[0]
            whole = spread[-1, -1]
            out.append((mean[-1] - beta @ mean[:-1], beta.tolist(), float(beta @ spread[:-1, -1] / whole) if whole > 0 else None))
        return pd.DataFrame(out, columns=["intercept", "coefficients", "r2"])

    solved = moments.withColumn("m", solve("n", "sums", "products"))
    return solved.select(F.col("_group").alias(group), "n", "m.intercept", "m.coefficients", "m.r2")


def running_total(
    df: DataFrame, order: str | Sequence[str], values: Sequence[str], descending: bool = False, slices: int | None = None
) -> DataFrame:
    """Add ``<value>_cum``: the sum of each value over all rows up to this one.

    ``order``, a column or several, must be unique per row. A window without partitions would be one
    task, so the rows are stored once in ``slices`` contiguous ranges of the
    order (by default one per shuffle partition, so they grow with what the
    session is set up for); each range is summed on its own and offset by the
    total of the ranges before it, a table of one row per range.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.desc(c) if descending else F.asc(c) for c in ([order] if isinstance(order, str) else order)]
    sliced = settle(df.repartitionByRange(slices, *by).withColumn("_slice", F.spark_partition_id()), "running-total")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(v).alias(f"_{v}") for v in values])
        .select("_slice", *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values])
    )
    within = Window.partitionBy("_slice").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.select("*", *[F.sum(v).over(within).alias(f"{v}_cum") for v in values])
    out = summed.join(F.broadcast(offsets), "_slice")  # at most ``slices`` rows
    out = out.withColumns({f"{v}_cum": F.col(f"{v}_cum") + F.col(f"_{v}") for v in values})
    return out.drop("_slice", *[f"_{v}" for v in values])
