"""Train, validation and test parts with equal class proportions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnwork.session import settle

PARTS = {"train": 60, "validation": 20, "test": 20}
_END = "g"  # sorts after every hex digit


def row_hash(ids: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))


def split_bounds(
    df: DataFrame, label: str, ids: Sequence[str], parts: Mapping[str, int], seed: int, digits: int = 4
) -> DataFrame:
    """Per label (``_label``): the row hashes at which each part but the first begins.

    Rows ordered by hash are cut at exact counts without sorting them. A first
    pass counts rows per hash prefix and finds the prefix each cut falls into;
    a second looks at the rows of those prefixes only, one part in
    ``16 ** digits`` of all. Both combine equal hashes map-side.
    """
    total_weight = sum(parts.values())
    weights = list(parts.values())
    marks = [sum(weights[: i + 1]) for i in range(len(weights) - 1)]
    rows = df.select(label, row_hash(ids, seed).alias("_hash")).withColumn("_prefix", F.left("_hash", F.lit(digits)))

    by_prefix = Window.partitionBy(label).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = (
        rows.groupBy(label, "_prefix")
        .agg(F.count("*").alias("n"))
        .select(
            label,
            "_prefix",
            "n",
            F.coalesce(F.sum("n").over(by_prefix), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy(label)).alias("total"),
        )
    )
    cut_rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("mark")) for i, m in enumerate(marks)]))
    cuts = (
        prefixes.select("*", cut_rows.alias("_cut"))
        .select(
            label, "_prefix", "before", "n", F.col("_cut.i").alias("i"),
            F.floor(F.col("total") * F.col("_cut.mark") / total_weight).alias("at"),
        )
        .where((F.col("before") <= F.col("at")) & (F.col("at") < F.col("before") + F.col("n")))
    )
    # New names for all columns, as the rows and their cuts come from the same frame.
    # Read back, so that Spark knows how small they are and leaves the rows where they are.
    cuts = settle(cuts.select(F.col(label).alias("_label"), F.col("_prefix").alias("_cut"), "before", "i", "at"), "split-cuts")

    # Null-safe: rows without a label are a class of their own.
    in_cut = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_prefix") == F.col("_cut"))
    near = rows.join(cuts, in_cut).select("_label", "_prefix", "before", "i", "at", "_hash")
    in_prefix = Window.partitionBy("_label", "i").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    near = (
        near.groupBy("_label", "_prefix", "before", "i", "at", "_hash")
        .agg(F.count("*").alias("copies"))
        .withColumn("rank", F.col("before") + F.coalesce(F.sum("copies").over(in_prefix), F.lit(0)))
    )
    begin = F.min(F.when(F.col("rank") >= F.col("at"), F.col("_hash")))
    bounds = near.groupBy("_label", "_prefix", "i").agg(begin.alias("begin"))
    bounds = bounds.withColumn("begin", F.coalesce("begin", F.concat("_prefix", F.lit(_END))))
    return bounds.groupBy("_label").agg(
        *[F.max(F.when(F.col("i") == i, F.col("begin"))).alias(f"begin_{i + 1}") for i in range(len(marks))]
    )


def stratified_split(
    df: DataFrame,
    label: str,
    ids: Sequence[str],
    parts: Mapping[str, int] = PARTS,
    seed: int = 984664349,
    name: str = "split",
) -> DataFrame:
    """Add the part each row belongs to.

    Per class the parts have exactly the wanted sizes where ids are unique;
    rows that share an id stay in one part. The choice depends on id and seed
    alone. The rows themselves are not moved: they meet a stored table with one row
    per class, which Spark broadcasts while it is below its own limit. Joined as it is
    computed, it would have no known size, and the rows would be shuffled by their few classes.
    """
    bounds = settle(split_bounds(df, label, ids, parts, seed), "split-bounds")
    joined = df.withColumn("_hash", row_hash(ids, seed)).join(bounds, F.col(label).eqNullSafe(F.col("_label")))
    names = list(parts)
    part = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        part = F.when(F.col("_hash") < F.col(f"begin_{i + 1}"), F.lit(names[i])).otherwise(part)
    helpers = [f"begin_{i + 1}" for i in range(len(names) - 1)]
    return joined.withColumn(name, part).drop("_hash", "_label", *helpers)
