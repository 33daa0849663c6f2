"""Training, tuning, scoring and feature importance on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnwork.ml.evaluate import evaluate_classifier
from tarnwork.session import settle

DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 653201287}
#: Rows of one task in training; a task keeps them in memory and reads them, with their errors, once for each level of each tree.
ROWS_PER_TASK = 250_000


def _plain_names(features: Sequence[str]) -> dict[str, str]:
    """ML stages read column names as paths, so features get plain ones inside the pipeline."""
    return {name: f"f{i}" for i, name in enumerate(features)}


def model_input(df: DataFrame, features: Sequence[str], extra: Sequence[Column | str] = ()) -> DataFrame:
    columns = [F.col(f"`{name}`").cast("double").alias(plain) for name, plain in _plain_names(features).items()]
    return df.select(*extra, *columns)


def training_rows(train: DataFrame, validation: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Both parts in one stored table.

    Training reads its rows many times; what they were made from is read once, by the tasks that also write it.
    """
    target = F.col(label).cast("double").alias("label")
    rows = model_input(train, features, [target, F.lit(False).alias("held_out")]).unionByName(
        model_input(validation, features, [target, F.lit(True).alias("held_out")])
    )
    return settle(rows, "training-rows")


def fit(rows: DataFrame, features: Sequence[str], params: Mapping | None = None, rows_per_task: int = ROWS_PER_TASK) -> PipelineModel:
    """Mean imputation and boosted trees that stop early on the held-out rows.

    The trees get their rows dealt to as many tasks as their number asks for: how many of them lie in one file
    split depends on how well they were compressed.
    """
    plain = list(_plain_names(features).values())
    filled = [f"{c}_filled" for c in plain]
    trees = GBTClassifier(labelCol="label", featuresCol="features", validationIndicatorCol="held_out")
    imputer = Imputer(strategy="mean", inputCols=plain, outputCols=filled).fit(rows)
    stages = [imputer, VectorAssembler(inputCols=filled, outputCol="features"), trees.setParams(**{**DEFAULTS, **(params or {})})]
    return Pipeline(stages=stages).fit(rows.repartition(math.ceil(rows.count() / rows_per_task) or 1))


def train_classifier(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    params: Mapping | None = None,
) -> PipelineModel:
    return fit(training_rows(train, validation, features, label), features, params)


def batch_score(df: DataFrame, model: PipelineModel | str, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns plus ``prediction`` and ``probability`` of class 1, by a model or the path of a saved one."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    return _scored(model, model_input(df, features, keep), keep)


def _scored(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    second = vector_to_array("probability")[1].alias("probability")
    return model.transform(rows).select(*keep, "prediction", second)


def f1_score(scored: DataFrame, label: str) -> float:
    return evaluate_classifier(scored, label).first()["f1"] or 0.0


def tune(
    train: DataFrame, validation: DataFrame, features: Sequence[str], grid: Sequence[Mapping], label: str = "churn"
) -> tuple[PipelineModel, Mapping, float]:
    """The model, parameters and F1 of the grid's best entry on the validation rows (highest F1, first of equals)."""
    rows = training_rows(train, validation, features, label)
    held_out = rows.where("held_out")
    trials = []
    for params in grid:
        model = fit(rows, features, params)
        trials.append((model, params, f1_score(_scored(model, held_out, ["label"]), "label")))
    return max(trials, key=lambda t: t[2])


def shuffle_features(
    df: DataFrame, features: Sequence[str], ids: Sequence[str], seed: int = 1, groups: int = 16
) -> DataFrame:
    """Add ``<feature>_moved``: each feature's values handed on to another row.

    Rows fall into groups by a hash of their id and each passes its values to
    the next by hash, the last to the first. Every value is kept and none has
    to do with its row any more. ``groups`` decides which row gets which value,
    so it is a parameter and not a matter of size; a group is one task's work,
    so it should grow with the data (``groups_for``), and each should keep several rows.
    """
    order = F.xxhash64(*ids, F.lit(seed))
    placed = df.withColumn("_group", F.pmod(F.xxhash64(*ids, F.lit(seed + 1)), F.lit(groups)))
    # As many partitions as groups: the session's number, or fewer after coalescing, would put many groups into one task.
    placed = placed.repartition(groups, "_group")
    ring = Window.partitionBy("_group").orderBy(order)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = {}
    for f in features:
        value = F.struct(F.col(f"`{f}`").alias("v"))  # a struct tells a NULL value from no row before
        moved[f"{f}_moved"] = F.coalesce(F.lag(value).over(ring), F.last(value).over(whole))["v"]
    return placed.withColumns(moved).drop("_group")


def groups_for(df: DataFrame, rows_per_group: int = ROWS_PER_TASK, least: int = 16) -> int:
    """A number of groups for ``shuffle_features`` that grows with the rows."""
    return max(least, math.ceil(df.count() / rows_per_group))


def permutation_importance(
    df: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    label: str,
    ids: Sequence[str],
    seed: int = 1,
    groups: int | None = None,
) -> DataFrame:
    """How much F1 falls when one feature's values belong to other rows, largest first. Uses all rows.

    ``groups`` as for ``shuffle_features``; by default it grows with the rows.
    """
    # Read back, as counting and moving would otherwise both make the rows.
    rows = settle(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*ids, *features, label])]), "importance-rows")
    moved = settle(shuffle_features(rows, features, ids, seed, groups or groups_for(rows)), "moved-features")
    base = F.lit(f1_score(batch_score(moved, model, features, [label]), label))
    drops = []
    for f in features:
        swapped = moved.withColumn(f, F.col(f"`{f}_moved`"))
        f1 = evaluate_classifier(batch_score(swapped, model, features, [label]), label)
        drops.append(f1.select(F.lit(f).alias("feature"), (base - F.coalesce("f1", F.lit(0.0))).alias("f1_drop")))
    return reduce(DataFrame.unionByName, drops).orderBy(F.desc("f1_drop"), "feature")


def tree_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """The trees' own importances, largest first."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return sorted(zip(features, weights), key=lambda pair: (-pair[1], pair[0]))
