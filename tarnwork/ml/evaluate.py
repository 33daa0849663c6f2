"""Classifier metrics and curves from (label, prediction, probability of class 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarnwork.functions.scalars import ratio_safe
from tarnwork.operators.aggregates import running_total
from tarnwork.session import settle

_TINY = 1e-15


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def score_counts(scored: DataFrame, label: str = "label", probability: str = "probability", by: str | None = None) -> DataFrame:
    """Positives and negatives per score, and per ``_part`` with ``by``, stored.

    Rows of equal score are combined, so ties count together and a score shared
    by many rows is one row from here on. The scored rows are read only here.
    Rows without a score have no place in an order, so they are refused with their number.
    """
    positive = F.col(label) == 1
    part = [F.col(by).alias("_part")] if by else []
    counts = scored.groupBy(*part, F.col(probability).cast("double").alias("threshold")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    counts = settle(counts, "score-counts")
    unscored = counts.where(F.col("threshold").isNull() | F.isnan("threshold")).agg(F.sum(F.col("positives") + F.col("negatives"))).first()[0]
    if unscored:
        raise ValueError(f"{unscored} rows have no score")
    return counts


def threshold_counts(counts: DataFrame) -> DataFrame:
    """Per score, positives and negatives at it and at all higher ones (``tp``, ``fp``)."""
    ranked = running_total(counts, "threshold", ["positives", "negatives"], descending=True)
    return ranked.withColumnsRenamed({"positives_cum": "tp", "negatives_cum": "fp"})


def _class_totals(counts: DataFrame) -> Column:
    stats = F.struct(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    return counts.agg(stats.alias("t")).scalar()


def roc_curve(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """False and true positive rate at each threshold."""
    counts = score_counts(scored, label, probability)
    totals = _class_totals(counts)
    return threshold_counts(counts).select(
        "threshold",
        ratio_safe(F.col("fp").cast("double"), totals["n"]).alias("fpr"),
        ratio_safe(F.col("tp").cast("double"), totals["p"]).alias("tpr"),
    )


def pr_curve(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Precision and recall at each threshold."""
    counts = score_counts(scored, label, probability)
    totals = _class_totals(counts)
    tp = F.col("tp").cast("double")
    return threshold_counts(counts).select(
        "threshold",
        (tp / (F.col("tp") + F.col("fp"))).alias("precision"),
        ratio_safe(tp, totals["p"]).alias("recall"),
    )


def roc_auc(
    scored: DataFrame, label: str = "label", probability: str = "probability", by: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve: pairs ranked rightly, ties counting half, in whole numbers.

    With ``by``, one row per value of that column, from the same single pass: positives are totalled over all parts in one
    order of part and score, and each part takes off what stands before its first score. Parts may be many, and one may be hot.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    counts = score_counts(scored, label, probability, by)
    ranked = running_total(counts, ["_part", "threshold"] if by else "threshold", ["positives"], descending=True)
    sums = ranked.groupBy(*(["_part"] if by else [])).agg(
        F.sum(wide(F.col("negatives")) * (2 * wide(F.col("positives_cum")) - wide(F.col("positives")))).alias("halves"),
        F.sum("positives").alias("p"), F.sum("negatives").alias("n"), F.min(F.col("positives_cum") - F.col("positives")).alias("before"),
    )
    halves = F.col("halves") - 2 * wide(F.col("before")) * wide(F.col("n"))
    pairs = 2 * F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(*([F.col("_part").alias(by)] if by else []), (halves.cast("double") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def evaluate_classifier(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability",
    by: str | None = None,
    with_auc: bool = False,
) -> DataFrame:
    """Accuracy, precision, recall, F1 and log loss (class 1 positive), per split if ``by`` is given.

    One aggregation. ``with_auc`` adds ``roc_auc``, which needs an order and so one more pass for all parts.
    """
    hit = F.col(prediction) == F.col(label)
    positive, predicted = F.col(label) == 1, F.col(prediction) == 1
    p = F.least(F.greatest(F.col(probability), F.lit(_TINY)), F.lit(1 - _TINY))
    counts = scored.groupBy(*([by] if by else [])).agg(
        F.count("*").alias("n_rows"),
        F.count_if(hit).alias("hits"),
        F.count_if(positive & predicted).alias("tp"),
        F.count_if(positive).alias("p"),
        F.count_if(predicted).alias("pp"),
        F.avg(-F.log(F.when(positive, p).otherwise(1 - p))).alias("log_loss"),
    )
    whole = lambda c: F.col(c).cast("double")
    metrics = counts.select(
        *([by] if by else []),
        "n_rows",
        ratio_safe(whole("hits"), F.col("n_rows")).alias("accuracy"),
        ratio_safe(whole("tp"), F.col("pp")).alias("precision"),
        ratio_safe(whole("tp"), F.col("p")).alias("recall"),
        ratio_safe(2 * whole("tp"), F.col("pp") + F.col("p")).alias("f1"),
        "log_loss",
    )
    if not with_auc:
        return metrics
    areas = roc_auc(scored, label, probability, by)
    if not by:
        return metrics.withColumn("roc_auc", areas.scalar())
    areas = areas.withColumnRenamed(by, "_part")
    return metrics.join(areas, F.col(by).eqNullSafe(F.col("_part")), "left").drop("_part")
