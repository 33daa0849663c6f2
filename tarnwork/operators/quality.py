"""Named rules on rows: count, drop, refuse or set aside the rows that break them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tarnwork.operators.project import all_rules, with_rule_flag
from tarnwork.session import scratch_dir

Rules = Mapping[str, str]


def _holds(rule: Column, null_as: str) -> Column:
    if null_as not in ("invalid", "valid"):
        raise ValueError("null_as is 'invalid' or 'valid'")
    return F.coalesce(rule, F.lit(null_as == "valid"))


def _kept_whole(df: DataFrame) -> DataFrame:
    """The same rows. A filter put on later is not pushed below, where it would hide rows from a check on top of this."""
    return df.observe(f"checked {uuid.uuid4().hex}", F.count(F.lit(1)).alias("n_rows"))


def _must(df: DataFrame, condition: Column, message: str) -> DataFrame:
    # Inside a filter the check cannot be pruned away with an unused column.
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def violation_counts(rules: Rules, null_as: str = "invalid") -> list[Column]:
    return [F.count_if(~_holds(F.expr(rule), null_as)).alias(name) for name, rule in rules.items()]


def expect(
    df: DataFrame,
    rules: Rules,
    on_fail: str = "warn",
    observation: Observation | str | None = None,
    null_as: str = "invalid",
) -> DataFrame:
    """Apply rules: ``warn`` keeps all rows, ``drop`` keeps valid ones, ``fail`` stops the job.

    With an observation the violations per rule are counted while the rows pass
    by, with no further scan. A stream takes a name and reports the counts
    under it in its progress.
    """
    if on_fail not in ("warn", "drop", "fail"):
        raise ValueError("on_fail is 'warn', 'drop' or 'fail'")
    if observation is not None:
        df = df.observe(observation, F.count("*").alias("n_rows"), *violation_counts(rules, null_as))
    if on_fail == "warn":
        return df
    if on_fail == "drop":
        return df.where(_holds(all_rules(rules), null_as))
    if observation is None:
        df = _kept_whole(df)
    for name, rule in rules.items():
        df = _must(df, _holds(F.expr(rule), null_as), f"rule {name} is violated: {rule}")
    return df


def quarantine(df: DataFrame, rules: Rules, null_as: str = "invalid") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows.

    Where a rule is unknown for want of a value the row is invalid; with
    ``null_as="drop"`` such rows are in neither part.
    """
    flagged = _flagged(df, rules, null_as)
    return flagged.where("_valid").drop("_valid"), flagged.where("NOT _valid").drop("_valid")


def _flagged(df: DataFrame, rules: Rules, null_as: str) -> DataFrame:
    if null_as not in ("invalid", "drop"):
        raise ValueError("null_as is 'invalid' or 'drop'")
    flagged = with_rule_flag(df, rules, "_valid")
    return flagged.withColumn("_valid", F.coalesce("_valid", F.lit(False))) if null_as == "invalid" else flagged.where("_valid IS NOT NULL")


def quarantine_stored(df: DataFrame, rules: Rules, null_as: str = "invalid") -> tuple[DataFrame, DataFrame]:
    """``quarantine`` where both parts are read: the rows are computed once and stored in a folder per part."""
    path, spark = scratch_dir(df.sparkSession, "quarantine"), df.sparkSession
    _flagged(df, rules, null_as).withColumn("_valid", F.col("_valid").cast("int")).write.partitionBy("_valid").parquet(path)
    stored = spark.read.schema(T.StructType([*df.schema, T.StructField("_valid", T.IntegerType())])).parquet(path)
    return stored.where("_valid = 1").drop("_valid"), stored.where("_valid = 0").drop("_valid")


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Per rule: rows that pass, fail, and for which it is unknown. One pass for all rules."""
    rows = []
    for name, rule in rules.items():
        test = F.expr(rule)
        rows.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(test).alias("passed"),
                F.count_if(~test).alias("failed"),
                F.count_if(test.isNull()).alias("unknown"),
            )
        )
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a NULL key, keys that repeat, and rows beyond the first per key."""
    has_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n")).select("n", has_null.alias("has_null"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    repeats = ~F.col("has_null") & (F.col("n") > 1)
    return per_key.agg(
        total("n").alias("n_rows"),
        total(F.when(F.col("has_null"), F.col("n"))).alias("null_key_rows"),
        F.count_if(repeats).alias("repeated_keys"),
        total(F.when(repeats, F.col("n") - 1)).alias("surplus_rows"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job that reads them fails at the first NULL."""
    df = _kept_whole(df)
    for c in columns:
        df = _must(df, F.col(c).isNotNull(), f"column {c} must not be NULL")
    return df
