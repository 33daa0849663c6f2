"""Column-level steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tarnwork.functions.scalars import map_label


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a mapping; names the frame does not have are passed over."""
    return df.withColumnsRenamed(dict(names))


def clean_names(df: DataFrame) -> DataFrame:
    """Spaces go, an opening bracket becomes a dash, a closing one goes."""
    swap = str.maketrans({" ": None, "(": "-", ")": None})
    return df.toDF(*[c.translate(swap) for c in df.columns])


def all_rules(rules: Mapping[str, str]) -> Column:
    """All rules joined by AND; NULL where none is false and one is unknown."""
    return F.expr(" AND ".join(f"({rule})" for rule in rules.values()))


def with_rule_flag(df: DataFrame, rules: Mapping[str, str], name: str = "valid") -> DataFrame:
    return df.withColumn(name, all_rules(rules))


def label_column(df: DataFrame, column: str, codes: Mapping[str, int], new_name: str) -> DataFrame:
    """Replace a text column by its int codes under a new name."""
    return df.withColumn(column, map_label(column, codes)).withColumnRenamed(column, new_name)


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)
