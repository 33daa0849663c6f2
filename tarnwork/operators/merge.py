"""Upserts and schema changes on DataFrames.

Built-in parquet tables take neither MERGE nor DROP/RENAME/TYPE changes, so
each operator returns the new content; ``tables.replace_table`` swaps it in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tarnwork.session import settle


class SchemaError(ValueError):
    """A write or schema change the table does not allow."""


_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_INTEGRAL_DIGITS = dict(zip(map(type, _INTEGRAL), (3, 5, 10, 20)))


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is also one of the new type."""
    if old == new:
        return True
    if type(old) in _INTEGRAL_DIGITS:
        if type(new) in _INTEGRAL_DIGITS:
            return _INTEGRAL_DIGITS[type(new)] > _INTEGRAL_DIGITS[type(old)]
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= _INTEGRAL_DIGITS[type(old)]
        return isinstance(new, T.DoubleType) and not isinstance(old, T.LongType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    return isinstance(old, T.DateType) and isinstance(new, T.TimestampNTZType)


def can_store(old: T.DataType, new: T.DataType) -> bool:
    """Whether a column of one type may be written into another.

    Numbers go into numbers (an overflow fails the job), anything plain goes
    into text, but text never goes into a number, date or flag.
    """
    if can_widen(old, new) or isinstance(old, T.NullType):
        return True
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return True
    return isinstance(new, T.StringType) and isinstance(old, T.AtomicType)


def in_target_spelling(source: DataFrame, names: Sequence[str]) -> DataFrame:
    """Source columns that differ from the table's in case alone get its spelling, as Spark takes both for the same."""
    if source.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return source
    known = {c.lower(): c for c in names}
    return source.toDF(*[known.get(c.lower(), c) for c in source.columns])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the table's columns and types, or ``SchemaError``.

    Unknown columns and text for numbers are refused; missing columns are NULL.
    """
    df = in_target_spelling(df, schema.names)
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise SchemaError(f"the table has no column {', '.join(unknown)}")
    out = []
    for field in schema:
        if field.name not in df.columns:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given = df.schema[field.name].dataType
        if not can_store(given, field.dataType):
            raise SchemaError(
                f"column {field.name}: {given.simpleString()} cannot be stored as {field.dataType.simpleString()}"
            )
        out.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
    return df.select(*out)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], evolve: bool = False, large_source: bool = False
) -> DataFrame:
    """Update target rows from source rows with the same keys and insert the others.

    With ``evolve`` columns only the source has are added, NULL on rows it does
    not touch. Columns only the target has keep their values on update and are
    NULL on insert. Two source rows for one target row are an error.

    The target is joined from the left, so a source below Spark's broadcast
    limit leaves the target where it is; inserts are then found among the
    source rows, by the target's keys alone. For a source beyond it, ``large_source`` does both in a single
    full outer join, with one shuffle of each side.
    """
    source = in_target_spelling(source, target.columns)
    new_columns = [c for c in source.columns if c not in target.columns]
    if new_columns and not evolve:
        raise SchemaError(f"the table has no column {', '.join(new_columns)}")
    as_target = [f for f in target.schema if f.name in source.columns]
    added = [f for f in source.schema if f.name in new_columns]
    # Written, as it is checked, joined and searched for inserts; the source itself is computed once.
    typed = settle(enforce_schema(source, T.StructType([*as_target, *added])), "merge-source")

    repeated = typed.na.drop("any", subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty() and not repeated.join(target, list(keys), "left_semi").isEmpty():
        raise SchemaError("more than one source row for a target row")

    if large_source:
        # Rows with a NULL key match nothing; in the join they would all go to one task.
        keyed = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
        target, typed, apart = target.where(keyed), typed.where(keyed), (target.where(~keyed), typed.where(~keyed))
    shared = [c for c in typed.columns if c not in keys]
    changes = typed.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in shared])
    merged = target.join(changes, list(keys), "full" if large_source else "left")
    picked = []
    for c in [*target.columns, *new_columns]:
        if c not in shared:
            picked.append(F.col(c))
        elif c in new_columns:
            picked.append(F.col(f"_new_{c}").alias(c))
        else:
            picked.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    result = merged.select(*picked)
    if large_source:
        for rows in apart:
            result = result.unionByName(rows, allowMissingColumns=True)
        return result
    matched = target.join(typed.select(*keys), list(keys), "left_semi").select(*keys).distinct()
    inserted = typed.join(matched, list(keys), "left_anti")
    return result.unionByName(inserted, allowMissingColumns=True)


def evolve(
    df: DataFrame,
    add: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    widen: Mapping[str, str] | None = None,
    name_mapping: bool = False,
    type_widening: bool = False,
) -> DataFrame:
    """Add, drop, rename and widen columns.

    Adding always works. Dropping and renaming need ``name_mapping`` and
    widening needs ``type_widening``, as the owner of a table has to allow
    changes that older readers of it would not survive. Narrowing is refused.
    """
    if (drop or rename) and not name_mapping:
        raise SchemaError("dropping or renaming a column needs name_mapping")
    if widen and not type_widening:
        raise SchemaError("widening a column needs type_widening")
    touched = [*drop, *(rename or {}), *(widen or {})]
    missing = [c for c in touched if c not in df.columns]
    if missing:
        raise SchemaError(f"the table has no column {', '.join(missing)}")
    for name, new in (widen or {}).items():
        old, wide = df.schema[name].dataType, T.DataType.fromDDL(new)
        if not can_widen(old, wide):
            raise SchemaError(f"column {name}: {old.simpleString()} to {new} is not a widening")
        df = df.withColumn(name, F.col(name).cast(wide))
    df = df.drop(*drop).withColumnsRenamed(dict(rename or {}))
    for name, data_type in (add or {}).items():
        if name in df.columns:
            raise SchemaError(f"column {name} exists already")
        df = df.withColumn(name, F.lit(None).cast(data_type))
    if len(set(df.columns)) < len(df.columns):
        raise SchemaError("two columns would have the same name")
    return df
