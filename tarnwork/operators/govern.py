"""Tags on columns and policies that mask columns or filter rows by tag."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import equals_value, mask_constant, mask_email


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach ``{column: {key: value}}`` to the frame's columns."""
    for name, new in tags.items():
        metadata = df.schema[name].metadata
        df = df.withMetadata(name, {**metadata, "tags": {**metadata.get("tags", {}), **new}})
    return df


def column_tags(df: DataFrame) -> dict[str, dict[str, str]]:
    return {f.name: dict(f.metadata["tags"]) for f in df.schema if "tags" in f.metadata}


@dataclass(frozen=True)
class Policy:
    """What happens to columns that carry a tag, unless the reader is in an exempt group.

    ``kind`` is ``mask`` (the function gives the shown value) or ``filter``
    (the function gives the test a row must pass).
    """

    kind: str
    tag: tuple[str, str]
    function: Callable[[Column], Column]
    exempt: frozenset[str] = field(default_factory=frozenset)

    def __post_init__(self):
        if self.kind not in ("mask", "filter"):
            raise ValueError("kind is 'mask' or 'filter'")


EMPLOYEE_POLICIES = (
    Policy("mask", (fv.TAG_KEY, "pii_email"), mask_email),
    Policy("mask", (fv.TAG_KEY, "salary"), lambda c: mask_constant(fv.MASKED_SALARY)),
    Policy("filter", (fv.TAG_KEY, "region_apac"), equals_value),
)


def register_functions(spark: SparkSession) -> None:
    """The masks and the row test as SQL functions ``mask_email``, ``mask_salary`` and ``is_apac_region``."""
    user = "substring_index(email, '@', 1)"
    bodies = {
        "mask_email(email string) returns string": (
            f"if(instr(email, '@') > 1, concat(left({user}, 1), repeat('*', length({user}) - 2), right({user}, 1),"
            f" substr(email, length({user}) + 1)), null)"
        ),
        "mask_salary(val double) returns double": f"cast({fv.MASKED_SALARY} as double)",
        "is_apac_region(region string) returns boolean": f"coalesce(region = '{fv.VISIBLE_REGION}', false)",
    }
    for signature, body in bodies.items():
        spark.sql(f"create or replace temporary function {signature} return {body}")


def apply_policies(df: DataFrame, policies: Sequence[Policy], groups: Iterable[str] = ()) -> DataFrame:
    """The frame as a reader in the given groups may see it.

    Row filters test the true values, so they come before all masks. Use this
    on the table itself, before any join or aggregate shown to the reader.
    """
    readers = set(groups)
    in_force = [p for p in policies if not (p.exempt & readers)]
    tagged = column_tags(df)
    hits = [(p, c) for p in in_force for c, tags in tagged.items() if tags.get(p.tag[0]) == p.tag[1]]
    for policy, name in hits:
        if policy.kind == "filter":
            df = df.where(policy.function(df[name]))
    for policy, name in hits:
        if policy.kind == "mask":
            df = df.withColumn(name, policy.function(df[name]).alias(name, metadata=df.schema[name].metadata))
    return df
