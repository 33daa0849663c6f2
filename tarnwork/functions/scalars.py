"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tarnwork import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_from_marker(c: Column | str, marker: str = fv.RETURN_MARKER) -> Column:
    """True where the text is the marker; anything else, NULL included, is false."""
    return F.coalesce(_col(c) == F.lit(marker), F.lit(False))


def age_bucket(c: Column | str) -> Column:
    """Three age groups; an unknown age counts as senior."""
    age = _col(c)
    return (
        F.when(age < fv.AGE_YOUNG_BELOW, fv.AGE_YOUNG)
        .when(age < fv.AGE_MIDDLE_BELOW, fv.AGE_MIDDLE)
        .otherwise(fv.AGE_SENIOR)
    )


def bucket_label(c: Column | str, labels: Sequence[str]) -> Column:
    """The label at ``id modulo number of labels``."""
    place = F.pmod(_col(c), F.lit(len(labels))).cast("int")
    return F.element_at(F.array(*map(F.lit, labels)), place + 1)


def numbered_name(prefix: str, c: Column | str, width: int) -> Column:
    """Prefix and number with zeros up to ``width`` digits; a longer number stays whole."""
    return F.concat(F.lit(prefix), padded(c, width))


def padded(c: Column | str, width: int) -> Column:
    """Number as text with zeros up to ``width`` digits; a longer one stays whole."""
    digits = _col(c).cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def to_number(c: Column | str, sentinel: str = "null") -> Column:
    """Text to double; the sentinel and text that is not a number alone (``12d`` is not) become NULL."""
    text = _col(c).cast("string")
    number = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return F.when((text != sentinel) & text.rlike(number), text.try_cast("double"))


def map_label(c: Column | str, codes: Mapping[str, int], data_type: str = "int") -> Column:
    """Replace texts by their codes; a text without a code becomes NULL."""
    label = _col(c)
    out = F.lit(None).cast(data_type)
    for text, code in codes.items():
        out = F.when(label == text, F.lit(code).cast(data_type)).otherwise(out)
    return out


def ratio_safe(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return _col(a) / F.nullif(_col(b), F.lit(0))


def group_digits(c: Column | str, pattern: str = "#,###") -> Column:
    return F.call_function("format_number", _col(c), F.lit(pattern))


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def mask_email(c: Column | str) -> Column:
    """Keep first and last letter of the user part and the whole domain.

    The split is at the first ``@``. Without one, or with nothing before it,
    the result is NULL. A one-letter user part shows its letter twice.
    """
    email = _col(c)
    user = F.substring_index(email, "@", 1)
    size = F.length(user)
    domain = F.substr(email, size + 1)
    masked = F.concat(F.left(user, F.lit(1)), F.repeat(F.lit("*"), size - 2), F.right(user, F.lit(1)), domain)
    return F.when(F.instr(email, "@") > 1, masked)


def mask_constant(value: float = fv.MASKED_SALARY) -> Column:
    return F.lit(value)


def equals_value(c: Column | str, value: str = fv.VISIBLE_REGION) -> Column:
    """Row filter test: NULL is false, never NULL."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def date_or_default(value: str | None, default: Column) -> Column:
    """A date parameter: NULL and the empty text stand for the default."""
    return F.coalesce(F.to_date(F.nullif(F.lit(value).cast("string"), F.lit(""))), default)
