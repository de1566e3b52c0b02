"""Exact decimals as column expressions. Numbers go through text, never through float."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a number as text, with optional sign, fraction and exponent.
NUMBER = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"


def _text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def _mantissa(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "e", 1), "E", 1)


def is_number(value: Column) -> Column:
    """Whether the text form is a number; null for null."""
    return _text(value).rlike(NUMBER)


def significant_digits(value: Column) -> Column:
    """Digits without leading zeros, at least one; trailing zeros count."""
    digits = F.ltrim(F.replace(_mantissa(_text(value)), F.lit("."), F.lit("")), F.lit("+-0"))
    return F.greatest(F.length(digits), F.lit(1))


def scale_of(value: Column) -> Column:
    """Digits after the decimal point, with an exponent worked in."""
    text = _text(value)
    mantissa = _mantissa(text)
    point = F.instr(mantissa, ".")
    decimals = F.when(point > 0, F.length(mantissa) - point).otherwise(0)
    # the exponent is what follows the mantissa and its mark
    exponent = F.substring(text, F.length(mantissa) + 2, F.length(text)).try_cast("int")
    has_exponent = F.length(mantissa) < F.length(text)
    return F.greatest(F.when(has_exponent, decimals - exponent).otherwise(decimals), F.lit(0))


def decimal_problem(value: Column, precision: int, scale: int) -> Column:
    """Why a value does not keep all its digits in decimal(precision, scale); else null."""
    return (
        F.when(value.isNull(), None)
        .when(~is_number(value), "not_a_number")
        .when(significant_digits(value) > precision, "precision")
        .when(scale_of(value) > scale, "scale")
    )


def exact_decimal(value: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """decimal(precision, scale) through text; blank is null.

    A value that does not fit is an error, or null when not ``strict``.
    """
    text = F.nullif(_text(value), F.lit(""))
    target = f"decimal({precision},{scale})"
    return text.cast(target) if strict else text.try_cast(target)


def decimal_text(value: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """Text with exactly ``scale`` decimals."""
    return exact_decimal(value, precision, scale, strict).cast("string")
