"""Numeric column expressions (NUM-1..6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventsieve.functions.text import col_of


# Decimal or exponent notation, or an infinity; a cast alone also takes Java's '5d' and '5f'.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf(inity)?))\s*$"


# Types whose values are the numbers that their texts are read as.
NUMBER_TYPES = ("int", "bigint", "double")


def parse_number(c: str | Column, kind: str | None = None) -> Column:
    """Text or number to DOUBLE; bad text and NaN give null (pandas' coerce).

    ``kind`` is the column's type where it is known: numbers are then not written as text and read again."""
    if kind in NUMBER_TYPES:
        value = col_of(c).cast("double")
    else:
        text = col_of(c).cast("string")
        value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def parse_flag(c: str | Column, kind: str | None = None) -> Column:
    """Flag text to INT: unparsable -> 0, fractions truncated toward zero."""
    value = parse_number(c, kind)
    return F.coalesce(value.try_cast("int"), F.lit(0))


def sigmoid(z: Column, clip: float = 500.0) -> Column:
    clipped = F.greatest(F.least(z, F.lit(clip)), F.lit(-clip))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def ratio(numerator: Column, denominator: Column, floor: float = 1.0) -> Column:
    """``numerator / max(floor, denominator)`` as the reference guards ratios."""
    return numerator.cast("double") / F.greatest(F.lit(floor), denominator.cast("double"))


def linear_score(columns: list[str] | tuple[str, ...], weights, mean, std, intercept: float) -> Column:
    """``sigmoid(b + sum w_i * (x_i - m_i) / s_i)`` as one codegen'd expression."""
    z = F.lit(float(intercept))
    for name, w, m, s in zip(columns, weights, mean, std):
        z = z + F.lit(float(w)) * ((F.col(name).cast("double") - F.lit(float(m))) / F.lit(float(s)))
    return sigmoid(z)
