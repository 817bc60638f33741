"""Numbers in text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import unquote

# Plain decimal notation, blanks around it allowed; Spark alone would also take suffixes such as "1d".
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def finite_or(number: Column, default: float = 0.0) -> Column:
    """The number, or the default when it is missing or too large for a double."""
    return F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(F.lit(float(default)))


def clean_numeric(text: Column, default: float = 0.0) -> Column:
    """Number in a text, or the default. No placeholder has the form of a number."""
    return finite_or(parse_number(unquote(text)), default)


def without_nan(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def round_half_away(number: Column, digits: int = 0) -> Column:
    """Round the magnitude, half up, and keep the sign; zero has none."""
    return F.signum(number) * F.round(F.abs(number), digits) + F.lit(0.0)
