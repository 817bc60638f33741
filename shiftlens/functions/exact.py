"""Means of doubles, rounded to whole numbers, that depend on no order of rows and leave no row out.

A double counts with its shortest decimal form. No decimal type holds all of them, so each is added up in the one that
holds it without loss, with room for 10^11 rows: ``tiny`` has what lies beyond 18 digits after the point (36 are kept),
``plain`` is below 10^6, ``large`` below 10^17, ``huge`` below 10^27. Numbers beyond these, not finite ones too, are
``wild``: they are added as doubles, whose steps are then far above one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .numbers import round_half_away

_PLAIN, _LARGE, _HUGE = 1e6, 1e17, 1e27
_TYPES = {"tiny": "decimal(38,36)", "plain": "decimal(38,18)", "large": "decimal(38,10)", "huge": "decimal(38,0)", "wild": "double"}
PIECES = tuple(_TYPES)


def pieces(number: Column) -> dict[str, Column]:
    """The number in the piece that holds it; the others are NULL, and all are for a missing number."""
    size = F.abs(number)
    # Above a hundredth, 17 digits end within 18 places.
    beyond = number.try_cast("decimal(38,36)") - number.try_cast("decimal(38,18)").try_cast("decimal(38,36)")
    found = {
        "tiny": F.when((size < 0.01) & (size > 0), beyond),
        "plain": F.when(size < _PLAIN, number),
        "large": F.when((size >= _PLAIN) & (size < _LARGE), number),
        "huge": F.when((size >= _LARGE) & (size < _HUGE), number),
        "wild": F.when((size >= _HUGE) | F.isnan(number), number),
    }
    return {name: value.try_cast(_TYPES[name]) for name, value in found.items()}


def sums(prefix: str, over: Callable[[Column], Column] = lambda c: c) -> dict[str, Column]:
    """Sums of columns ``<prefix><piece>``, NULL where a piece has no number."""
    return {f"{prefix}{name}": over(F.sum(f"{prefix}{name}")) for name in PIECES}


def _whole(value: Column, n: Column) -> tuple[Column, Column]:
    """Floored quotient, and what remains from 0 to below ``n``."""
    rest = F.pmod(value, n)
    return F.round((value - rest).cast("double") / n.cast("double")), rest


def rounded_mean(prefix: str, count: Column) -> Column:
    """Sum of the pieces divided by the count, half away from zero; NULL when nothing was counted.

    Exact up to 2^53, from where on doubles have no fractions; beyond, within their last digit.
    """
    tiny, plain, large, huge, wild = (F.col(f"{prefix}{name}") for name in PIECES)
    zero = lambda c, name: F.coalesce(c, F.lit(0).cast(_TYPES[name]))
    n = count.cast("decimal(15,0)")
    whole_huge, rest = _whole(zero(huge, "huge"), n)
    whole_large, rest = _whole((zero(large, "large").cast("decimal(37,10)") + rest.cast("decimal(15,0)")).cast("decimal(38,10)"), n)
    whole_plain, rest = _whole((zero(plain, "plain").cast("decimal(37,18)") + rest.cast("decimal(26,10)")).cast("decimal(37,18)"), n)
    whole = whole_huge + whole_large + whole_plain
    # Twice the fraction against one; what is tiny decides only next to a half.
    over = (rest.cast("decimal(33,18)") - (n - rest.cast("decimal(33,18)"))).cast("decimal(34,18)")
    near = F.abs(over) < F.lit(0.001).cast("decimal(4,3)")
    small = zero(tiny, "tiny")
    side = F.when(near, F.signum((over.cast("decimal(37,36)") + (small + small).cast("decimal(37,36)")).cast("double"))).otherwise(F.signum(over.cast("double")))
    below_zero = (whole < 0) | ((whole == 0) & (rest == 0) & (small < 0))
    up = F.when(below_zero, side > 0).otherwise(side >= 0)
    exact = whole + up.cast("double")
    rough = plain.cast("double") / count
    only_plain = tiny.isNull() & large.isNull() & huge.isNull()
    # Away from a half the double's quotient rounds alike, at a fraction of the cost.
    clear = F.abs(F.abs(rough - F.floor(rough)) - 0.5) > 0.0001
    in_range = F.abs(rough) < 1e9
    as_double = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    wild_mean = (wild + as_double(huge) + as_double(large) + as_double(plain)) / count
    return (
        F.when(count == 0, F.lit(None).cast("double"))
        .when(wild.isNotNull() & (wild != 0), round_half_away(wild_mean))
        .when(only_plain & in_range & clear, F.round(rough) + F.lit(0.0))
        .otherwise(exact + F.lit(0.0))
    )
