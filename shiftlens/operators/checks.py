"""Data-quality measures. Each is one aggregate that returns a single row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import clean_date
from ..functions.numbers import parse_number, without_nan


def _long(value) -> Column:
    return F.lit(value).cast("long")


def count_null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def row_count(df: DataFrame, table: str, min_rows: int = 1) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count"), (n >= min_rows).alias("passed")).select(
        F.lit(table).alias("table_name"), "row_count", "passed"
    )


def null_counts(df: DataFrame, critical: list[str]) -> DataFrame:
    """NULLs per critical column; columns the table lacks are ignored."""
    present = [c for c in critical if c in df.columns]
    return df.agg(*[count_null(c).alias(c) for c in present] or [_long(0).alias("no_column")])


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share their key with another row, all of them; NULL equals NULL."""
    present = [c for c in keys if c in df.columns]
    if not present:
        return df.agg(_long(0).alias("duplicate_count"))
    sizes = df.groupBy(*present).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return sizes.agg(F.coalesce(F.sum("n"), _long(0)).alias("duplicate_count"))


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = parse_number(F.col(column)) if isinstance(kind, T.StringType) else F.col(column)
    return without_nan(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _outside(value: Column, low, high, below: str, above: str, least: str, most: str) -> list[Column]:
    return [
        (F.count_if(value < F.lit(low)) if low is not None else _long(0)).alias(below),
        (F.count_if(value > F.lit(high)) if high is not None else _long(0)).alias(above),
        F.min(value).alias(least),
        F.max(value).alias(most),
    ]


def _nothing_outside(names: tuple[str, ...], kind: str) -> list[Column]:
    """Measures of a column the table lacks."""
    unknown = F.lit(None).cast(kind)
    return [_long(0).alias(names[0]), _long(0).alias(names[1]), unknown.alias(names[2]), unknown.alias(names[3])]


def numeric_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Values strictly outside the range, and the actual range. NULL is inside."""
    names = ("below_min", "above_max", "min_val", "max_val")
    if column not in df.columns:
        return df.agg(*_nothing_outside(names, "double"))
    return df.agg(*_outside(_as_number(df, column), low, high, *names))


def date_range(df: DataFrame, column: str, low: dt.date | None = None, high: dt.date | None = None) -> DataFrame:
    """Dates strictly outside the range, and the actual range. NULL is inside."""
    names = ("before_min", "after_max", "min_date", "max_date")
    if column not in df.columns:
        return df.agg(*_nothing_outside(names, "date"))
    value = clean_date(F.col(column)) if isinstance(df.schema[column].dataType, T.StringType) else F.col(column)
    return df.agg(*_outside(value, low, high, *names))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent. Both sides are distinct before the join."""
    mine = child.select(F.col(child_key).alias("orphan")).where(F.col("orphan").isNotNull()).distinct()
    theirs = parent.select(F.col(parent_key).alias("orphan")).distinct()
    return mine.join(theirs, "orphan", "left_anti")


def ref_integrity(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Number of orphan keys; a missing key column passes."""
    if child_key not in child.columns or parent_key not in parent.columns:
        return child.agg(_long(0).alias("orphan_count"))
    return orphan_keys(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("orphan_count"))


def orphan_samples(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, n: int = 10) -> DataFrame:
    return orphan_keys(child, parent, child_key, parent_key).limit(n)
