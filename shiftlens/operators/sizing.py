"""Measured sizes and hot keys, the facts behind every physical choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import DEFAULT_LIMITS, Limits


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_value_bytes(value[f.name], f.dataType) for f in kind.fields], F.lit(16))
    return F.lit(16)


def _row_bytes(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields], F.lit(16))


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows take in memory, from one map-side-combined aggregate."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df).cast("long")), F.lit(0)).alias("b")).first().b


def fits_broadcast(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    return measured_bytes(df) <= limits.broadcast_bytes


def hot_keys(df: DataFrame, key: str, limits: Limits = DEFAULT_LIMITS) -> dict:
    """Rows of the keys that are too many for one task, NULL among them, from one pass that shuffles sketches only.

    The sketch counts frequent items within ``3.5 / tracked_keys`` of all rows, so it misses no key with that share;
    rarer keys are no burden for a task among that many rows. However many keys are hot, all of them are found.
    """
    top = F.expr(f"approx_top_k(`{key}`, {limits.tracked_keys}, {limits.tracked_keys})")
    found = df.agg(F.filter(top, lambda x: x["count"] >= limits.hot_rows).alias("top")).first()
    return {r["item"]: r["count"] for r in found.top or ()}


def is_one_of(key: str, values) -> Column:
    """Two-valued membership test that can also look for NULL."""
    column = F.col(key)
    known = [v for v in values if v is not None]
    member = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
    return member | column.isNull() if None in values else member
