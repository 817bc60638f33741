"""Equi-joins of a large side to a keyed side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_LIMITS, Limits
from .sizing import fits_broadcast, hot_keys

_SALT, _SALTS, _KEY = "__salt", "__salts", "__right_key"


def _equi_join(left: DataFrame, right: DataFrame, key: str, how: str, null_safe: bool, salted: bool = False) -> DataFrame:
    if not null_safe:
        return left.join(right, [key, _SALT] if salted else key, how)
    renamed = right.withColumnRenamed(key, _KEY)
    condition: Column = F.col(key).eqNullSafe(F.col(_KEY))
    if salted:
        renamed = renamed.withColumnRenamed(_SALT, _SALT + "_right")
        condition = condition & (F.col(_SALT) == F.col(_SALT + "_right"))
    return left.join(renamed, condition, how).drop(_KEY, _SALT + "_right")


def _with_salts(rows: DataFrame, key: str, salts: DataFrame) -> DataFrame:
    """Over how many tasks the key of a row is spread; the table of hot keys is bounded by the sketch that found them."""
    named = salts.withColumnRenamed(key, _KEY)
    joined = rows.join(F.broadcast(named), F.col(key).eqNullSafe(F.col(_KEY)), "left").drop(_KEY)
    return joined.withColumn(_SALTS, F.coalesce(_SALTS, F.lit(1)))


def _spread_join(left, right, key, how, null_safe, hot: dict, limits: Limits):
    """Each hot key of the left over as many tasks as its rows need; its right rows follow to all of them."""
    kind = left.select(key).schema.fields[0].dataType.simpleString()
    counts = [(k, -(-n // limits.hot_rows) + 1) for k, n in hot.items()]
    salts = left.sparkSession.createDataFrame(counts, f"`{key}` {kind}, {_SALTS} long")
    # By the row and the task that reads it: a repeated task repeats them, and copies of one row are spread too.
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id()), F.col(_SALTS))
    spread = _with_salts(left, key, salts).withColumn(_SALT, dealt).drop(_SALTS)
    copies = _with_salts(right, key, salts).withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_SALTS) - 1))).drop(_SALTS)
    return _equi_join(spread, copies, key, how, null_safe, salted=True).drop(_SALT)


def sized_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    null_safe: bool = False,
    hot: dict | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Join ``left`` to ``right`` on one column, by the measured size of the right.

    * small right: broadcast, the left is not shuffled;
    * otherwise one shuffle join on the key and a salt, which is 0 but for the hot keys of the left. These are found
      by a sketch, so the left is read twice at most, and each gets as many salts as its rows need.

    ``how`` is inner, left, left_semi or left_anti. All rows of every key are kept. The hot
    keys are sketched unless given.
    """
    if fits_broadcast(right, limits):
        return _equi_join(left, F.broadcast(right), key, how, null_safe)
    hot = hot_keys(left, key, limits) if hot is None else hot
    if not hot:
        return _equi_join(left, right, key, how, null_safe)
    return _spread_join(left, right, key, how, null_safe, hot, limits)
