"""Keyed changes of a table: upsert, insert, update, delete.

All take the existing rows as a DataFrame and return the new content; writing it is up
to the caller. Keys are primary keys, so no key is hot; a small change set is broadcast
and leaves the existing table unshuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULT_LIMITS, Limits
from .ordering import surrogate_keys
from .sizing import fits_broadcast

# Employee fields that may change; key and start date may not.
UPDATABLE_EMPLOYEE_FIELDS = (
    "employee_id", "first_name", "last_name", "job_title", "department_key",
    "hire_date", "termination_date", "is_active", "end_date",
)


def _if_small(df: DataFrame, limits: Limits) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, limits) else df


def one_a_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with the same key the one with the largest values, column by column; NULL is the smallest."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.max(F.struct(*others)).alias("__row")).select(*keys, "__row.*").select(*rows.columns)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Incoming rows, one a key, replace existing rows of the same key; all others stay."""
    incoming = one_a_key(incoming, keys)
    replaced = _if_small(incoming.select(*keys), limits)
    kept = existing.join(replaced, keys, "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def absent_rows(existing: DataFrame, incoming: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Incoming rows, one a key, whose key the table does not have yet."""
    known = _if_small(existing.select(*keys), limits)
    return one_a_key(incoming, keys).join(known, keys, "left_anti")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Existing rows plus the incoming rows with new keys."""
    return existing.unionByName(absent_rows(existing, incoming, keys, limits).select(*existing.columns))


def insert_employees(dim_employee: DataFrame, new: DataFrame) -> DataFrame:
    """Append employees under fresh keys; ``is_active`` defaults to 1, ``start_date`` is compulsory."""
    if "start_date" not in new.columns:
        raise ValueError("start_date is compulsory")
    last = dim_employee.agg(F.coalesce(F.max("employee_key"), F.lit(0)).alias("k")).first().k
    active = F.coalesce("is_active", F.lit(1)) if "is_active" in new.columns else F.lit(1)
    fields = {f.name: f.dataType for f in dim_employee.schema.fields if f.name != "employee_key"}
    prepared = new.withColumn("is_active", active).select(
        *[
            (F.col(c) if c in new.columns or c == "is_active" else F.lit(None)).cast(t).alias(c)
            for c, t in fields.items()
        ]
    )
    keyed = surrogate_keys(prepared, "employee_key", ["employee_id"], "new-employees", last)
    return dim_employee.unionByName(keyed)


def update_employees(dim_employee: DataFrame, changes: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Partial update: a field changes where its ``set_<field>`` flag is true.

    ``changes`` has ``employee_key`` (unique) and, for each field it touches, the field and
    its flag, so "set to NULL" and "not supplied" stay apart.
    """
    touched = [c for c in changes.columns if c != "employee_key" and not c.startswith("set_")]
    refused = set(touched) - set(UPDATABLE_EMPLOYEE_FIELDS)
    if refused:
        raise ValueError(f"not updatable: {sorted(refused)}")
    renamed = changes.withColumnsRenamed({c: f"new_{c}" for c in touched})
    joined = dim_employee.join(_if_small(renamed, limits), "employee_key", "left")

    def value(c: str) -> Column:
        if c not in touched:
            return F.col(c)
        is_set = F.coalesce(F.col(f"set_{c}"), F.lit(False))
        return F.when(is_set, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in dim_employee.columns])


def delete_by_key(existing: DataFrame, keys: DataFrame, key: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return existing.join(_if_small(keys.select(key), limits), key, "left_anti")


def calendar_ids(dates: DataFrame, start: int = 0) -> DataFrame:
    """Number distinct dates in order; there are only as many as days in the calendar."""
    ids = F.row_number().over(Window.orderBy("work_date")).cast("long") + F.lit(start)
    return dates.withColumn("date_id", ids)
