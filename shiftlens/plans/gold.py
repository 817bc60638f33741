"""Staging rows to the star schema."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_LIMITS, SCD_END_SENTINEL, SCHEDULED_END, SCHEDULED_START, Limits
from ..functions.dates import calendar_parts
from ..functions.text import recategorize_comment
from ..operators.joins import sized_join
from ..operators.merge import calendar_ids
from ..operators.ordering import surrogate_keys

# Columns of the fact.
FACT_COLUMNS = (
    "employee_key", "department_key", "work_date", "punch_in", "punch_out",
    "scheduled_start", "scheduled_end", "hours_worked", "pay_code",
    "punch_in_comment", "punch_out_comment",
)


def _validity(as_of: dt.date) -> dict:
    return {"start_date": F.lit(as_of), "end_date": F.lit(SCD_END_SENTINEL)}


def dim_department(
    stg_employee: DataFrame, as_of: dt.date, by_arrival: bool = False, known: DataFrame | None = None, last_key: int = 0
) -> DataFrame:
    """Distinct departments with keys, by id and name or by first load time.

    With ``known`` departments, only those not among them, with keys after ``last_key``.
    """
    names = ["department_id", "department_name"]
    if by_arrival:
        found = stg_employee.groupBy(*names).agg(F.min("bronze_loaded_at").alias("__first"))
        if known is not None:
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in names])
            found = found.join(known.select(*[F.col(c).alias(f"known_{c}") for c in names]), same, "left_anti")
        keyed = surrogate_keys(found, "department_key", ["__first", *names], "departments", last_key, distinct=True).drop("__first")
    else:
        keyed = surrogate_keys(stg_employee.select(*names).distinct(), "department_key", names, "departments", distinct=True)
    return keyed.withColumns({"is_active": F.lit(1), **_validity(as_of)})


def dim_employee(
    stg_employee: DataFrame,
    departments: DataFrame,
    as_of: dt.date,
    by_arrival: bool = False,
    last_key: int = 0,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per staging row (and per name of its department id), with keys after ``last_key``.

    ``by_arrival`` keys by load time first, so that later loads leave earlier keys alone.
    """
    keys = departments.select("department_id", "department_key")
    joined = sized_join(stg_employee, keys, "department_id", "left", null_safe=True, limits=limits)
    order = ["bronze_loaded_at", "employee_id"] if by_arrival else ["employee_id"]
    fields = [
        "employee_id", "first_name", "last_name", "job_title", "department_key",
        "hire_date", "termination_date", "is_active",
    ]
    chosen = joined.select(*fields, *[c for c in order if c not in fields])
    keyed = surrogate_keys(chosen, "employee_key", order, "employees", last_key)
    return keyed.select("employee_key", *fields).withColumns(_validity(as_of))


def calendar_of(timesheets: DataFrame) -> DataFrame:
    """Distinct work dates with their calendar parts.

    The missing date is dropped after grouping; a filter on the column would move below the
    cleaning steps and parse every date a second time.
    """
    dates = timesheets.groupBy("work_date").agg(F.count("work_date").alias("n")).where("n > 0")
    return dates.select("work_date").withColumns(calendar_parts(F.col("work_date")))


def dim_date(timesheets: DataFrame, start: int = 0) -> DataFrame:
    return calendar_ids(calendar_of(timesheets), start).select("date_id", "work_date", "year", "month", "day", "week", "quarter")


def fact_timesheet(
    timesheets: DataFrame,
    employees: DataFrame,
    recategorize: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Timesheets with the keys of their employee.

    The inner join also drops timesheets of unknown employees, so unfiltered clean
    timesheets give the same result as staged ones. Their comments are categories, which
    ``recategorize`` passes through the keywords once more.
    """
    keys = employees.select("employee_id", "employee_key", "department_key")
    joined = sized_join(timesheets, keys, "employee_id", limits=limits).withColumns(
        {"scheduled_start": F.lit(SCHEDULED_START), "scheduled_end": F.lit(SCHEDULED_END)}
    )
    if recategorize:
        comments = [c for c in ("punch_in_comment", "punch_out_comment") if c in joined.columns]
        joined = joined.withColumns({c: recategorize_comment(F.col(c)) for c in comments})
    return joined.select(*[c for c in FACT_COLUMNS if c in joined.columns])
