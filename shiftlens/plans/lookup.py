"""Filter, search, page and point lookups over the star schema."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_LIMITS, Limits
from ..operators.joins import sized_join
from ..operators.ordering import By, page
from ..sources.tables import WORK_MONTH


def latest_first() -> list[By]:
    """Order of timesheet listings: latest first; ``page`` completes it to a total order."""
    return [By("work_date", down=True), By("employee_key"), By("punch_in"), By("punch_out"), By("hours_worked")]


def search_employees(dim_employee: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring of a name or the employee id; ``%`` and ``_`` stay wildcards."""
    pattern = f"%{text}%"
    return dim_employee.where(
        F.col("first_name").ilike(pattern) | F.col("last_name").ilike(pattern) | F.col("employee_id").ilike(pattern)
    )


def filter_employees(
    dim_employee: DataFrame, is_active: int | None = None, department_key: int | None = None, search: str | None = None
) -> DataFrame:
    rows = dim_employee
    if is_active is not None:
        rows = rows.where(F.col("is_active") == is_active)
    if department_key is not None:
        rows = rows.where(F.col("department_key") == department_key)
    return search_employees(rows, search) if search else rows


def filter_timesheets(
    fact: DataFrame,
    employee_key: int | None = None,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    department_key: int | None = None,
    pay_code: str | None = None,
) -> DataFrame:
    """Timesheets by any of the filters. A stored fact read with its month prunes its folders by the dates."""
    rows = fact
    if WORK_MONTH in fact.columns:
        months = [F.col(WORK_MONTH) >= f"{date_from:%Y-%m}"] if date_from is not None else []
        months += [F.col(WORK_MONTH) <= f"{date_to:%Y-%m}"] if date_to is not None else []
        rows = reduce(DataFrame.where, months, rows).drop(WORK_MONTH)
    if employee_key is not None:
        rows = rows.where(F.col("employee_key") == employee_key)
    if date_from is not None:
        rows = rows.where(F.col("work_date") >= F.lit(date_from))
    if date_to is not None:
        rows = rows.where(F.col("work_date") <= F.lit(date_to))
    if department_key is not None:
        rows = rows.where(F.col("department_key") == department_key)
    if pay_code is not None:
        rows = rows.where(F.col("pay_code") == pay_code)
    return rows


def total(rows: DataFrame) -> DataFrame:
    """Number of rows that go with a page."""
    return rows.agg(F.count(F.lit(1)).alias("total"))


def list_employees(
    dim_employee: DataFrame, number: int = 1, size: int = 20, limits: Limits = DEFAULT_LIMITS, **filters
) -> tuple[DataFrame, DataFrame]:
    """A page of employees by key, and the total."""
    rows = filter_employees(dim_employee, **filters)
    return page(rows, [By("employee_key")], number, size, limits), total(rows)


def list_timesheets(
    fact: DataFrame, number: int = 1, size: int = 20, limits: Limits = DEFAULT_LIMITS, **filters
) -> tuple[DataFrame, DataFrame]:
    """A page of timesheets, latest first, and the total."""
    rows = filter_timesheets(fact, **filters)
    return page(rows, latest_first(), number, size, limits), total(rows)


def get_employee(dim_employee: DataFrame, employee_key: int) -> DataFrame:
    """The employee, or no row when there is none."""
    return dim_employee.where(F.col("employee_key") == employee_key).limit(1)


def with_employee(fact: DataFrame, dim_employee: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Fact rows with their employee as a nested record, NULL when there is none."""
    nested = dim_employee.select("employee_key", F.struct(*dim_employee.columns).alias("employee"))
    return sized_join(fact, nested, "employee_key", "left", limits=limits)


def get_timesheet(fact: DataFrame, dim_employee: DataFrame, timesheet_id: int) -> DataFrame:
    """One stored timesheet with its employee, or no row. One row needs no size check."""
    nested = dim_employee.select("employee_key", F.struct(*dim_employee.columns).alias("employee"))
    return fact.where(F.col("id") == timesheet_id).limit(1).join(nested, "employee_key", "left")


def employee_timesheets(
    fact: DataFrame,
    dim_employee: DataFrame,
    employee_key: int,
    number: int = 1,
    size: int = 20,
    limits: Limits = DEFAULT_LIMITS,
    **filters,
) -> tuple[DataFrame, DataFrame]:
    """Timesheets of one employee. An unknown employee is an error, not an empty page."""
    if get_employee(dim_employee, employee_key).isEmpty():
        raise LookupError(f"no employee with key {employee_key}")
    return list_timesheets(fact, number, size, limits, employee_key=employee_key, **filters)


def timesheets_of_id(
    fact: DataFrame, dim_employee: DataFrame, employee_id: str, number: int = 1, size: int = 20, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Timesheets under a business id, whatever keys the id has."""
    keys = dim_employee.where(F.col("employee_id") == employee_id).select("employee_key")
    rows = sized_join(fact, keys, "employee_key", "left_semi", limits=limits)
    return page(rows, latest_first(), number, size, limits)
