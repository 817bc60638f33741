"""The stored star schema, kept up to date with staging.

Staging only grows, batch by batch, and each batch comes later than all before it. So a run takes the batches that the
star schema has not seen and works out what they change:

* departments and employees of new rows get keys after the last ones; earlier keys stay, since keys go by arrival;
* the fact changes in the months of new timesheets, and in those of earlier timesheets whose employee was sent again.
  Only these months are computed from staging and overwritten, in the current version of the table;
* a new name for a known department id adds a row to earlier employees, whose keys would move: then, and when the
  options of the run changed, all is rebuilt.

Without new batches nothing is written. The batches seen are noted last, with the highest keys in use, so a run that
stopped half-way is done again with the same result. Batches whose load has not moved its mark yet are left for later.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_LIMITS, Limits, scratch_path
from ..operators.joins import sized_join
from ..operators.merge import absent_rows, calendar_ids, upsert_by_key
from ..sources import tables as t
from ..sources.tables import Warehouse
from . import gold, silver

SKIPPED = {"status": "skipped", "reason": "no staging data"}
_RAW_OF = {t.STG_EMPLOYEE: "raw_employee", t.STG_TIMESHEET: "raw_timesheet"}
_STAR = (t.DIM_DEPARTMENT, t.DIM_EMPLOYEE, t.DIM_DATE, t.FACT_TIMESHEET)
#: Stored tables by their names.
STAR = {name.rsplit("/", 1)[-1]: name for name in _STAR}


@dataclass(frozen=True)
class Changes:
    """Batches by staging table, and the highest keys given before them; ``rebuild`` when all is to be done anew."""

    staged: dict[str, set[str]]
    fresh: dict[str, set[str]]
    department_key: int
    employee_key: int
    rebuild: bool

    def any(self) -> bool:
        return self.rebuild or any(self.fresh.values())


def complete_batches(warehouse: Warehouse, name: str) -> set[str]:
    """Batches of a staging table without the one that a load may still be writing."""
    mark = silver.watermark_of(warehouse.read(t.WATERMARK), _RAW_OF[name])
    return warehouse.batches(name) - {silver.batch_key(mark)}


def changes_since(warehouse: Warehouse, recategorize: bool) -> Changes:
    """What staging holds beyond the star schema; the state has one row a batch."""
    seen = warehouse.read(t.STAR_STATE).collect()
    staged = {name: complete_batches(warehouse, name) for name in _RAW_OF}
    known = {name: {r.batch_key for r in seen if r.table_name == name} for name in _RAW_OF}
    last = max(seen, key=lambda r: (r.employee_keys, r.department_keys), default=None)
    rebuild = bool(last) and (any(known[n] - staged[n] for n in known) or any(r.recategorize != recategorize for r in seen))
    rebuild = rebuild or (last is None and any(staged.values()))
    keys = (last.department_keys, last.employee_keys) if last else (0, 0)
    return Changes(staged, {n: staged[n] - known[n] for n in staged}, *keys, rebuild)


def staged_rows(warehouse: Warehouse, name: str, batches: set[str]) -> DataFrame:
    """Rows of some batches; the folders of all others are not read."""
    rows = warehouse.read(name, with_helpers=True)
    return rows.where(F.col(t.BATCH_KEY).isin(*batches) if batches else F.lit(False)).drop(t.BATCH_KEY)


def _note(warehouse: Warehouse, changes: Changes, recategorize: bool, keys: tuple[int, int]) -> None:
    rows = [(name, batch, recategorize, *keys) for name, batches in changes.staged.items() for batch in sorted(batches)]
    state = warehouse.spark.createDataFrame(rows, t.SCHEMAS[t.STAR_STATE])
    warehouse.replace(t.STAR_STATE, state.coalesce(1))
    warehouse.drop_old(t.STAR_STATE)


def _store(warehouse: Warehouse, name: str, rows: DataFrame) -> None:
    warehouse.replace(name, rows)
    warehouse.drop_old(name)


def _last_key(rows: DataFrame, key: str, least: int = 0) -> int:
    return rows.agg(F.coalesce(F.max(key), F.lit(least)).alias("k")).first().k


def _add_dates(warehouse: Warehouse, timesheets: DataFrame, limits: Limits) -> None:
    """Work dates that the calendar lacks, numbered after the last one."""
    known = warehouse.read(t.DIM_DATE)
    days = scratch_path(warehouse.spark, "days")  # one row a day, so that staging is read once
    gold.calendar_of(timesheets).write.parquet(days)
    absent = absent_rows(known, warehouse.spark.read.parquet(days), ["work_date"], limits)
    if absent.isEmpty():
        return
    dates = calendar_ids(absent, _last_key(known, "date_id")).select(*known.columns)
    _store(warehouse, t.DIM_DATE, known.unionByName(dates).coalesce(1))


# All of it


def dimensions(staged: DataFrame, as_of: dt.date, limits: Limits) -> tuple[DataFrame, DataFrame]:
    departments = gold.dim_department(staged, as_of, by_arrival=True)
    return departments, gold.dim_employee(staged, departments, as_of, by_arrival=True, limits=limits)


def write_fact(warehouse: Warehouse, fact: DataFrame, mode: str = "overwrite") -> int:
    """Rows written, as a new version of the table or in addition to it."""
    name, first = t.FACT_TIMESHEET, 1
    if mode == "append":
        first += _last_key(warehouse.read(name), "id")
        warehouse.extend(name, fact, first)
    else:
        _store(warehouse, name, fact)
    return warehouse.read(name).where(F.col("id") >= first).count()


def rebuild(
    warehouse: Warehouse, batches: dict[str, set[str]], as_of: dt.date, fact_mode: str, recategorize: bool, limits: Limits
) -> dict:
    """The star schema from all of staging; ``fact_mode="append"`` adds the whole fact again."""
    staged, timesheets = (staged_rows(warehouse, name, batches[name]) for name in _RAW_OF)
    departments, employees = dimensions(staged, as_of, limits)
    for name, key, rows in ((t.DIM_DEPARTMENT, "department_key", departments), (t.DIM_EMPLOYEE, "employee_key", employees)):
        _store(warehouse, name, upsert_by_key(warehouse.read(name), rows, [key], limits))
    _add_dates(warehouse, timesheets, limits)
    written = write_fact(warehouse, gold.fact_timesheet(timesheets, employees, recategorize, limits), fact_mode)
    return {**counts(warehouse), "fact_timesheet": written}


# What changed


@dataclass(frozen=True)
class NewRows:
    """Rows that new batches add to the dimensions, and the dimensions with them."""

    departments: DataFrame
    employees: DataFrame
    all_departments: DataFrame
    all_employees: DataFrame
    known_employees: DataFrame


def _new_dimension_rows(warehouse: Warehouse, changes: Changes, as_of: dt.date, limits: Limits) -> NewRows | None:
    """None when keys of earlier employees would move."""
    arrived = staged_rows(warehouse, t.STG_EMPLOYEE, changes.fresh[t.STG_EMPLOYEE])
    # Rows beyond the noted keys come from a run that did not end.
    known_departments = warehouse.read(t.DIM_DEPARTMENT).where(F.col("department_key") <= changes.department_key)
    known_employees = warehouse.read(t.DIM_EMPLOYEE).where(F.col("employee_key") <= changes.employee_key)
    departments = gold.dim_department(arrived, as_of, by_arrival=True, known=known_departments, last_key=changes.department_key)
    renamed = sized_join(departments.select("department_id"), known_departments.select("department_id"), "department_id", "left_semi", null_safe=True, limits=limits)
    if not renamed.isEmpty():
        return None
    all_departments = known_departments.unionByName(departments.select(*known_departments.columns))
    employees = gold.dim_employee(arrived, all_departments, as_of, by_arrival=True, last_key=changes.employee_key, limits=limits)
    all_employees = known_employees.unionByName(employees.select(*known_employees.columns))
    return NewRows(departments, employees, all_departments, all_employees, known_employees)


def changed_months(fresh: DataFrame, earlier: DataFrame, resent: DataFrame | None, limits: Limits) -> list[str | None]:
    """Months of new timesheets, and of earlier ones of employees that were sent again; at most those of the calendar."""
    month = F.date_format("work_date", "yyyy-MM").alias("month")
    months = fresh.select(month)
    if resent is not None:
        again = sized_join(earlier.select("employee_id", "work_date"), resent, "employee_id", "left_semi", limits=limits)
        months = months.union(again.select(month))
    return [r.month for r in months.distinct().collect()]


def in_months(months: list[str | None]) -> Column:
    """Whether a work date lies in one of the months; the range of their days reaches the scan."""
    named = sorted(m for m in months if m is not None)
    wanted = F.lit(False)
    if named:
        first, last = F.lit(f"{named[0]}-01").cast("date"), F.last_day(F.lit(f"{named[-1]}-01").cast("date"))
        wanted = F.col("work_date").between(first, last) & F.date_format("work_date", "yyyy-MM").isin(named)
    return wanted | F.col("work_date").isNull() if None in months else wanted


def _update_fact(warehouse: Warehouse, changes: Changes, rows: NewRows | None, recategorize: bool, limits: Limits) -> list[str | None]:
    """Overwrite the months that changed; their names."""
    fresh = staged_rows(warehouse, t.STG_TIMESHEET, changes.fresh[t.STG_TIMESHEET])
    everything = staged_rows(warehouse, t.STG_TIMESHEET, changes.staged[t.STG_TIMESHEET])
    resent, employees = None, warehouse.read(t.DIM_EMPLOYEE)
    if rows is not None:
        resent = rows.employees.select("employee_id").distinct().join(rows.known_employees.select("employee_id").distinct(), "employee_id", "left_semi")
        resent = None if resent.isEmpty() else resent
    months = changed_months(fresh, everything, resent, limits)
    if months:
        fact = gold.fact_timesheet(everything.where(in_months(months)), employees, recategorize, limits)
        first = _last_key(warehouse.read(t.FACT_TIMESHEET), "id") + 1
        warehouse.rewrite(t.FACT_TIMESHEET, fact, first)
    return months


def counts(warehouse: Warehouse) -> dict[str, int]:
    """Rows of each table, from the footers of its files."""
    return {name: warehouse.read(table).count() for name, table in STAR.items()}


def load_star(
    warehouse: Warehouse, as_of: dt.date, fact_mode: str = "overwrite", recategorize: bool = True, limits: Limits = DEFAULT_LIMITS
) -> dict:
    """Bring the star schema up to date; rows of earlier runs keep the ``as_of`` of theirs.

    ``fact_mode="append"`` rebuilds the dimensions and adds the whole fact again on every run.
    """
    changes = changes_since(warehouse, recategorize)
    if not changes.staged[t.STG_EMPLOYEE]:
        return SKIPPED
    if fact_mode == "overwrite" and not changes.any():
        return {"status": "success", **counts(warehouse)}
    rows, result = None, None
    whole = fact_mode == "append" or changes.rebuild
    if not whole and changes.fresh[t.STG_EMPLOYEE]:
        rows = _new_dimension_rows(warehouse, changes, as_of, limits)
        whole = rows is None
    if whole:
        result = rebuild(warehouse, changes.staged, as_of, fact_mode, recategorize, limits)
    else:
        if rows is not None:
            if not rows.departments.isEmpty():
                _store(warehouse, t.DIM_DEPARTMENT, rows.all_departments)
            _store(warehouse, t.DIM_EMPLOYEE, rows.all_employees)
        _add_dates(warehouse, staged_rows(warehouse, t.STG_TIMESHEET, changes.fresh[t.STG_TIMESHEET]), limits)
        _update_fact(warehouse, changes, rows, recategorize, limits)
    keys = tuple(_last_key(warehouse.read(name), key) for name, key in ((t.DIM_DEPARTMENT, "department_key"), (t.DIM_EMPLOYEE, "employee_key")))
    _note(warehouse, changes, recategorize, keys)
    return {"status": "success", **(result or counts(warehouse))}


def refresh_fact(warehouse: Warehouse, as_of: dt.date, limits: Limits = DEFAULT_LIMITS) -> dict:
    """Rebuild only the fact, with keys derived from staging again; empty staging leaves it as it is."""
    staged, timesheets = warehouse.read(t.STG_EMPLOYEE), warehouse.read(t.STG_TIMESHEET)
    if staged.isEmpty() or timesheets.isEmpty():
        return SKIPPED
    _, employees = dimensions(staged, as_of, limits)
    return {"status": "success", "records": write_fact(warehouse, gold.fact_timesheet(timesheets, employees, limits=limits))}


def star_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.read(table) for name, table in STAR.items()}
