"""Raw text rows to clean, typed staging rows."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT_LIMITS, TERMINATION_SENTINEL, Limits
from ..functions.dates import active_at, in_range, ntz, timestamp_of
from ..functions.numbers import finite_or, parse_number
from ..functions.text import category_of, unquote, value_of
from ..operators.joins import sized_join
from ..operators.merge import upsert_by_key

BEGINNING = dt.datetime(1, 1, 1)


def _staged(raw: DataFrame, names: dict[str, str], bare: dict, parsed: dict, last: dict, order: tuple[str, ...]) -> DataFrame:
    """Rename, unquote, parse and finish the columns that exist, then take them in order.

    Each step is a projection of its own. One expression per column would repeat the step
    before for each of its uses, and a row would cost several times as much.
    """
    df = raw.withColumnsRenamed(names)

    def step(now: DataFrame, functions: dict) -> DataFrame:
        return now.withColumns({c: f(F.col(c)) for c, f in functions.items() if c in now.columns})

    for functions in ({c: unquote for c in bare}, parsed, last):
        df = step(df, functions)
    return df.select(*[c for c in order if c in df.columns])


def _text(default: str | None = None):
    return lambda bare: value_of(bare, default)


_EMPLOYEE_TEXT = {
    "employee_id": _text("UNKNOWN"), "first_name": _text(""), "last_name": _text(""), "job_title": _text("Unknown"),
    "department_id": _text(), "department_name": _text("Unknown"), "source_file": _text(),
}
_EMPLOYEE_ORDER = (
    "employee_id", "first_name", "last_name", "job_title", "department_id", "department_name",
    "hire_date", "termination_date", "is_active", "source_file", "bronze_loaded_at",
)


def _moment(formats: Sequence[str]):
    return lambda bare: timestamp_of(bare, formats)


def clean_employee(raw: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Clean raw employees; absent optional columns get their defaults.

    Dates are ISO, or of one of ``date_formats``.
    """
    absent = {c: F.lit(None).cast("string") for c in ("hire_date",) if c not in raw.columns}
    if not {"term_date", "termination_date"} & set(raw.columns):
        absent["term_date"] = F.lit(None).cast("string")
    elif "term_date" in raw.columns:
        raw = raw.drop("termination_date")
    moment = _moment(date_formats)
    parsed = {**_EMPLOYEE_TEXT, "hire_date": moment, "termination_date": moment}
    names = {"client_employee_id": "employee_id", "term_date": "termination_date", "loaded_at": "bronze_loaded_at"}
    ends = _staged(
        raw.withColumns(absent), names, parsed, parsed, {c: in_range for c in ("hire_date", "termination_date")}, _EMPLOYEE_ORDER
    )
    end = F.col("termination_date")
    flagged = ends.withColumns({
        "hire_date": F.col("hire_date").cast("date"),
        "is_active": active_at(end),
        "termination_date": F.coalesce(end.cast("date"), F.lit(TERMINATION_SENTINEL)),
    })
    return flagged.select(*[c for c in _EMPLOYEE_ORDER if c in flagged.columns])


_TIMESHEET_NAMES = {
    "client_employee_id": "employee_id", "punch_apply_date": "work_date", "punch_in_datetime": "punch_in",
    "punch_out_datetime": "punch_out", "loaded_at": "bronze_loaded_at",
}
_TIMESHEET_ORDER = (
    "employee_id", "work_date", "punch_in", "punch_out", "hours_worked", "pay_code",
    "punch_in_comment", "punch_out_comment", "source_file", "bronze_loaded_at",
)


def clean_timesheet(raw: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Clean raw timesheets; absent optional columns get their defaults.

    Dates and times are ISO, or of one of ``date_formats``.
    """
    moment = _moment(date_formats)
    comments = [c for c in ("punch_in_comment", "punch_out_comment") if c in raw.columns]
    parsed = {
        "employee_id": _text("UNKNOWN"), "pay_code": _text(""), "source_file": _text(),
        "work_date": moment, "punch_in": moment, "punch_out": moment,
        "hours_worked": parse_number, **{c: F.upper for c in comments},
    }
    last = {
        "work_date": lambda d: in_range(d).cast("date"), "punch_in": in_range, "punch_out": in_range,
        "hours_worked": finite_or,
        **{c: category_of for c in comments},
    }
    rows = _staged(raw, _TIMESHEET_NAMES, parsed, parsed, last, _TIMESHEET_ORDER)
    no_time = F.lit(None).cast("timestamp_ntz")
    defaults = {
        "work_date": no_time.cast("date"), "punch_in": no_time, "punch_out": no_time,
        "hours_worked": F.lit(0.0), "punch_in_comment": F.lit(""), "punch_out_comment": F.lit(""),
    }
    complete = rows.withColumns({c: v for c, v in defaults.items() if c not in rows.columns})
    return complete.select(*[c for c in _TIMESHEET_ORDER if c in complete.columns])


def _employee_ids(employees: DataFrame) -> DataFrame:
    return employees.select("employee_id").where(F.col("employee_id").isNotNull()).distinct()


def keep_known(timesheets: DataFrame, employees: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Timesheets of known employees."""
    return sized_join(timesheets, _employee_ids(employees), "employee_id", "left_semi", limits=limits)


def orphan_rejects(timesheets: DataFrame, employees: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Timesheets that ``keep_known`` drops."""
    return sized_join(timesheets, _employee_ids(employees), "employee_id", "left_anti", limits=limits)


def orphan_counts(timesheets: DataFrame, employees: DataFrame) -> DataFrame:
    """Dropped rows per employee id, counted before the join, so that no id is hot."""
    counts = timesheets.groupBy("employee_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(_employee_ids(employees), "employee_id", "left_anti")


# High-water marks


def watermark_of(state: DataFrame, table: str) -> dt.datetime:
    """Last processed load time of a table (the state has one row a table)."""
    row = state.where(F.col("table_name") == table).select("last_processed_at").first()
    return row.last_processed_at if row and row.last_processed_at else BEGINNING


def rows_after(raw: DataFrame, watermark: dt.datetime | str) -> DataFrame:
    """Rows loaded strictly after the mark; the filter reaches the scan."""
    return raw.where(F.col("loaded_at") > ntz(watermark))


def next_marks(spark: SparkSession, **raw_tables: DataFrame) -> DataFrame:
    """Highest load time per table; tables without rows keep their old mark."""
    marks = [
        raw.agg(F.max("loaded_at").alias("last_processed_at")).select(F.lit(name).alias("table_name"), "last_processed_at")
        for name, raw in raw_tables.items()
    ]
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out.where(F.col("last_processed_at").isNotNull())


def advance_marks(state: DataFrame, marks: DataFrame, updated_at: dt.datetime | str) -> DataFrame:
    return upsert_by_key(state, marks.withColumn("updated_at", ntz(updated_at)), ["table_name"])


def batch_id(table: str, watermark: dt.datetime | str) -> str:
    """Eight hex characters. A load repeated from the same mark gets the same id and replaces itself."""
    return hashlib.md5(f"{table}@{watermark}".encode()).hexdigest()[:8]


def batch_key(watermark: dt.datetime) -> str:
    """The partition of a batch: its mark in full, so no two batches of a table share it."""
    return watermark.isoformat(timespec="microseconds").replace(":", "")


def stamp(df: DataFrame, etl_batch_id: str, processed_at: dt.datetime | str) -> DataFrame:
    return df.withColumns({"etl_batch_id": F.lit(etl_batch_id), "processed_at": ntz(processed_at)})
