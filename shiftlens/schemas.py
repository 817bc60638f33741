"""Declared schemas of the raw, staging and star-schema tables."""

from __future__ import annotations

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_TEXT, _DATE, _INT, _LONG, _DOUBLE = T.StringType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType()

RAW_EMPLOYEE_COLUMNS = (
    "client_employee_id", "first_name", "last_name", "job_title",
    "department_id", "department_name", "hire_date", "term_date",
)
RAW_TIMESHEET_COLUMNS = (
    "client_employee_id", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
    "hours_worked", "pay_code", "punch_in_comment", "punch_out_comment",
)

RAW_EMPLOYEE = _struct(**{c: _TEXT for c in RAW_EMPLOYEE_COLUMNS}, source_file=_TEXT, loaded_at=NTZ)
RAW_TIMESHEET = _struct(**{c: _TEXT for c in RAW_TIMESHEET_COLUMNS}, source_file=_TEXT, loaded_at=NTZ)

# Files loaded into a raw table, and its lines with more or fewer fields than their header.
RAW_FILES = _struct(source_file=_TEXT, length=_LONG, modified_at=NTZ, loaded_at=NTZ)
REJECTS = _struct(source_file=_TEXT, loaded_at=NTZ, record=_TEXT, n_fields=_INT, n_expected=_INT, rejected=T.BooleanType())

STG_EMPLOYEE = _struct(
    employee_id=_TEXT, first_name=_TEXT, last_name=_TEXT, job_title=_TEXT,
    department_id=_TEXT, department_name=_TEXT, hire_date=_DATE, termination_date=_DATE,
    is_active=_INT, source_file=_TEXT, bronze_loaded_at=NTZ, etl_batch_id=_TEXT, processed_at=NTZ,
)
STG_TIMESHEET = _struct(
    employee_id=_TEXT, work_date=_DATE, punch_in=NTZ, punch_out=NTZ, hours_worked=_DOUBLE,
    pay_code=_TEXT, punch_in_comment=_TEXT, punch_out_comment=_TEXT,
    source_file=_TEXT, bronze_loaded_at=NTZ, etl_batch_id=_TEXT, processed_at=NTZ,
)
WATERMARK = _struct(table_name=_TEXT, last_processed_at=NTZ, updated_at=NTZ)
# One row a staging batch that the star schema holds, with the highest keys given by then.
STAR_STATE = _struct(table_name=_TEXT, batch_key=_TEXT, recategorize=T.BooleanType(), department_keys=_LONG, employee_keys=_LONG)

DIM_DEPARTMENT = _struct(
    department_key=_LONG, department_id=_TEXT, department_name=_TEXT,
    is_active=_INT, start_date=_DATE, end_date=_DATE,
)
DIM_EMPLOYEE = _struct(
    employee_key=_LONG, employee_id=_TEXT, first_name=_TEXT, last_name=_TEXT, job_title=_TEXT,
    department_key=_LONG, hire_date=_DATE, termination_date=_DATE, is_active=_INT,
    start_date=_DATE, end_date=_DATE,
)
DIM_DATE = _struct(
    date_id=_LONG, work_date=_DATE, year=_INT, month=_INT, day=_INT, week=_INT, quarter=_INT,
)
FACT_TIMESHEET = _struct(
    id=_LONG, employee_key=_LONG, department_key=_LONG, work_date=_DATE, punch_in=NTZ, punch_out=NTZ,
    scheduled_start=_TEXT, scheduled_end=_TEXT, hours_worked=_DOUBLE, pay_code=_TEXT,
    punch_in_comment=_TEXT, punch_out_comment=_TEXT,
)
