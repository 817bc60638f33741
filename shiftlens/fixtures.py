"""Raw employee and timesheet rows, dirty on purpose, derived from the test tables.

Employees are customers, departments are nations, a timesheet row is one event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RAW_EMPLOYEE = {
    "client_employee_id": """CASE c_custkey % 3 WHEN 0 THEN '"' || CAST(c_custkey AS STRING) || '"'
        WHEN 1 THEN '  ' || CAST(c_custkey AS STRING) || ' ' ELSE CAST(c_custkey AS STRING) END""",
    "first_name": "CASE c_custkey % 11 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' ELSE c_name END",
    "last_name": "CASE c_custkey % 13 WHEN 0 THEN '' ELSE 'Nurse' END",
    "job_title": "CASE c_custkey % 7 WHEN 0 THEN '[NULL]' WHEN 1 THEN 'Null' ELSE c_mktsegment END",
    "department_id": "CAST(c_nationkey AS STRING)",
    "department_name": "CAST(c_nationkey AS STRING) || '-' || n_name",
    "hire_date": """CASE WHEN c_custkey % 29 = 0 THEN 'not-a-date'
        WHEN c_custkey % 4 = 0 THEN '"' || CAST(date_add(DATE '2019-01-01', CAST(c_custkey * 17 % 1860 AS INT)) AS STRING) || '"'
        ELSE CAST(date_add(DATE '2019-01-01', CAST(c_custkey * 17 % 1860 AS INT)) AS STRING) END""",
    "term_date": """CASE WHEN c_custkey % 4 = 1
        THEN CAST(date_add(DATE '2019-01-01', CAST(c_custkey * 17 % 1860 + c_custkey * 37 % 1500 AS INT)) AS STRING)
        WHEN c_custkey % 4 = 2 THEN '[NULL]' WHEN c_custkey % 4 = 3 THEN ' ' END""",
    "source_file": "'employee_' || CAST(c_custkey % 3 AS STRING) || '.csv'",
    "loaded_at": "TIMESTAMP_NTZ '2025-01-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 3)",
}

_RAW_TIMESHEET = {
    "client_employee_id": "CASE WHEN event_id % 101 = 0 THEN '[NULL]' ELSE CAST(user_id AS STRING) END",
    "punch_apply_date": "CAST(CAST(ts AS DATE) AS STRING)",
    "punch_in_datetime": "CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(ts AS STRING) END",
    "punch_out_datetime": """CASE WHEN event_id % 37 = 0 THEN '[NULL]'
        ELSE '"' || CAST(ts + INTERVAL '1' MINUTE * (event_id * 61 % 720) AS STRING) || '"' END""",
    "hours_worked": """CASE WHEN event_id % 41 = 0 THEN 'abc' WHEN event_id % 43 = 0 THEN '--' WHEN event_id % 47 = 0 THEN '-1.5'
        ELSE CAST(event_id * 7 % 26 AS STRING) || '.' || CAST(event_id * 3 % 4 * 25 AS STRING) END""",
    "pay_code": "CASE WHEN event_id % 53 = 0 THEN 'undefined' ELSE event_type END",
    # Lists instead of CASE: a short constant lookup by remainder.
    "punch_in_comment": """element_at(array('EARLY_OUT', 'late in', 'VERY_LATE_IN', '"FORGOT PUNCH"',
        'Employee Missed In Punch', 'MEAL_NOT_TAKEN', 'meal skipped', 'LATE_IN|MISSED_PUNCH', 'MISSED|FOO', 'MEAL|X',
        'hello', '[null]', 'undefined', 'SHORT_SHIFT', 'Cancelled Deduction', NULL), CAST(event_id % 16 + 1 AS INT))""",
    "punch_out_comment": """element_at(array('VACATION', 'LEFT EARLY', 'stayed longer', 'EXTRA_SHIFT', NULL),
        CAST(event_id % 5 + 1 AS INT))""",
    "source_file": """element_at(array('timesheet_0.csv', 'timesheet_1.csv', 'timesheet_2.csv', 'timesheet_3.csv'),
        CAST(event_id % 4 + 1 AS INT))""",
    "loaded_at": """element_at(array(TIMESTAMP_NTZ '2025-01-01 00:00:00.500', TIMESTAMP_NTZ '2025-01-01 01:00:00.500',
        TIMESTAMP_NTZ '2025-01-01 02:00:00.500', TIMESTAMP_NTZ '2025-01-01 03:00:00.500'), CAST(event_id % 4 + 1 AS INT))""",
}


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{e} AS {name}" for name, e in expressions.items()]


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def raw_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees_from_customers(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


def employees_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).where("c_custkey % 7 <> 3")
    return rows.selectExpr(*_columns(_RAW_EMPLOYEE))


def timesheets_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_columns(_RAW_TIMESHEET))


def raw_timesheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timesheets_from_events(table(spark, sf_dir, "events"))
