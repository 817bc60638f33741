"""The one-pass reports against the single checks, and the orphan split."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from shiftlens.config import Limits
from shiftlens.operators import checks
from shiftlens.plans import quality, silver


def messy_star(spark):
    rng = random.Random(5)
    day = lambda: rng.choice([None, dt.date(1999, 5, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    department = spark.createDataFrame(
        [(rng.choice([1, 2, 3, None]), rng.choice(["a", None]), rng.choice(["A", None])) for _ in range(8)],
        "department_key long, department_id string, department_name string",
    )
    employee = spark.createDataFrame(
        [(rng.choice([*range(1, 12), None]), rng.choice(["e", None]), rng.choice([1, 2, 9, 10, None])) for _ in range(30)],
        "employee_key long, employee_id string, department_key long",
    )
    date = spark.createDataFrame([(rng.choice([1, 2, None]), day()) for _ in range(12)], "date_id long, work_date date")
    fact = spark.createDataFrame(
        [(rng.choice([*range(1, 20), None]), rng.choice([1, 7, 8, None]), day(), rng.choice([None, -1.0, 8.0, 25.0])) for _ in range(300)],
        "employee_key long, department_key long, work_date date, hours_worked double",
    )
    return employee, department, date, fact


def test_suite_equals_single_checks(spark):
    employee, department, date, fact = star = messy_star(spark)
    got = {(r.table_name, r.check_name): r.failing for r in quality.gold_suite(*star).collect()}

    def nulls(df, columns):
        return sum(checks.null_counts(df, columns).first())

    def duplicates(df, keys):
        return checks.duplicate_count(df, keys).first()[0]

    def orphans(child, parent, key):
        return checks.ref_integrity(child, parent, key, key).first()[0]

    hours = checks.numeric_range(fact, "hours_worked", 0, 24).first()
    assert got == {
        ("dim_department", "row_count"): 0,
        ("dim_department", "null_check"): nulls(department, ["department_id", "department_name"]),
        ("dim_department", "duplicate_check"): duplicates(department, ["department_key"]),
        ("dim_employee", "row_count"): 0,
        ("dim_employee", "null_check"): nulls(employee, ["employee_id", "employee_key"]),
        ("dim_employee", "duplicate_check"): duplicates(employee, ["employee_key"]),
        ("dim_employee", "ref_integrity_department_key"): orphans(employee, department, "department_key"),
        ("dim_date", "row_count"): 0,
        ("dim_date", "null_check"): nulls(date, ["work_date", "date_id"]),
        ("dim_date", "duplicate_check"): duplicates(date, ["date_id", "work_date"]),
        ("fact_timesheet", "row_count"): 0,
        ("fact_timesheet", "null_check"): nulls(fact, ["employee_key", "work_date"]),
        ("fact_timesheet", "range_check_hours_worked"): hours.below_min + hours.above_max,
        ("fact_timesheet", "ref_integrity_employee_key"): orphans(fact, employee, "employee_key"),
        ("fact_timesheet", "ref_integrity_department_key"): orphans(fact, department, "department_key"),
        ("fact_timesheet", "date_range_work_date"): checks.date_range(fact, "work_date", dt.date(2000, 1, 1)).first().before_min,
    }
    assert sum(1 for v in got.values() if v) >= 10  # the data is messy enough to tell


def test_suite_of_empty_tables(spark):
    report = quality.gold_suite(*[df.limit(0) for df in messy_star(spark)])
    failed = [(r.table_name, r.check_name) for r in report.collect() if not r.passed]
    assert sorted(failed) == [(t, "row_count") for t in ("dim_date", "dim_department", "dim_employee", "fact_timesheet")]
    summary = quality.report_summary(report).first()
    assert (summary.passed, summary.passed_count, summary.failed_count) == (False, 12, 4)


def test_orphans_and_known_rows_split_the_input(spark):
    sheets = spark.createDataFrame([("hot", i) for i in range(400)] + [(None, 1), ("x", 2), ("x", 2), ("b", 3)], "employee_id string, v int")
    employees = spark.createDataFrame([("hot",), ("hot",), ("b",), (None,)], "employee_id string")
    for limits in (Limits(), Limits(broadcast_bytes=0, hot_rows=50), Limits(broadcast_bytes=40, hot_rows=50)):
        kept = silver.keep_known(sheets, employees, limits)
        dropped = silver.orphan_rejects(sheets, employees, limits)
        assert kept.groupBy("employee_id").count().orderBy("employee_id").collect() == [("b", 1), ("hot", 400)]
        assert Counter(tuple(r) for r in dropped.collect()) == {(None, 1): 1, ("x", 2): 2}
    assert {r.employee_id: r.n for r in silver.orphan_counts(sheets, employees).collect()} == {None: 1, "x": 2}


def test_post_load_counts(spark):
    tables = quality.post_load_counts(full=spark.range(3), empty=spark.range(3).where(F.col("id") < 0))
    assert {r.table_name: (r.db_row_count, r.passed) for r in tables.collect()} == {"full": (3, True), "empty": (0, False)}
