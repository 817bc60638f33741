"""Quality reports: one row per check, computed in as few passes as possible."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.checks import count_null

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
HOURS_LOW, HOURS_HIGH = 0, 24
FIRST_WORK_DATE = dt.date(2000, 1, 1)


def _count_outside_hours() -> Column:
    return F.count_if((F.col("hours_worked") < HOURS_LOW) | (F.col("hours_worked") > HOURS_HIGH))


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("long"))


def check_row(table: str, check: str, failing: Column, message: Column, severity: str = ERROR) -> Column:
    failing = failing.cast("long")
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), failing.alias("failing"),
        (failing == 0).alias("passed"), message.alias("message"), F.lit(severity).alias("severity"),
    )


def _said(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _ranged(opening: str, least: str, most: str, closing: str, outside: str) -> Column:
    return F.concat_ws("", F.lit(opening), least, F.lit(", "), most, F.lit(closing), outside)


def _at_least_one(table: str, rows: Column) -> Column:
    return check_row(table, "row_count", F.when(rows >= 1, 0).otherwise(1), _said("Row count: ", rows))


def _rows(measures: DataFrame, checks: list[Column]) -> DataFrame:
    return measures.select(F.inline(F.array(*checks)))


def _keyed_table_measures(df: DataFrame, keys: list[str], critical: list[str]) -> DataFrame:
    """Row, NULL and duplicate counts of a table in one pass: counted per key first."""
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), reduce(lambda a, b: a + b, [count_null(c) for c in critical]).alias("nulls")
    )
    return per_key.agg(
        _sum("n").alias("n"), _sum("nulls").alias("nulls"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0).cast("long")).alias("duplicates"),
    )


def _keyed_table_checks(table: str) -> list[Column]:
    return [
        _at_least_one(table, F.col("n")),
        check_row(table, "null_check", F.col("nulls"), _said("Nulls in critical columns: ", F.col("nulls"))),
        check_row(table, "duplicate_check", F.col("duplicates"), _said("Rows with a duplicate key: ", F.col("duplicates"))),
    ]


def _flagged(parent: DataFrame, key: str, flag: str) -> DataFrame:
    return parent.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))


def _orphans(key: str, flag: str) -> Column:
    return F.count_distinct(F.when(F.col(key).isNotNull() & F.col(flag).isNull(), F.col(key)))


def _orphan_check(table: str, key: str, number: Column) -> Column:
    return check_row(table, f"ref_integrity_{key}", number, _said("Orphan keys: ", number))


def gold_suite(dim_employee: DataFrame, dim_department: DataFrame, dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """The 16 checks of the star schema.

    The fact is read once: its measures are combined per pair of keys, and these pairs, not
    the fact rows, meet the dimensions.
    """
    departments = _flagged(dim_department, "department_key", "known_department")
    department = _rows(
        _keyed_table_measures(dim_department, ["department_key"], ["department_id", "department_name"]),
        _keyed_table_checks("dim_department"),
    )
    employee = _rows(
        _keyed_table_measures(dim_employee, ["employee_key"], ["employee_id", "employee_key"]),
        _keyed_table_checks("dim_employee"),
    )
    employee_orphans = _rows(
        dim_employee.groupBy("department_key").agg(F.count(F.lit(1)).alias("n"))
        .join(departments, "department_key", "left")
        .agg(_orphans("department_key", "known_department").alias("orphans")),
        [_orphan_check("dim_employee", "department_key", F.col("orphans"))],
    )
    date = _rows(
        _keyed_table_measures(dim_date, ["date_id", "work_date"], ["work_date", "date_id"]), _keyed_table_checks("dim_date")
    )
    early = F.col("work_date") < F.lit(FIRST_WORK_DATE)
    per_pair = fact.groupBy("employee_key", "department_key").agg(
        F.count(F.lit(1)).alias("n"), (count_null("employee_key") + count_null("work_date")).alias("nulls"),
        _count_outside_hours().alias("hours"), F.min("hours_worked").alias("least"), F.max("hours_worked").alias("most"),
        F.count_if(early).alias("early"), F.min("work_date").alias("first"), F.max("work_date").alias("last"),
    )
    measures = (
        per_pair.join(_flagged(dim_employee, "employee_key", "known_employee"), "employee_key", "left")
        .join(departments, "department_key", "left")
        .agg(
            _sum("n").alias("n"), _sum("nulls").alias("nulls"), _sum("hours").alias("hours"), _sum("early").alias("early"),
            F.min("least").alias("least"), F.max("most").alias("most"), F.min("first").alias("first"), F.max("last").alias("last"),
            _orphans("employee_key", "known_employee").alias("employees"),
            _orphans("department_key", "known_department").alias("departments"),
        )
    )
    name = "fact_timesheet"
    fact_checks = _rows(measures, [
        _at_least_one(name, F.col("n")),
        check_row(name, "null_check", F.col("nulls"), _said("Nulls in critical columns: ", F.col("nulls"))),
        check_row(name, "range_check_hours_worked", F.col("hours"), _ranged("Range [", "least", "most", "], outside: ", "hours")),
        _orphan_check(name, "employee_key", F.col("employees")),
        _orphan_check(name, "department_key", F.col("departments")),
        check_row(name, "date_range_work_date", F.col("early"), _ranged("Dates [", "first", "last", "], too early: ", "early")),
    ])
    return reduce(DataFrame.unionByName, [department, employee, employee_orphans, date, fact_checks])


# Staging validation


def employee_measures(stg_employee: DataFrame) -> DataFrame:
    """Counts behind the staging employee checks; duplicates are ids beyond the first."""
    per_id = stg_employee.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_active").isin(0, 1)).alias("invalid")
    )
    return per_id.agg(
        _sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("employee_id").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("null_ids"),
        _sum("invalid").alias("invalid_active"),
        (_sum("n") - F.count(F.lit(1))).alias("duplicate_ids"),
    )


def timesheet_measures(stg_timesheet: DataFrame) -> DataFrame:
    return stg_timesheet.agg(
        F.count(F.lit(1)).alias("row_count"), count_null("employee_id").alias("null_ids"),
        count_null("work_date").alias("null_dates"), _count_outside_hours().alias("out_of_range"),
    )


def integrity_measures(stg_employee: DataFrame, timesheets: DataFrame) -> DataFrame:
    """Orphan ids and rows, and employees without timesheets, from one join of distinct ids."""
    used = (
        timesheets.where(F.col("employee_id").isNotNull()).groupBy("employee_id").agg(F.count(F.lit(1)).alias("n"))
    )
    known = stg_employee.select("employee_id").where(F.col("employee_id").isNotNull()).distinct()
    both = used.join(known.withColumn("known", F.lit(True)), "employee_id", "full")
    orphan, unused = F.col("known").isNull(), F.col("n").isNull()
    return both.agg(
        F.count_if(orphan).alias("orphan_ids"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0).cast("long")).alias("orphan_records"),
        F.count_if(unused).alias("employees_without_timesheets"),
    )


def _layer(measures: DataFrame, layer: str, checks: list[Column]) -> DataFrame:
    return _rows(measures, checks).withColumn("layer", F.lit(layer))


def silver_report(stg_employee: DataFrame, stg_timesheet: DataFrame) -> DataFrame:
    """The checks of both staging tables, with their severity and layer."""
    def some_rows(table: str) -> Column:
        n = F.col("row_count")
        return check_row(table, "Row Count", F.when(n > 0, 0).otherwise(1), F.concat(n.cast("string"), F.lit(" records")))

    def counted(table: str, check: str, column: str, text: str, severity: str = ERROR) -> Column:
        n = F.col(column)
        return check_row(table, check, n, F.concat(n.cast("string"), F.lit(text)), severity)

    employee = _layer(employee_measures(stg_employee), "Silver - Employee", [
        some_rows("stg_employee"),
        counted("stg_employee", "Null Employee ID", "null_ids", " null values found"),
        counted("stg_employee", "Valid is_active", "invalid_active", " invalid values (expected 0 or 1)", WARNING),
        counted("stg_employee", "Duplicate Employee ID", "duplicate_ids", " duplicates found", WARNING),
    ])
    timesheet = _layer(timesheet_measures(stg_timesheet), "Silver - Timesheet", [
        some_rows("stg_timesheet"),
        counted("stg_timesheet", "Null Employee ID", "null_ids", " null values found"),
        counted("stg_timesheet", "Null Work Date", "null_dates", " null values found"),
        counted("stg_timesheet", "Hours Worked Range (0-24)", "out_of_range", " records out of range", WARNING),
    ])
    orphans, unused = F.col("orphan_ids"), F.col("employees_without_timesheets")
    found = F.concat(orphans.cast("string"), F.lit(" employee IDs ("), F.col("orphan_records").cast("string"), F.lit(" records) not found in employee table"))
    integrity = _layer(integrity_measures(stg_employee, stg_timesheet), "Silver - Referential Integrity", [
        check_row("stg_timesheet", "Orphan Timesheet Records", orphans, found, WARNING),
        check_row("stg_employee", "Employees Without Timesheets", F.lit(0), F.concat(unused.cast("string"), F.lit(" employees have no timesheet records")), INFO),
    ])
    return employee.unionByName(timesheet).unionByName(integrity)


def silver_summary(report: DataFrame) -> DataFrame:
    """Per layer: passed when no ERROR check failed, with error and warning counts."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == ERROR))
    return report.groupBy("layer").agg(
        (errors == 0).alias("passed"), errors.alias("error_count"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warning_count"),
    )


def report_summary(checks: DataFrame) -> DataFrame:
    """Passed when all checks passed, with the counts of both kinds."""
    return checks.agg(
        F.bool_and("passed").alias("passed"), F.count_if("passed").alias("passed_count"),
        F.count_if(~F.col("passed")).alias("failed_count"),
    )


def post_load_counts(**tables: DataFrame) -> DataFrame:
    """Row count per table; a table passes when it has rows."""
    n = F.count(F.lit(1))
    counts = [
        df.agg(n.alias("db_row_count")).select(F.lit(name).alias("table_name"), "db_row_count", (F.col("db_row_count") > 0).alias("passed"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def post_load_report(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """``(table_name, db_row_count, passed, message)`` after a load, one table after the other.

    A table that can't be read fails its check, with the error as its message, and does not stop the others.
    """
    found = []
    for name, read in tables.items():
        try:
            n = read().count()
            found.append((name, n, n > 0, f"Rows in table: {n}"))
        except (PySparkException, Py4JError) as error:
            found.append((name, None, False, f"Table not readable: {str(error).splitlines()[0]}"))
    return spark.createDataFrame(found, "table_name string, db_row_count long, passed boolean, message string")


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row counts side by side in one row."""
    long = post_load_counts(**tables)
    return long.agg(*[
        F.max(F.when(F.col("table_name") == name, F.col("db_row_count"))).alias(name) for name in tables
    ])
