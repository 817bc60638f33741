"""Registered queries: every operator, run over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import fixtures
from .config import REPORT_SENTINEL, scratch_path
from .functions.dates import clean_date, clean_date_with_sentinel, is_active_flag
from .functions.numbers import clean_numeric
from .functions.text import categorize_columns, clean_string, recategorize_comment
from .operators import checks, merge
from .operators.joins import sized_join
from .plans import date_votes, gold, kpi, lookup, medallion, quality, silver, star
from .schemas import RAW_EMPLOYEE_COLUMNS, RAW_TIMESHEET_COLUMNS, STG_EMPLOYEE as STG_EMPLOYEE_SCHEMA, STG_TIMESHEET
from .sources import paths
from .sources.files import discover, scan_delimited, write_delimited
from .sources.tables import BATCH_KEY, DIM_DEPARTMENT, FACT_TIMESHEET, RAW_EMPLOYEE, RAW_TIMESHEET, STG_EMPLOYEE, STG_TIMESHEET as STAGED_TIMESHEET, Warehouse
from .streaming.incremental import stream_silver, stream_silver_timesheets

AS_OF = dt.date(2025, 1, 1)
LOADED_AT = "2025-01-01 00:00:00"


class Layers:
    """The layers over one folder of test tables, each built from the one before. Every query builds its own."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_employee(self) -> DataFrame:
        return fixtures.raw_employee(self.spark, self.sf_dir)

    @cached_property
    def raw_timesheet(self) -> DataFrame:
        return fixtures.raw_timesheet(self.spark, self.sf_dir)

    @cached_property
    def stg_employee(self) -> DataFrame:
        return silver.clean_employee(self.raw_employee)

    @cached_property
    def clean_timesheet(self) -> DataFrame:
        return silver.clean_timesheet(self.raw_timesheet)

    @cached_property
    def stg_timesheet(self) -> DataFrame:
        return silver.keep_known(self.clean_timesheet, self.stg_employee)

    @cached_property
    def dim_department(self) -> DataFrame:
        return gold.dim_department(self.stg_employee, AS_OF)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return gold.dim_employee(self.stg_employee, self.dim_department, AS_OF)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.stg_timesheet)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_timesheet(self.clean_timesheet, self.dim_employee)

    @property
    def star(self) -> dict[str, DataFrame]:
        return {
            "dim_department": self.dim_department, "dim_employee": self.dim_employee,
            "dim_date": self.dim_date, "fact_timesheet": self.fact,
        }


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


# Raw


def bronze_scan_csv(x: Layers) -> DataFrame:
    """Write the raw timesheets as delimited files and scan them back."""
    folder = scratch_path(x.spark, "csv")
    write_delimited(x.raw_timesheet.select(*RAW_TIMESHEET_COLUMNS), folder)
    files = discover(x.spark, folder, "part-", recursive=True)
    return scan_delimited(x.spark, files, RAW_TIMESHEET_COLUMNS, LOADED_AT).drop("source_file")


def _arrive(rows: DataFrame, folder: str, prefix: str, columns: tuple[str, ...]) -> None:
    write_delimited(rows.select(*columns, "source_file"), folder, prefix=prefix, by=["source_file"])


def _loaded(x: Layers, table: str, prefix: str, rows: DataFrame, columns: tuple[str, ...], arrivals: list[dt.datetime]) -> DataFrame:
    """The raw table after its files arrived and were loaded one time after the other, sources by their fixture names."""
    warehouse, folder = Warehouse(x.spark, scratch_path(x.spark, "raw")), scratch_path(x.spark, f"files-{prefix}")
    for at in arrivals:
        arrived = rows.where(F.col("loaded_at") == F.lit(at).cast("timestamp_ntz"))
        _arrive(arrived, folder, prefix, columns)
        medallion.load_files(warehouse, table, prefix, columns, folder, at, recursive=True)
    raw = warehouse.read(table)
    return raw.withColumn("source_file", F.regexp_extract("source_file", "^source_file=([^/]+)/", 1))


def bronze_load_employee(x: Layers) -> DataFrame:
    days = [dt.datetime(2025, 1, day) for day in (1, 2, 3)]
    return _loaded(x, RAW_EMPLOYEE, "employee", x.raw_employee, RAW_EMPLOYEE_COLUMNS, days)


def bronze_load_timesheet(x: Layers) -> DataFrame:
    hours = [dt.datetime(2025, 1, 1, hour, 0, 0, 500_000) for hour in range(4)]
    return _loaded(x, RAW_TIMESHEET, "timesheet", x.raw_timesheet, RAW_TIMESHEET_COLUMNS, hours)


def bronze_lineage(x: Layers) -> DataFrame:
    return bronze_load_timesheet(x).groupBy("source_file", "loaded_at").agg(_n())


def bronze_new_files(x: Layers) -> DataFrame:
    """Rows by source of the files that a raw table lacks, after a load of the first two sources."""
    warehouse, folder = Warehouse(x.spark, scratch_path(x.spark, "raw")), scratch_path(x.spark, "files")
    first = F.col("source_file").isin("timesheet_0.csv", "timesheet_1.csv")
    _arrive(x.raw_timesheet.where(first), folder, "timesheet", RAW_TIMESHEET_COLUMNS)
    medallion.load_files(warehouse, RAW_TIMESHEET, "timesheet", RAW_TIMESHEET_COLUMNS, folder, dt.datetime(2025, 1, 1), recursive=True)
    _arrive(x.raw_timesheet.where(~first), folder, "timesheet", RAW_TIMESHEET_COLUMNS)
    fresh = medallion.fresh_files(warehouse, RAW_TIMESHEET, "timesheet", folder, recursive=True)
    files = [r.path for r in fresh.select("path").collect()]
    root = paths.qualified(x.spark, folder)
    rows = scan_delimited(x.spark, files, RAW_TIMESHEET_COLUMNS, LOADED_AT, root=root)
    return rows.groupBy(F.regexp_extract("source_file", "^source_file=([^/]+)/", 1).alias("source_file")).agg(_n())


def bronze_rejects(x: Layers) -> DataFrame:
    """Lines by their number of fields, some with one too many and some that end early: rows loaded and rows rejected."""
    folder = scratch_path(x.spark, "odd-files")
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in RAW_TIMESHEET_COLUMNS]
    short, whole = F.concat_ws("|", *quoted[:5]), F.concat_ws("|", *quoted)
    line = F.when(F.col("hours_worked") == "abc", F.concat(whole, F.lit('|"one|more"'))).when(F.col("hours_worked") == "--", short).otherwise(whole)
    header = "|".join(RAW_TIMESHEET_COLUMNS)
    lines = x.raw_timesheet.select(line.alias(header))
    lines.write.option("mapreduce.output.basename", "timesheet").options(header=True, quote="", sep="\x01").csv(folder)
    warehouse = Warehouse(x.spark, scratch_path(x.spark, "raw"))
    medallion.load_files(warehouse, RAW_TIMESHEET, "timesheet", RAW_TIMESHEET_COLUMNS, folder, dt.datetime(2025, 1, 1))
    odd = warehouse.rejects(RAW_TIMESHEET).groupBy("n_fields", "rejected").agg(_n())
    loaded = warehouse.read(RAW_TIMESHEET).groupBy((F.col("hours_worked") == "--").alias("ends_early")).agg(_n())
    full = loaded.where(~F.col("ends_early")).select(F.lit(len(RAW_TIMESHEET_COLUMNS)).alias("n_fields"), F.lit(False).alias("rejected"), "n")
    return odd.unionByName(full)


# Staging


def watermark_state(x: Layers) -> DataFrame:
    marks = silver.next_marks(x.spark, raw_employee=x.raw_employee, raw_timesheet=x.raw_timesheet)
    before = marks.limit(0).withColumn("updated_at", F.col("last_processed_at"))
    return silver.advance_marks(before, marks, LOADED_AT).select("table_name", "last_processed_at")


def incremental_employees(x: Layers) -> DataFrame:
    fresh = silver.rows_after(x.raw_employee, "2025-01-01 00:00:00")
    return silver.clean_employee(fresh).select("employee_id", "bronze_loaded_at")


def incremental_timesheets(x: Layers) -> DataFrame:
    fresh = silver.rows_after(x.raw_timesheet, "2025-01-01 01:00:00.5")
    return silver.clean_timesheet(fresh).select("employee_id", "work_date", "punch_in", "bronze_loaded_at")


def clean_missing_columns(x: Layers) -> DataFrame:
    rows = silver.clean_employee(x.raw_employee.drop("hire_date", "term_date"))
    return rows.select("employee_id", "hire_date", "termination_date", "is_active")


def query_clean_string(x: Layers) -> DataFrame:
    return x.raw_employee.select(
        clean_string(F.col("client_employee_id"), "UNKNOWN").alias("employee_id"),
        clean_string(F.col("first_name"), "").alias("first_name"),
        clean_string(F.col("last_name"), "").alias("last_name"),
        clean_string(F.col("job_title"), "Unknown").alias("job_title"),
    )


def query_clean_numeric(x: Layers) -> DataFrame:
    return x.raw_timesheet.select(
        clean_string(F.col("client_employee_id"), "UNKNOWN").alias("employee_id"),
        clean_date(F.col("punch_apply_date")).alias("work_date"),
        clean_numeric(F.col("hours_worked")).alias("hours_worked"),
    )


def _employee_with(x: Layers, name: str, value) -> DataFrame:
    return x.raw_employee.select(clean_string(F.col("client_employee_id"), "UNKNOWN").alias("employee_id"), value.alias(name))


def _in_other_formats(x: Layers) -> DataFrame:
    """The raw employees with the dates of their first two files in formats of their own."""
    form = F.when(F.col("source_file") == "employee_0.csv", "MM/dd/yyyy").when(F.col("source_file") == "employee_1.csv", "yyyyMMdd")

    def written(name: str) -> Column:
        date = clean_date(F.col(name))
        ways = [F.when(form == f, F.date_format(date, f)) for f in ("MM/dd/yyyy", "yyyyMMdd")]
        return F.coalesce(*ways, F.col(name))

    return x.raw_employee.withColumns({c: written(c) for c in ("hire_date", "term_date")})


def clean_date_formats(x: Layers) -> DataFrame:
    """Employees of files in different date formats, each found by a vote of its texts."""
    raw = _in_other_formats(x)
    voted = date_votes.iso_dates(raw, date_votes.tally(raw, ("hire_date", "term_date")))
    return silver.clean_employee(voted).select("employee_id", "hire_date", "termination_date", "is_active", "source_file")


def date_format_votes(x: Layers) -> DataFrame:
    return date_votes.votes(date_votes.tally(_in_other_formats(x), ("hire_date", "term_date")))


def query_is_active(x: Layers) -> DataFrame:
    return x.raw_employee.groupBy(is_active_flag(F.col("term_date")).alias("is_active")).agg(_n())


def query_categorize(x: Layers) -> DataFrame:
    return x.clean_timesheet.groupBy("punch_in_comment", "punch_out_comment").agg(_n())


def query_categorize_pipe(x: Layers) -> DataFrame:
    listed = x.raw_timesheet.where(F.contains("punch_in_comment", F.lit("|")))
    counts = listed.groupBy(F.col("punch_in_comment").alias("raw")).agg(_n())
    return categorize_columns(counts.withColumn("category", F.col("raw")), ["category"])


def query_recategorize(x: Layers) -> DataFrame:
    again = {c: recategorize_comment(F.col(c)) for c in ("punch_in_comment", "punch_out_comment")}
    counts = x.stg_timesheet.groupBy(*again).agg(_n()).withColumns(again)
    return counts.groupBy(*again).agg(F.sum("n").alias("n"))


def stream_incremental_silver(x: Layers) -> DataFrame:
    """The staged timesheets, loaded by a file stream."""
    events = fixtures.table(x.spark, x.sf_dir, "events")
    files = fixtures.path(x.sf_dir, "events") + "*"  # as a pattern, the path may be a file or a folder
    stream = x.spark.readStream.schema(events.schema).parquet(files)
    target = scratch_path(x.spark, "stream-silver")
    stream_silver_timesheets(
        fixtures.timesheets_from_events(stream), x.stg_employee, target, scratch_path(x.spark, "stream-state"), LOADED_AT
    )
    staged = x.spark.read.schema(STG_TIMESHEET).parquet(target)
    return staged.drop("etl_batch_id", "processed_at", BATCH_KEY)


def stream_incremental_employee(x: Layers) -> DataFrame:
    """Employees and timesheets by file streams on one trigger: the staged employees, and how many timesheets found theirs."""
    customer, events = (fixtures.table(x.spark, x.sf_dir, name) for name in ("customer", "events"))

    def stream(name: str, like: DataFrame) -> DataFrame:
        return x.spark.readStream.schema(like.schema).parquet(fixtures.path(x.sf_dir, name) + "*")

    employees = fixtures.employees_from_customers(stream("customer", customer), fixtures.table(x.spark, x.sf_dir, "nation"))
    timesheets = fixtures.timesheets_from_events(stream("events", events))
    staged = scratch_path(x.spark, "stream-employee"), scratch_path(x.spark, "stream-timesheet")
    stream_silver(employees, timesheets, *staged, scratch_path(x.spark, "stream-state"), LOADED_AT)
    kept = x.spark.read.schema(STG_TIMESHEET).parquet(staged[1]).groupBy("employee_id").agg(F.count(F.lit(1)).alias("n_timesheets"))
    rows = x.spark.read.schema(STG_EMPLOYEE_SCHEMA).parquet(staged[0]).drop("etl_batch_id", "processed_at", BATCH_KEY)
    return sized_join(rows, kept, "employee_id", "left").na.fill(0, ["n_timesheets"])


# Star schema


def date_parts(x: Layers) -> DataFrame:
    return gold.calendar_of(x.stg_timesheet)


def _old_and_new_dates(x: Layers) -> tuple[DataFrame, DataFrame]:
    dates = x.dim_date.select("work_date", "day", "quarter")
    existing = dates.where("day <= 20").withColumn("quarter", F.lit(0))
    return existing.drop("day"), dates.where("day >= 10").drop("day")


def upsert_by_key(x: Layers) -> DataFrame:
    return merge.upsert_by_key(*_old_and_new_dates(x), ["work_date"])


def insert_if_absent(x: Layers) -> DataFrame:
    return merge.insert_if_absent(*_old_and_new_dates(x), ["work_date"])


def refresh_fact(x: Layers) -> DataFrame:
    """Rebuild the stored fact from stored staging tables."""
    warehouse = Warehouse(x.spark, scratch_path(x.spark, "refresh-fact"))
    for name, rows in ((STG_EMPLOYEE, x.stg_employee), (STAGED_TIMESHEET, x.stg_timesheet)):
        key = silver.batch_key(silver.BEGINNING)
        warehouse.add(name, silver.stamp(rows, silver.batch_id(name, silver.BEGINNING), LOADED_AT), key)
    result = medallion.refresh_fact(warehouse, AS_OF)
    return x.spark.range(1).select(F.lit(result["records"]).cast("long").alias("records"))


def medallion_run(x: Layers) -> DataFrame:
    """Delimited files to the stored star schema, run twice: the second run finds nothing new."""
    folder = scratch_path(x.spark, "medallion")
    write_delimited(x.raw_employee.select(*RAW_EMPLOYEE_COLUMNS), folder, prefix="employee")
    write_delimited(x.raw_timesheet.select(*RAW_TIMESHEET_COLUMNS), folder, prefix="timesheet")
    warehouse = Warehouse(x.spark, scratch_path(x.spark, "warehouse"))
    for hour in (1, 2):
        results = medallion.run_medallion(warehouse, folder, dt.datetime(2025, 1, 1, hour), AS_OF)
    return results["post_load_validation"].drop("message")


def gate_stops(x: Layers) -> DataFrame:
    """A run over timesheets of which some have no date: staging fails its check, the run stops, and no star schema is built."""
    folder = scratch_path(x.spark, "gate")
    undated = x.raw_timesheet.withColumn("punch_apply_date", F.when(F.col("hours_worked") == "abc", "never").otherwise(F.col("punch_apply_date")))
    write_delimited(x.raw_employee.select(*RAW_EMPLOYEE_COLUMNS), folder, prefix="employee")
    write_delimited(undated.select(*RAW_TIMESHEET_COLUMNS), folder, prefix="timesheet")
    warehouse, stopped = Warehouse(x.spark, scratch_path(x.spark, "gated")), False
    try:
        medallion.run_medallion(warehouse, folder, dt.datetime(2025, 1, 1), AS_OF, skip_on_validation_fail=True)
    except medallion.ValidationFailed:
        stopped = True
    report = quality.silver_report(warehouse.read(STG_EMPLOYEE), warehouse.read(STAGED_TIMESHEET))
    facts = medallion.star_tables(warehouse)["fact_timesheet"].count()
    failed = report.where(~F.col("passed") & (F.col("severity") == quality.ERROR)).select("layer", "check_name", "message")
    return failed.withColumns({"stopped": F.lit(stopped), "fact_rows": F.lit(facts).cast("long")})


def post_load_unreadable(x: Layers) -> DataFrame:
    """The check after a load over a star schema of which one table holds no parquet: its row fails (-1 for no count), the others are counted."""
    warehouse = Warehouse(x.spark, scratch_path(x.spark, "unreadable"))
    for name, table in star.STAR.items():
        if table == DIM_DEPARTMENT:
            x.dim_department.select("department_name").write.text(f"{warehouse.path(table)}/version=00000001")
        else:
            warehouse.replace(table, x.star[name])
    return medallion.post_load(warehouse).drop("message").na.fill(-1, ["db_row_count"])


def kpi_avg_hours_exact(x: Layers) -> DataFrame:
    """KPI 4 over hours next to a half, below zero and beyond every decimal type."""
    day = F.day("work_date") % 5
    odd = (
        F.when((F.col("employee_key") % 97 == 0) & (F.col("pay_code") == "purchase"), F.lit(1e30))
        .when(day == 0, 0.49999999999).when(day == 1, -0.25).when(day == 2, 0.7).when(day == 3, 0.3).otherwise(F.col("hours_worked"))
    )
    means = kpi.avg_hours(x.fact.withColumn("hours_worked", odd), x.dim_employee)
    return means.withColumn("avg_daily_hours", F.format_string("%.9e", "avg_daily_hours"))


def star_incremental(x: Layers) -> DataFrame:
    """Files that arrive in three rounds, each brought into the star schema, and a run without new files: the fact by employee and month."""
    folder, warehouse = scratch_path(x.spark, "arrivals"), Warehouse(x.spark, scratch_path(x.spark, "star"))
    for day in range(4):
        at = dt.datetime(2025, 1, 1 + day)
        sources = {0: [0], 1: [1], 2: [2, 3], 3: []}[day]
        if sources:
            write_delimited(x.raw_employee.where(F.col("loaded_at") == F.lit(at).cast("timestamp_ntz")).select(*RAW_EMPLOYEE_COLUMNS), folder, prefix="employee")
            arrived = x.raw_timesheet.where(F.col("source_file").isin([f"timesheet_{n}.csv" for n in sources]))
            write_delimited(arrived.select(*RAW_TIMESHEET_COLUMNS), folder, prefix="timesheet")
        medallion.run_medallion(warehouse, folder, at, AS_OF)
    stored = medallion.star_tables(warehouse)
    named = sized_join(stored["fact_timesheet"], stored["dim_employee"].select("employee_key", "employee_id"), "employee_key")
    return named.groupBy("employee_id", F.date_format("work_date", "yyyy-MM").alias("month")).agg(_n(), F.sum("hours_worked").alias("hours"))


# Lookups and changes


def list_employees(x: Layers) -> tuple[DataFrame, DataFrame]:
    return lookup.list_employees(x.dim_employee, is_active=1, department_key=3)


def list_timesheets(x: Layers) -> tuple[DataFrame, DataFrame]:
    rows, total = lookup.list_timesheets(
        x.fact, number=2, date_from=dt.date(2024, 1, 5), date_to=dt.date(2024, 1, 20), pay_code="click"
    )
    return rows.select("employee_key", "work_date", "punch_in", "hours_worked", "pay_code"), total


def list_timesheets_deep(x: Layers) -> DataFrame:
    """A page far into the whole fact, found by counts."""
    rows, _ = lookup.list_timesheets(x.fact, number=130)
    return rows.select("employee_key", "work_date", "punch_in", "hours_worked", "pay_code")


def _stored_fact(x: Layers) -> DataFrame:
    warehouse = Warehouse(x.spark, scratch_path(x.spark, "fact"))
    warehouse.replace(FACT_TIMESHEET, x.fact)
    return warehouse.read(FACT_TIMESHEET, with_helpers=True)


def list_timesheets_stored(x: Layers) -> DataFrame:
    """A page of the stored fact, of whose folders only the months of the filter are read."""
    rows, _ = lookup.list_timesheets(_stored_fact(x).drop("id"), number=3, date_from=dt.date(2024, 1, 10), date_to=dt.date(2024, 2, 9))
    return rows.select("employee_key", "work_date", "punch_in", "hours_worked", "pay_code")


def get_timesheet(x: Layers) -> DataFrame:
    """A stored timesheet by its id, here the first one of a listing, with its employee."""
    fact = _stored_fact(x)
    first = lookup.list_timesheets(fact, size=1, pay_code="click")[0].first()
    row = lookup.get_timesheet(fact, x.dim_employee, first.id if first else -1)
    return row.select("employee_key", "work_date", "punch_in", "hours_worked", "pay_code", "employee.employee_id", "employee.first_name")


def employee_timesheets(x: Layers) -> DataFrame:
    rows = lookup.timesheets_of_id(x.fact, x.dim_employee, "5")
    return rows.select("employee_key", "work_date", "punch_in", "hours_worked")


def employee_timesheets_by_key(x: Layers) -> DataFrame:
    """The page of an employee whose key was looked up before."""
    key = x.dim_employee.where(F.col("employee_id") == "5").agg(F.min("employee_key")).first()[0]
    rows, _ = lookup.employee_timesheets(x.fact, x.dim_employee, key)
    return rows.select("employee_key", "work_date", "punch_in", "hours_worked")


def timesheet_with_employee(x: Layers) -> DataFrame:
    return lookup.with_employee(x.fact, x.dim_employee).select(
        "employee_key", "work_date", "punch_in", "punch_out", "hours_worked",
        "employee.employee_id", "employee.first_name", "employee.job_title",
    )


def insert_employees(x: Layers) -> DataFrame:
    new = x.spark.createDataFrame([("new1", AS_OF), ("new2", AS_OF)], "employee_id string, start_date date")
    return merge.insert_employees(x.dim_employee, new).select("employee_key", "employee_id")


def update_employees(x: Layers) -> DataFrame:
    key = F.col("employee_key")
    changes = x.dim_employee.where(key <= 20).select(
        "employee_key",
        F.lit("Lead").alias("job_title"), (key <= 10).alias("set_job_title"),
        F.lit(None).cast("date").alias("termination_date"), (key > 10).alias("set_termination_date"),
    )
    return merge.update_employees(x.dim_employee, changes).select("employee_key", "job_title", "termination_date")


def delete_employees(x: Layers) -> DataFrame:
    leaving = x.dim_employee.where(F.col("employee_key") <= 10)
    return merge.delete_by_key(x.dim_employee, leaving, "employee_key").select("employee_key", "employee_id")


# Quality


def gold_suite(x: Layers) -> DataFrame:
    return quality.gold_suite(x.dim_employee, x.dim_department, x.dim_date, x.fact)


def _measured(x: Layers) -> DataFrame:
    return gold_suite(x).select("table_name", "check_name", "failing", "passed")


def silver_report(x: Layers) -> DataFrame:
    """The staging report, on timesheets before the orphan filter so that orphans show."""
    return quality.silver_report(x.stg_employee, x.clean_timesheet)


QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    "bronze_scan_csv": bronze_scan_csv,
    "bronze_lineage": bronze_lineage,
    "bronze_load_employee": bronze_load_employee,
    "bronze_load_timesheet": bronze_load_timesheet,
    "bronze_new_files": bronze_new_files,
    "bronze_rejects": bronze_rejects,
    "watermark_state": watermark_state,
    "incremental_employees": incremental_employees,
    "incremental_timesheets": incremental_timesheets,
    "stream_incremental_silver": stream_incremental_silver,
    "stream_incremental_employee": stream_incremental_employee,
    "clean_string": query_clean_string,
    "clean_numeric": query_clean_numeric,
    "clean_date": lambda x: _employee_with(x, "hire_date", clean_date(F.col("hire_date"))),
    "clean_date_sentinel": lambda x: _employee_with(x, "termination_date", clean_date_with_sentinel(F.col("term_date"))),
    "clean_date_formats": clean_date_formats,
    "date_format_votes": date_format_votes,
    "is_active_flag": query_is_active,
    "categorize_comment": query_categorize,
    "categorize_comment_pipe": query_categorize_pipe,
    "recategorize_comment": query_recategorize,
    "clean_employee": lambda x: x.stg_employee,
    "clean_timesheet": lambda x: x.clean_timesheet,
    "clean_missing_columns": clean_missing_columns,
    "silver_employee": lambda x: x.stg_employee,
    "silver_timesheet": lambda x: x.stg_timesheet,
    "orphan_filter": lambda x: x.stg_timesheet.select("employee_id", "work_date", "hours_worked"),
    "orphan_rejects": lambda x: silver.orphan_counts(x.clean_timesheet, x.stg_employee),
    "date_parts": date_parts,
    "dim_department": lambda x: x.dim_department,
    "dim_employee": lambda x: x.dim_employee,
    "dim_date": lambda x: x.dim_date,
    "fact_timesheet": lambda x: x.fact,
    "surrogate_keys": lambda x: x.dim_employee.select("employee_id", "employee_key"),
    "upsert_by_key": upsert_by_key,
    "insert_if_absent": insert_if_absent,
    "refresh_fact": refresh_fact,
    "medallion_run": medallion_run,
    "gate_stops": gate_stops,
    "star_incremental": star_incremental,
    "gold_counts": lambda x: quality.table_counts(**x.star),
    "post_load_counts": lambda x: quality.post_load_counts(**x.star),
    "post_load_unreadable": post_load_unreadable,
    "kpi_active_headcount": lambda x: kpi.active_headcount(x.dim_employee, x.dim_date),
    "kpi_turnover_trend": lambda x: kpi.turnover_trend(x.dim_employee),
    "kpi_avg_tenure": lambda x: kpi.avg_tenure(x.dim_employee, x.dim_department),
    "kpi_avg_hours": lambda x: kpi.avg_hours(x.fact, x.dim_employee),
    "kpi_avg_hours_exact": kpi_avg_hours_exact,
    "kpi_late_arrivals": lambda x: kpi.late_arrivals(x.fact, x.dim_employee),
    "kpi_early_departures": lambda x: kpi.early_departures(x.fact, x.dim_employee),
    "kpi_overtime": lambda x: kpi.overtime(x.fact),
    "kpi_rolling_avg_hours": lambda x: kpi.rolling_avg_hours(x.fact, x.dim_employee),
    "kpi_early_attrition": lambda x: kpi.early_attrition(x.dim_employee),
    "kpi_active_headcount_all": lambda x: kpi.active_headcount(x.dim_employee, x.dim_date, active_only=False),
    "kpi_active_headcount_2262": lambda x: kpi.active_headcount(x.dim_employee, x.dim_date, REPORT_SENTINEL),
    "kpi_turnover_trend_2262": lambda x: kpi.turnover_trend(x.dim_employee, REPORT_SENTINEL),
    "kpi_avg_tenure_2262": lambda x: kpi.avg_tenure(x.dim_employee, x.dim_department, REPORT_SENTINEL),
    "kpi_early_attrition_2262": lambda x: kpi.early_attrition(x.dim_employee, REPORT_SENTINEL),
    "list_employees": lambda x: list_employees(x)[0],
    "list_employees_total": lambda x: list_employees(x)[1],
    "search_employees": lambda x: lookup.search_employees(x.dim_employee, "MER#00000001").select("employee_key", "employee_id", "first_name"),
    "get_employee": lambda x: lookup.get_employee(x.dim_employee, 5),
    "list_timesheets": lambda x: list_timesheets(x)[0],
    "list_timesheets_total": lambda x: list_timesheets(x)[1],
    "list_timesheets_deep": list_timesheets_deep,
    "list_timesheets_stored": list_timesheets_stored,
    "get_timesheet": get_timesheet,
    "employee_timesheets": employee_timesheets,
    "employee_timesheets_by_key": employee_timesheets_by_key,
    "timesheet_with_employee": timesheet_with_employee,
    "insert_employees": insert_employees,
    "update_employees": update_employees,
    "delete_employees": delete_employees,
    "qc_row_count": lambda x: checks.row_count(x.dim_employee, "dim_employee"),
    "qc_nulls": lambda x: checks.null_counts(x.stg_timesheet, ["punch_in", "punch_out"]),
    "qc_duplicates": lambda x: checks.duplicate_count(x.stg_timesheet, ["employee_id", "work_date"]),
    "qc_numeric_range": lambda x: checks.numeric_range(x.stg_timesheet, "hours_worked", 0, 24),
    "qc_ref_integrity": lambda x: checks.ref_integrity(x.clean_timesheet, x.stg_employee, "employee_id", "employee_id"),
    "qc_date_range": lambda x: checks.date_range(x.stg_employee, "hire_date", dt.date(2020, 1, 1), dt.date(2023, 12, 31)),
    "qc_gold_suite": _measured,
    "qc_report_summary": lambda x: quality.report_summary(gold_suite(x)),
    "validate_employee": lambda x: quality.employee_measures(x.stg_employee),
    "validate_timesheet": lambda x: quality.timesheet_measures(x.stg_timesheet),
    "validate_integrity": lambda x: quality.integrity_measures(x.stg_employee, x.clean_timesheet),
    "silver_report": lambda x: silver_report(x).select("layer", "check_name", "passed", "message", "severity"),
    "silver_report_summary": lambda x: quality.silver_summary(silver_report(x)),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Layers(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
