"""Files to star schema, in several loads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shiftlens.plans import gold, lookup, medallion, quality, silver
from shiftlens.sources import tables as t
from shiftlens.sources.files import discover, headers_of, scan_delimited
from shiftlens.sources.tables import Warehouse
from shiftlens.streaming.incremental import batch_writer, file_stream, run_available, stream_silver_timesheets

AS_OF = dt.date(2025, 1, 1)

EMPLOYEES = """"client_employee_id"|"first_name"|"middle_name"|"last_name"|"job_title"|"department_id"|"department_name"|"hire_date"|"term_date"
"00037"|Ann|x|"O'Hara"|Manager, CT|"72800"|"72800-CT|Scan"|"1998-06-01"|
"2"|N/A||Nurse|[NULL]|"9"|"9-Lab"|"2020-02-30"|"2024-05-06"
"3"|Bo||Nurse|Clerk|||"2021-01-01"|" "
"""
MORE_EMPLOYEES = """"term_date"|" last_name "|"client_employee_id"
""|"Late"|"1"
"""
TIMESHEETS = """client_employee_id|punch_apply_date|punch_in_datetime|punch_out_datetime|hours_worked|pay_code|punch_in_comment|punch_out_comment
"00037"|"2024-10-28"|"2024-10-28 09:10:00"|"2024-10-28 17:30:00"|"8.25"|REG|"LATE_IN|MISSED_PUNCH"|hello
2|2024-10-29|2024-10-29 08:00:00||abc|REG||VACATION
1|2024-10-29||||REG|--|
"""
MORE_TIMESHEETS = TIMESHEETS.splitlines()[0] + """
3|2024-10-30|2024-10-30 09:00:00|2024-10-30 16:00:00|30|REG||
"""


@pytest.fixture
def place(tmp_path):
    source = tmp_path / "files"
    source.mkdir()

    def put(name, text):
        (source / name).parent.mkdir(exist_ok=True, parents=True)
        (source / name).write_text(text, encoding="utf-8")

    put("employee_1.csv", EMPLOYEES)
    put("timesheet 1+a%20.csv", TIMESHEETS)
    put("other.csv", "a|b\n1|2\n")
    return str(source), put


def hour(n):
    return dt.datetime(2025, 1, 1, n, 0, 0, 250000)


def test_scan_keeps_text_and_reads_each_layout(spark, place):
    source, put = place
    put("employee_2.csv", MORE_EMPLOYEES)
    files = discover(spark, source, "employee")
    assert [os.path.basename(f) for f in files] == ["employee_1.csv", "employee_2.csv"]
    assert headers_of(spark, files)[files[1].removeprefix("file:")] == ("term_date", "last_name", "client_employee_id")
    rows = {
        r.client_employee_id: r
        for r in scan_delimited(spark, files, ("client_employee_id", "last_name", "department_name", "term_date"), hour(1)).collect()
    }
    assert rows["00037"].department_name == "72800-CT|Scan" and rows["00037"].last_name == "O'Hara"
    assert rows["3"].term_date == " " and rows["1"].term_date is None
    assert rows["1"].last_name == "Late" and rows["1"].department_name is None
    assert rows["1"].source_file == "employee_2.csv" and rows["1"].loaded_at == hour(1)
    put("employee_3.csv", "")
    put("employee_4.csv", "\ufeff" + MORE_EMPLOYEES.replace('"1"', '"4"'))
    more = scan_delimited(spark, discover(spark, source, "employee"), ("client_employee_id", "term_date"), hour(1))
    assert {(r.client_employee_id, r.term_date) for r in more.collect()} == {("00037", None), ("2", "2024-05-06"), ("3", " "), ("1", None), ("4", None)}
    put("deeper/employee_9.csv", MORE_EMPLOYEES)
    assert len(discover(spark, source, "employee")) == 4
    assert len(discover(spark, source, "employee", recursive=True)) == 5


def test_line_breaks_inside_quotes(spark, place):
    source, put = place
    put("employee_8.csv", 'client_employee_id|last_name\n"7"|"two\nlines"\n')
    files = discover(spark, source, "employee_8")
    rows = scan_delimited(spark, files, ("client_employee_id", "last_name"), hour(1), multi_line=True).collect()
    assert [(r.client_employee_id, r.last_name) for r in rows] == [("7", "two\nlines")]


def test_loads_are_incremental_and_repeatable(spark, place, tmp_path):
    source, put = place
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    first = medallion.run_medallion(warehouse, source, hour(1), AS_OF)
    assert first["bronze"] == {"employees": 3, "timesheets": 3}
    assert (first["silver"]["employees"], first["silver"]["timesheets"], first["silver"]["orphans"]) == (3, 2, 1)
    assert first["valid"] and first["gold"] == {
        "status": "success", "dim_department": 3, "dim_employee": 3, "dim_date": 2, "fact_timesheet": 2
    }
    assert {r.source_file for r in warehouse.loaded_files(t.RAW_TIMESHEET).collect()} == {"timesheet 1+a%20.csv"}
    assert {r.source_file for r in warehouse.read(t.RAW_TIMESHEET).collect()} == {"timesheet 1+a%20.csv"}
    assert all(r.passed for r in first["post_load_validation"].collect())

    keys = {r.employee_id: r.employee_key for r in warehouse.read(t.DIM_EMPLOYEE).collect()}
    fact = {r.employee_key: r for r in warehouse.read(t.FACT_TIMESHEET).collect()}
    ann = fact[keys["00037"]]
    assert (ann.punch_in_comment, ann.punch_out_comment, ann.hours_worked) == ("LATE IN", "UNSCHEDULED", 8.25)
    assert ann.scheduled_start == "09:00:00" and ann.work_date == dt.date(2024, 10, 28)
    two = fact[keys["2"]]
    assert (two.hours_worked, two.punch_out, two.punch_in_comment, two.punch_out_comment) == (0.0, None, "NA", "PTO")

    again = medallion.run_medallion(warehouse, source, hour(2), AS_OF)
    assert again["bronze"] == {"employees": 0, "timesheets": 0}
    assert (again["silver"]["employees"], again["silver"]["timesheets"]) == (0, 0)
    assert again["gold"] == first["gold"]

    put("employee_2.csv", MORE_EMPLOYEES)
    put("timesheet_2.csv", MORE_TIMESHEETS)
    third = medallion.run_medallion(warehouse, source, hour(3), AS_OF)
    assert third["bronze"] == {"employees": 1, "timesheets": 1}
    # The orphan of the first load stays dropped; only the new file is read.
    assert (third["silver"]["employees"], third["silver"]["timesheets"], third["silver"]["orphans"]) == (1, 1, 0)
    assert third["gold"]["dim_employee"] == 4 and third["gold"]["fact_timesheet"] == 3
    later = {r.employee_id: r.employee_key for r in warehouse.read(t.DIM_EMPLOYEE).collect()}
    assert {k: later[k] for k in keys} == keys  # keys by arrival do not move
    assert sorted(r.date_id for r in warehouse.read(t.DIM_DATE).collect()) == [1, 2, 3]
    marks = {r.table_name: r.last_processed_at for r in warehouse.read(t.WATERMARK).collect()}
    assert marks == {"raw_employee": hour(3), "raw_timesheet": hour(3)}

    assert medallion.refresh_fact(warehouse, AS_OF) == {"status": "success", "records": 3}
    medallion.load_gold(warehouse, AS_OF, fact_mode="append")
    fact = warehouse.read(t.FACT_TIMESHEET)
    assert fact.count() == 6 and fact.select("id").distinct().count() == 6


def test_a_repeated_silver_batch_replaces_itself(spark, place, tmp_path):
    source, _ = place
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    medallion.load_bronze(warehouse, source, hour(1))
    rows = silver.stamp(silver.clean_employee(warehouse.read(t.RAW_EMPLOYEE)), silver.batch_id("raw_employee", silver.BEGINNING), hour(1))
    warehouse.add(t.STG_EMPLOYEE, rows, silver.batch_key(silver.BEGINNING))  # a run that stopped before it moved its mark
    medallion.transform_silver(warehouse, hour(2))
    assert warehouse.read(t.STG_EMPLOYEE).count() == 3
    assert medallion.transform_silver(warehouse, hour(3))["employees"] == 0


def test_gate_and_empty_staging(spark, place, tmp_path):
    source, put = place
    empty = Warehouse(spark, str(tmp_path / "empty"))
    assert medallion.load_gold(empty, AS_OF) == {"status": "skipped", "reason": "no staging data"}
    assert medallion.refresh_fact(empty, AS_OF)["status"] == "skipped"
    assert not any(r.passed for r in quality.post_load_counts(**medallion.star_tables(empty)).collect())
    put("timesheet_3.csv", TIMESHEETS.replace("2024-10-28", "soon"))
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    with pytest.raises(medallion.ValidationFailed):
        medallion.run_medallion(warehouse, source, hour(1), AS_OF, skip_on_validation_fail=True)
    assert warehouse.read(t.FACT_TIMESHEET).isEmpty()
    assert not medallion.run_medallion(warehouse, source, hour(2), AS_OF)["gold"]["status"] == "skipped"


def test_lookups_on_stored_tables(spark, place, tmp_path):
    source, _ = place
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    medallion.run_medallion(warehouse, source, hour(1), AS_OF)
    star = medallion.star_tables(warehouse)
    fact, employees = star["fact_timesheet"], star["dim_employee"]
    some_id = fact.first().id
    found = lookup.get_timesheet(fact, employees, some_id).first()
    assert found.employee.employee_key == found.employee_key
    assert lookup.get_timesheet(fact, employees, -1).isEmpty() and lookup.get_employee(employees, -1).isEmpty()
    with pytest.raises(LookupError):
        lookup.employee_timesheets(fact, employees, -1)
    key = employees.where("employee_id = '2'").first().employee_key
    rows, total = lookup.employee_timesheets(fact, employees, key, date_from=dt.date(2024, 10, 29))
    assert rows.count() == 1 and total.first().total == 1
    rows, total = lookup.list_employees(employees, size=2, search="n%n")
    assert [r.first_name for r in rows.collect()] == ["Ann"] and total.first().total == 1
    assert lookup.filter_timesheets(fact, department_key=99).isEmpty()
    october = warehouse.facts_between(dt.date(2024, 10, 29), dt.date(2024, 11, 30))
    assert [r.work_date for r in october.collect()] == [dt.date(2024, 10, 29)] and october.columns == fact.columns
    scan = october._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_month" in scan
    pushed = fact.where(F.col("work_date") >= F.lit(AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(work_date" in pushed


def test_departments_join_null_to_null_and_fan_out(spark):
    staged = spark.createDataFrame(
        [("a", None, "Unknown"), ("b", "1", "One"), ("c", "1", "Uno")], "employee_id string, department_id string, department_name string"
    ).selectExpr("*", "'f' first_name", "'l' last_name", "'j' job_title", "DATE '2020-01-01' hire_date", "DATE '2222-12-31' termination_date", "1 is_active")
    departments = gold.dim_department(staged, AS_OF)
    rows = gold.dim_employee(staged, departments, AS_OF).collect()
    keys = {(r.department_id, r.department_name): r.department_key for r in departments.collect()}
    got = sorted((r.employee_id, r.department_key) for r in rows)
    one, uno = keys["1", "One"], keys["1", "Uno"]
    assert got == sorted([("a", keys[None, "Unknown"]), ("b", one), ("b", uno), ("c", one), ("c", uno)])


def test_streams(spark, place, tmp_path):
    source, put = place
    header = tuple(TIMESHEETS.splitlines()[0].split("|"))
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    employees = spark.createDataFrame([("00037",), ("2",), ("3",)], "employee_id string")

    def load():
        stream = file_stream(spark, source, "timesheet", header, hour(1))
        run_available(stream, batch_writer(raw, lambda b: b, hour(1)), str(tmp_path / "raw-state"))
        stream = file_stream(spark, source, "timesheet", header, hour(1))
        stream_silver_timesheets(stream, employees, staged, str(tmp_path / "staged-state"), hour(1))
        return spark.read.parquet(raw).count(), spark.read.parquet(staged).count()

    assert load() == (3, 2)
    assert {r.source_file for r in spark.read.parquet(staged).collect()} == {"timesheet 1+a%20.csv"}
    assert load() == (3, 2)  # nothing new
    put("timesheet_2.csv", MORE_TIMESHEETS)
    assert load() == (4, 3)
    # A new checkpoint counts its batches from zero again and replaces nothing.
    stream = file_stream(spark, source, "timesheet", header, hour(2))
    run_available(stream, batch_writer(raw, lambda b: b, hour(2)), str(tmp_path / "new-state"))
    assert spark.read.parquet(raw).count() == 8


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    header = "client_employee_id|last_name"
    for folder, rows in (("a", "1|x"), ("b", '2|"two\nlines"\n3|y')):
        (tmp_path / "files" / folder).mkdir(parents=True)
        (tmp_path / "files" / folder / "employee_1.csv").write_text(f"{header}\n{rows}\n")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    source = str(tmp_path / "files")
    assert medallion.load_bronze(warehouse, source, hour(1), recursive=True)["employees"] == 3
    assert medallion.load_bronze(warehouse, source, hour(2), recursive=True)["employees"] == 0
    rows = {(r.source_file, r.client_employee_id, r.last_name) for r in warehouse.read(t.RAW_EMPLOYEE).collect()}
    assert rows == {("a/employee_1.csv", "1", "x"), ("b/employee_1.csv", "2", "two\nlines"), ("b/employee_1.csv", "3", "y")}


def test_batches_of_one_short_id_are_kept_apart(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    empty = warehouse.read(t.STG_EMPLOYEE)
    for mark in (hour(1), hour(2)):
        rows = spark.createDataFrame([(str(mark),)], "employee_id string").unionByName(empty, allowMissingColumns=True)
        warehouse.add(t.STG_EMPLOYEE, silver.stamp(rows, "00000000", mark), silver.batch_key(mark))
    assert warehouse.read(t.STG_EMPLOYEE).count() == 2


def test_silver_report(spark):
    day = dt.date(2024, 1, 1)
    employees = spark.createDataFrame(
        [("a", 1), ("a", 0), ("b", 7), (None, None), (None, 1)], "employee_id string, is_active int"
    )
    sheets = spark.createDataFrame([("a", day, 8.0), ("x", None, 25.0), ("x", day, None), (None, day, -1.0)], "employee_id string, work_date date, hours_worked double")
    report = {(r.layer, r.check_name): r for r in quality.silver_report(employees, sheets).collect()}
    failing = {k[1]: r.failing for k, r in report.items() if not r.passed and "Employee" in k[0]}
    assert failing == {"Null Employee ID": 2, "Valid is_active": 1, "Duplicate Employee ID": 2}
    failing = {k[1]: r.failing for k, r in report.items() if not r.passed and "Timesheet" in k[0]}
    assert failing == {"Null Employee ID": 1, "Null Work Date": 1, "Hours Worked Range (0-24)": 2}
    orphans = report["Silver - Referential Integrity", "Orphan Timesheet Records"]
    assert orphans.message == "1 employee IDs (2 records) not found in employee table" and not orphans.passed
    unused = report["Silver - Referential Integrity", "Employees Without Timesheets"]
    assert unused.passed and unused.message == "1 employees have no timesheet records"
    summary = {r.layer: (r.passed, r.error_count, r.warning_count) for r in quality.silver_summary(quality.silver_report(employees, sheets)).collect()}
    assert summary == {"Silver - Employee": (False, 1, 2), "Silver - Timesheet": (False, 2, 1), "Silver - Referential Integrity": (True, 0, 1)}


def test_lines_with_too_many_fields_are_kept_apart(spark, place, tmp_path):
    source, put = place
    put("employee_5.csv", 'client_employee_id|first_name|last_name\n1|a|b\n2|"x|y"|z|SURPLUS\n3|c\n\n"4"|"""q"""|d\n')
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    count = medallion.load_files(warehouse, t.RAW_EMPLOYEE, "employee_5", t.schemas.RAW_EMPLOYEE_COLUMNS, source, hour(1))
    rows = {(r.client_employee_id, r.last_name) for r in warehouse.read(t.RAW_EMPLOYEE).collect()}
    assert count == 3 and rows == {("1", "b"), ("3", None), ("4", "d")}
    odd = {(r.record, r.n_fields, r.n_expected, r.rejected, r.source_file) for r in warehouse.rejects(t.RAW_EMPLOYEE).collect()}
    assert odd == {('2|"x|y"|z|SURPLUS', 4, 3, True, "employee_5.csv"), ("3|c", 2, 3, False, "employee_5.csv")}
    assert medallion.load_files(warehouse, t.RAW_EMPLOYEE, "employee_5", t.schemas.RAW_EMPLOYEE_COLUMNS, source, hour(2)) == 0
    plan = warehouse.rejects(t.RAW_EMPLOYEE)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(record)" in plan


def test_a_load_that_stopped_before_its_list_of_files_is_not_repeated(spark, place, tmp_path):
    source, put = place
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    file = discover(spark, source, "employee")
    warehouse.add(t.RAW_EMPLOYEE, scan_delimited(spark, file, t.schemas.RAW_EMPLOYEE_COLUMNS, hour(1), with_records=True))
    put("employee_2.csv", MORE_EMPLOYEES)
    put("employee_9.csv", "")
    assert medallion.load_bronze(warehouse, source, hour(2))["employees"] == 1
    assert {r.source_file for r in warehouse.loaded_files(t.RAW_EMPLOYEE).collect()} == {"employee_1.csv", "employee_2.csv"}
    sizes = {r.source_file: r.length for r in warehouse.read(t.EMPLOYEE_FILES).collect()}
    assert sizes["employee_2.csv"] == len(MORE_EMPLOYEES)
    folders = {p.name for p in (tmp_path / "warehouse" / "raw" / "raw_employee").rglob("*") if p.is_dir()}
    assert not any(f.startswith("source_file") for f in folders)  # as many folders as loads
