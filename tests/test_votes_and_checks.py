"""Date formats by vote, checks of unreadable tables, pruning of the stored fact, rows counted while written."""

import datetime as dt

from pyspark.sql import functions as F

from shiftlens.plans import date_votes, lookup, medallion, quality, silver
from shiftlens.sources import tables as t
from shiftlens.sources.tables import Warehouse

RAW = "client_employee_id string, hire_date string, term_date string, source_file string, loaded_at timestamp_ntz"


def raw_rows(spark, texts):
    rows = [(str(i), text, None, name, dt.datetime(2025, 1, 1)) for i, (name, text) in enumerate(texts)]
    return spark.createDataFrame(rows, RAW).repartition(3)


def test_each_file_elects_its_format(spark):
    texts = [
        ("us", "10/28/2024"), ("us", "01/02/2024"), ("us", '"11/05/2024"'), ("us", "never"), ("us", "2024-03-04"),
        ("eu", "28/10/2024"), ("eu", "01/02/2024"), ("eu", "13/02/2024 09:30"), ("plain", "20241028"), ("iso", "2024-10-28"), ("iso", "10/28/2024"),
        ("tied", "10/28/2024"), ("tied", "28/10/2024"), ("none", "[NULL]"), ("none", ""),
    ]
    raw = raw_rows(spark, texts)
    tallied = date_votes.tally(raw, ("hire_date", "term_date"))
    found = {r.source_file: (r.format[:10], r.n_texts, r.n_parsed) for r in date_votes.votes(tallied).where("column = 'hire_date'").collect()}
    assert found == {
        "us": ("MM/dd/yyyy", 5, 4), "eu": ("dd/MM/yyyy", 3, 3), "plain": ("yyyyMMdd[ ", 1, 1), "iso": ("MM/dd/yyyy", 2, 2),
        "tied": ("MM/dd/yyyy", 2, 1), "none": ("ISO", 0, 0),
    }
    dates = {int(r.employee_id): r.hire_date for r in silver.clean_employee(date_votes.iso_dates(raw, tallied)).collect()}
    day = lambda *d: dt.date(*d)
    assert [dates[i] for i in range(len(texts))] == [
        day(2024, 10, 28), day(2024, 1, 2), day(2024, 11, 5), None, day(2024, 3, 4), day(2024, 10, 28), day(2024, 2, 1), day(2024, 2, 13),
        day(2024, 10, 28), day(2024, 10, 28), day(2024, 10, 28), day(2024, 10, 28), None, None, None,
    ]
    warned = {r.check_name: (r.failing, r.severity) for r in date_votes.report("stg_employee", "x", tallied).collect()}
    assert warned == {"Unread Dates: hire_date": (2, "WARNING"), "Unread Dates: term_date": (0, "WARNING")}


def test_votes_of_no_rows(spark):
    raw = raw_rows(spark, [("f", "2024-01-01")]).limit(0)
    tallied = date_votes.tally(raw, ("hire_date",))
    assert date_votes.votes(tallied).count() == 0 and date_votes.iso_dates(raw, tallied).count() == 0
    assert [r.failing for r in date_votes.report("x", "x", tallied).collect()] == [0]


def files(tmp_path, date="10/28/2024"):
    source = tmp_path / "files"
    source.mkdir()
    (source / "employee_1.csv").write_text("client_employee_id|first_name|hire_date|term_date\n1|Ann|03/30/2020|\n2|Bo|soon|12/24/2024\n")
    (source / "timesheet_1.csv").write_text(
        "client_employee_id|punch_apply_date|punch_in_datetime|punch_out_datetime|hours_worked\n"
        f"1|{date}|{date} 09:00|{date} 17:00:30|8\n9|{date}|||8\n"
    )
    return str(source)


def test_a_run_with_votes_reads_and_reports(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    source = files(tmp_path)
    results = medallion.run_medallion(warehouse, source, dt.datetime(2025, 1, 1), dt.date(2025, 1, 1), vote_formats=date_votes.CANDIDATES)
    assert results["bronze"] == {"employees": 2, "timesheets": 2}
    assert results["silver"]["timesheets"] == 1 and results["silver"]["orphans"] == 1
    stored = warehouse.read(t.STG_TIMESHEET).first()
    assert (stored.work_date, stored.punch_in, stored.punch_out) == (dt.date(2024, 10, 28), dt.datetime(2024, 10, 28, 9), dt.datetime(2024, 10, 28, 17, 0, 30))
    ends = {r.employee_id: r.termination_date for r in warehouse.read(t.STG_EMPLOYEE).collect()}
    assert ends == {"1": dt.date(2222, 12, 31), "2": dt.date(2024, 12, 24)}
    unread = {r.check_name: r.failing for r in results["silver"]["validation"].where(F.col("check_name").startswith("Unread")).collect()}
    assert unread["Unread Dates: hire_date"] == 1 and sum(unread.values()) == 1 and len(unread) == 5
    assert all(r.passed for r in results["post_load_validation"].collect())


def test_unreadable_and_empty_tables_fail_their_check(spark, tmp_path):
    place = str(tmp_path / "broken")
    spark.range(3).select(F.col("id").cast("string")).write.text(place)
    reads = {
        "good": lambda: spark.range(5),
        "empty": lambda: spark.range(0),
        "broken": lambda: spark.read.schema("id long").parquet(place),
        "missing": lambda: spark.read.parquet(str(tmp_path / "nowhere")),
    }
    rows = {r.table_name: r for r in quality.post_load_report(spark, reads).collect()}
    assert {n: (r.db_row_count, r.passed) for n, r in rows.items()} == {"good": (5, True), "empty": (0, False), "broken": (None, False), "missing": (None, False)}
    assert rows["broken"].message.startswith("Table not readable")


def test_orphans_alone_are_counted_as_none(spark, tmp_path):
    """A load whose rows are all dropped still gives a count."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    nothing = spark.createDataFrame([], RAW.replace("hire_date string, term_date string", "punch_apply_date string"))
    key = silver.batch_key(silver.BEGINNING)
    rows = silver.stamp(silver.clean_timesheet(nothing.withColumns({c: F.lit("") for c in ("pay_code",)})), "x", "2025-01-01")
    assert warehouse.add(t.STG_TIMESHEET, rows, key) == 0


def test_listings_prune_the_stored_fact(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    spark_rows = [(i, dt.date(2024, 1 + i % 6, 5)) for i in range(60)]
    given = {"id", "employee_key", "work_date"}
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.SCHEMAS[t.FACT_TIMESHEET].fields if f.name not in given]
    warehouse.replace(t.FACT_TIMESHEET, spark.createDataFrame(spark_rows, "employee_key long, work_date date").select("*", *empty))
    fact = warehouse.read(t.FACT_TIMESHEET, with_helpers=True)
    rows, total = lookup.list_timesheets(fact, date_from=dt.date(2024, 2, 1), date_to=dt.date(2024, 3, 31))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "work_month" in filters and "2024-02" in filters and "2024-03" in filters
    assert total.first().total == 20 and rows.columns == t.SCHEMAS[t.FACT_TIMESHEET].fieldNames()
