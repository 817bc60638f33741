"""The star schema kept up to date by batches, against one built anew."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shiftlens.plans import medallion, star
from shiftlens.sources import tables as t
from shiftlens.sources.tables import Warehouse

AS_OF = dt.date(2025, 1, 1)
EMPLOYEE = "client_employee_id|first_name|department_id|department_name\n"
TIMESHEET = "client_employee_id|punch_apply_date|hours_worked\n"


@pytest.fixture
def run(spark, tmp_path):
    source = tmp_path / "files"
    source.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    hours = iter(range(1, 20))

    def load(employees=(), timesheets=(), as_of=AS_OF):
        hour = next(hours)
        for name, header, rows in (("employee", EMPLOYEE, employees), ("timesheet", TIMESHEET, timesheets)):
            if rows:
                (source / f"{name}_{hour}.csv").write_text(header + "".join(f"{row}\n" for row in rows))
        at = dt.datetime(2025, 1, 1, hour)
        medallion.load_bronze(warehouse, str(source), at, multi_line=False)
        medallion.transform_silver(warehouse, at, validate=False)
        return star.load_star(warehouse, as_of)

    return warehouse, load


def files(warehouse):
    root = Path(warehouse.root)
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("public/**/*.parquet")}


def months(found):
    return {p.split("work_month=")[1].split("/")[0] for p in found if "work_month=" in p}


def content(warehouse):
    # Ids of the fact and of dates depend on when they came.
    return {name: sorted(map(str, rows.drop("id", "date_id").collect())) for name, rows in star.star_tables(warehouse).items()}


def assert_equals_rebuild(spark, warehouse, tmp_path):
    other = Warehouse(spark, str(tmp_path / f"other-{len(list(tmp_path.iterdir()))}"))
    shutil.copytree(f"{warehouse.root}/staging", f"{other.root}/staging")
    star.load_star(other, AS_OF)
    assert content(warehouse) == content(other)
    ids = warehouse.read(t.FACT_TIMESHEET)
    assert ids.select("id").distinct().count() == ids.count()


FIRST = (["1|Ann|A|A-One", "2|Bo|B|B-Two"], ["1|2024-01-05|8", "2|2024-01-31|7.5", "1|2024-02-10|6", "2|2024-04-01|5", "9|2024-01-01|1"])


def test_only_what_changed_is_written(spark, run, tmp_path):
    warehouse, load = run
    first = load(*FIRST)
    start = files(warehouse)
    assert months(start) == {"2024-01", "2024-02", "2024-04"}
    assert load(as_of=dt.date(2025, 6, 1)) == first and files(warehouse) == start  # nothing new, nothing written

    late = load([], ["2|2024-02-11|4", "1||3", "2|2024-03-01|1"])
    after = files(warehouse)
    assert late["fact_timesheet"] == 7
    assert {p for p in start if "2024-01" in p or "2024-04" in p} <= set(after)
    assert all(after[p] == start[p] for p in start if p in after)
    assert months(set(after) - set(start)) == {"2024-02", "2024-03", "__HIVE_DEFAULT_PARTITION__"}
    assert_equals_rebuild(spark, warehouse, tmp_path)

    keys = {r.employee_id: r.employee_key for r in warehouse.read(t.DIM_EMPLOYEE).collect()}
    facts = {p for p in files(warehouse) if "fact_timesheet" in p}
    load(["0|Cy|C|C-Three", "00|Di|A|A-One"], [])
    assert {r.employee_id: r.employee_key for r in warehouse.read(t.DIM_EMPLOYEE).collect()} == {**keys, "0": 3, "00": 4}
    assert {p for p in files(warehouse) if "fact_timesheet" in p} == facts  # no timesheet is theirs

    before = files(warehouse)
    load(["1|Anna|A|A-One"], ["0|2024-05-05|2"])  # sent again: the months of earlier timesheets change too
    assert months(set(files(warehouse)) - set(before)) == {"2024-01", "2024-02", "2024-05", "__HIVE_DEFAULT_PARTITION__"}
    assert_equals_rebuild(spark, warehouse, tmp_path)


def test_a_second_name_of_a_department_and_other_options_rebuild_all(spark, run, tmp_path):
    warehouse, load = run
    load(*FIRST)
    load(["3|Ed|A|A-Uno"], ["3|2024-06-01|1"])
    assert warehouse.read(t.DIM_EMPLOYEE).where(F.col("employee_id") == "1").count() == 2
    assert_equals_rebuild(spark, warehouse, tmp_path)
    before = files(warehouse)
    star.load_star(warehouse, AS_OF, recategorize=False)
    assert not {p for p in files(warehouse) if "fact" in p} <= set(before)


@pytest.mark.parametrize("stops_at", ["_note", "_update_fact"])
def test_a_run_that_stopped_is_done_again(spark, run, tmp_path, monkeypatch, stops_at):
    warehouse, load = run
    load(*FIRST)
    work = getattr(star, stops_at)

    def stop(*given):
        if stops_at == "_update_fact":
            work(*given)
        raise RuntimeError("lost")

    monkeypatch.setattr(star, stops_at, stop)
    with pytest.raises(RuntimeError):
        load(["3|Ed|C|C-Three", "2|Bob|B|B-Two"], ["3|2024-01-09|1"])
    monkeypatch.undo()
    load([], ["1|2024-02-01|2"])
    assert_equals_rebuild(spark, warehouse, tmp_path)


def test_a_batch_still_being_written_is_left_for_later(spark, run, tmp_path):
    warehouse, load = run
    load(*FIRST)
    before = files(warehouse)
    mark = star.silver.watermark_of(warehouse.read(t.WATERMARK), "raw_timesheet")
    warehouse.add(t.STG_TIMESHEET, warehouse.read(t.STG_TIMESHEET).limit(1), star.silver.batch_key(mark))
    star.load_star(warehouse, AS_OF)
    assert files(warehouse) == before
