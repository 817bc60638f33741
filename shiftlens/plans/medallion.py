"""The full run: files to raw, raw to staging, staging to the star schema, then checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_LIMITS, Limits, scratch_path
from ..functions.dates import ntz
from ..schemas import RAW_EMPLOYEE_COLUMNS, RAW_TIMESHEET_COLUMNS
from ..sources import paths, tables as t
from ..sources.files import RECORD, listing, new_files, scan_delimited, spans_lines
from ..sources.tables import Warehouse
from . import date_votes, quality, silver, star


class ValidationFailed(ValueError):
    """Staging validation failed and the run was told to stop then."""


# Raw


def fresh_files(warehouse: Warehouse, table: str, prefix: str, data_dir: str, recursive: bool = False) -> DataFrame:
    """The files of one table that it does not have yet, as ``listing`` gives them.

    A file is known by its path below ``data_dir``: equal names in two folders are two files.
    """
    found = listing(warehouse.spark, data_dir, prefix, recursive=recursive)
    return new_files(found, warehouse.loaded_files(table))


def load_files(
    warehouse: Warehouse,
    table: str,
    prefix: str,
    columns: tuple[str, ...],
    data_dir: str,
    loaded_at: dt.datetime,
    recursive: bool = False,
    multi_line: bool | None = None,
) -> int:
    """Load the files of one table that it does not have yet, in one commit, then note them as loaded; the rows loaded.

    Lines are parsed once, and those with too many fields are kept apart in the same write. Files whose quoted fields
    span lines show by lines of a wrong length with an odd number of quotes: these files are read again whole.
    ``multi_line`` says for all files whether to read them whole.
    """
    spark, root = warehouse.spark, paths.qualified(warehouse.spark, data_dir)
    place = scratch_path(spark, "files")
    fresh_files(warehouse, table, prefix, data_dir, recursive).write.parquet(place)
    fresh = spark.read.parquet(place)  # one listing for the load and its list of files
    names = {r.path: r.source_file for r in fresh.select("path", "source_file").collect()}
    if not names:
        return 0

    def scan(files: list[str], whole: bool) -> DataFrame:
        return scan_delimited(spark, files, columns, loaded_at, multi_line=whole, root=root, with_records=True)

    loaded = warehouse.add(table, scan(sorted(names), bool(multi_line)))
    if multi_line is None:
        odd = warehouse.rejects(table).where((F.col("loaded_at") == ntz(loaded_at)) & spans_lines(F.col(RECORD)))
        broken = {r.source_file for r in odd.select("source_file").distinct().collect()}
        if broken:
            # The load's rows as they are now, but for these files; written apart, since they replace themselves.
            apart = scratch_path(spark, "load")
            rows = warehouse.stored_load(table, loaded_at).where(~F.col("source_file").isin(*broken))
            rows.unionByName(scan(sorted(p for p, name in names.items() if name in broken), True)).write.parquet(apart)
            loaded = warehouse.add(table, spark.read.parquet(apart))
    warehouse.add(t.FILES_OF[table], fresh.withColumn("loaded_at", ntz(loaded_at)))
    return loaded


def load_bronze(
    warehouse: Warehouse, data_dir: str, loaded_at: dt.datetime, recursive: bool = False, multi_line: bool | None = None
) -> dict[str, int]:
    """Load files never loaded before, each table in one commit."""
    kind = (data_dir, loaded_at, recursive, multi_line)
    return {
        "employees": load_files(warehouse, t.RAW_EMPLOYEE, "employee", RAW_EMPLOYEE_COLUMNS, *kind),
        "timesheets": load_files(warehouse, t.RAW_TIMESHEET, "timesheet", RAW_TIMESHEET_COLUMNS, *kind),
    }


# Staging


def _unprocessed(warehouse: Warehouse, table: str, mark: dt.datetime) -> DataFrame:
    """Raw rows after the mark. Folders of earlier days are not even listed."""
    raw = warehouse.read(table, with_helpers=True)
    return silver.rows_after(raw.where(F.col(t.LOAD_DATE) >= ntz(mark).cast("date")), mark).drop(t.LOAD_DATE, t.LOAD_KEY)


def _advance(warehouse: Warehouse, table_name: str, last: dt.datetime, now: dt.datetime) -> None:
    state = warehouse.read(t.WATERMARK)
    mark = warehouse.spark.range(1).select(F.lit(table_name).alias("table_name"), ntz(last).alias("last_processed_at"))
    warehouse.replace(t.WATERMARK, silver.advance_marks(state, mark, now).coalesce(1))
    warehouse.drop_old(t.WATERMARK)


def _transform(warehouse: Warehouse, raw_table: str, stg_table: str, clean, now: dt.datetime) -> tuple[str, int, int]:
    """Clean the new raw rows into staging, then move the mark: batch, rows read, rows kept."""
    name = raw_table.rsplit("/", 1)[-1]
    mark = silver.watermark_of(warehouse.read(t.WATERMARK), name)
    batch, key = silver.batch_id(name, mark), silver.batch_key(mark)
    rows = _unprocessed(warehouse, raw_table, mark)
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("last")).first()
    if not found.n:
        return batch, 0, 0
    # Later arrivals belong to the next run.
    cleaned = clean(rows.where(F.col("loaded_at") <= ntz(found.last)))
    kept = warehouse.add(stg_table, silver.stamp(cleaned, batch, now), key)
    _advance(warehouse, name, found.last, now)
    return batch, found.n, kept


def transform_silver(
    warehouse: Warehouse,
    processed_at: dt.datetime,
    validate: bool = True,
    date_formats: Sequence[str] = (),
    limits: Limits = DEFAULT_LIMITS,
    vote_formats: Sequence[str] = (),
) -> dict:
    """Clean new raw rows, drop orphan timesheets, validate staging.

    ``vote_formats`` (such as ``date_votes.CANDIDATES``) are formats of which each file's dates elect one; texts that
    are read by none are counted in the report.
    """
    unread: list[DataFrame] = []

    def voted(raw: DataFrame, table: str, layer: str, columns: tuple[str, ...]) -> DataFrame:
        if not vote_formats:
            return raw
        place = scratch_path(warehouse.spark, "votes")
        date_votes.tally(raw, columns, vote_formats).write.parquet(place)
        tallied = warehouse.spark.read.parquet(place)  # one row a file, used by the load and by its report
        unread.append(date_votes.report(table, layer, tallied))
        return date_votes.iso_dates(raw, tallied, vote_formats, limits)

    def clean_employees(raw: DataFrame) -> DataFrame:
        rows = voted(raw, "stg_employee", "Silver - Employee", ("hire_date", "term_date"))
        return silver.clean_employee(rows, date_formats)

    batch, _, employees = _transform(warehouse, t.RAW_EMPLOYEE, t.STG_EMPLOYEE, clean_employees, processed_at)

    def known_timesheets(raw: DataFrame) -> DataFrame:
        rows = voted(raw, "stg_timesheet", "Silver - Timesheet", ("punch_apply_date", "punch_in_datetime", "punch_out_datetime"))
        return silver.keep_known(silver.clean_timesheet(rows, date_formats), warehouse.read(t.STG_EMPLOYEE), limits)

    ts_batch, found, kept = _transform(warehouse, t.RAW_TIMESHEET, t.STG_TIMESHEET, known_timesheets, processed_at)
    report = None
    if validate and (employees or kept):
        report = quality.silver_report(warehouse.read(t.STG_EMPLOYEE), warehouse.read(t.STG_TIMESHEET))
        report = reduce(DataFrame.unionByName, unread, report)
    return {
        "batch_id": batch, "timesheet_batch_id": ts_batch, "employees": employees,
        "timesheets": kept, "orphans": found - kept, "validation": report,
    }


def check_gate(silver_result: dict, skip_on_validation_fail: bool) -> bool:
    """Whether staging is valid; raises when it is not and the run should stop."""
    report = silver_result.get("validation")
    if report is None:
        return True
    valid = quality.silver_summary(report).where(~F.col("passed")).isEmpty()
    if not valid and skip_on_validation_fail:
        raise ValidationFailed("run stopped: staging validation failed")
    return valid


# Star schema

load_gold, refresh_fact, star_tables = star.load_star, star.refresh_fact, star.star_tables


def post_load(warehouse: Warehouse) -> DataFrame:
    """Rows of each stored table of the star schema; one that can't be read is a failed check."""
    return quality.post_load_report(warehouse.spark, {name: partial(warehouse.read, table) for name, table in star.STAR.items()})


def run_medallion(
    warehouse: Warehouse,
    data_dir: str,
    loaded_at: dt.datetime,
    as_of: dt.date,
    skip_on_validation_fail: bool = False,
    date_formats: Sequence[str] = (),
    recursive: bool = False,
    limits: Limits = DEFAULT_LIMITS,
    vote_formats: Sequence[str] = (),
) -> dict:
    """All layers in order; results of each."""
    results: dict = {"bronze": load_bronze(warehouse, data_dir, loaded_at, recursive)}
    results["silver"] = transform_silver(warehouse, loaded_at, date_formats=date_formats, limits=limits, vote_formats=vote_formats)
    results["valid"] = check_gate(results["silver"], skip_on_validation_fail)
    results["gold"] = load_gold(warehouse, as_of, limits=limits)
    results["post_load_validation"] = post_load(warehouse)
    return results
