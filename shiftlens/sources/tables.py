"""Parquet tables of one warehouse folder.

Growing tables (raw, their lists of files, staging) are partitioned by load; a load overwrites only its own
partitions, so a repeated load after a crash leaves no duplicates. Raw tables also hold the lines whose number of
fields was wrong, apart from the rows where they were too many. Replaced tables
(dimensions, fact, state) get a new version folder each time; readers take the newest
version whose write has finished.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import schemas
from . import paths
from .files import EXPECTED, FIELDS, RECORD

RAW_EMPLOYEE, RAW_TIMESHEET = "raw/raw_employee", "raw/raw_timesheet"
EMPLOYEE_FILES, TIMESHEET_FILES = "raw/files_employee", "raw/files_timesheet"
FILES_OF = {RAW_EMPLOYEE: EMPLOYEE_FILES, RAW_TIMESHEET: TIMESHEET_FILES}
STG_EMPLOYEE, STG_TIMESHEET = "staging/stg_employee", "staging/stg_timesheet"
WATERMARK = "staging/etl_watermark"
STAR_STATE = "public/etl_star_state"
DIM_EMPLOYEE, DIM_DEPARTMENT = "public/dim_employee", "public/dim_department"
DIM_DATE, FACT_TIMESHEET = "public/dim_date", "public/fact_timesheet"

LOAD_DATE, LOAD_KEY, REJECTED, WORK_MONTH, BATCH_KEY = "load_date", "load_key", "rejected", "work_month", "batch_key"

SCHEMAS = {
    RAW_EMPLOYEE: schemas.RAW_EMPLOYEE,
    RAW_TIMESHEET: schemas.RAW_TIMESHEET,
    EMPLOYEE_FILES: schemas.RAW_FILES,
    TIMESHEET_FILES: schemas.RAW_FILES,
    STG_EMPLOYEE: schemas.STG_EMPLOYEE,
    STG_TIMESHEET: schemas.STG_TIMESHEET,
    WATERMARK: schemas.WATERMARK,
    STAR_STATE: schemas.STAR_STATE,
    DIM_EMPLOYEE: schemas.DIM_EMPLOYEE,
    DIM_DEPARTMENT: schemas.DIM_DEPARTMENT,
    DIM_DATE: schemas.DIM_DATE,
    FACT_TIMESHEET: schemas.FACT_TIMESHEET,
}

# Partition columns on disk; those that are no table columns help pruning only.
PARTITIONS = {
    RAW_EMPLOYEE: (LOAD_DATE, LOAD_KEY, REJECTED),
    RAW_TIMESHEET: (LOAD_DATE, LOAD_KEY, REJECTED),
    EMPLOYEE_FILES: (LOAD_DATE, LOAD_KEY),
    TIMESHEET_FILES: (LOAD_DATE, LOAD_KEY),
    STG_EMPLOYEE: (BATCH_KEY,),
    STG_TIMESHEET: (BATCH_KEY,),
    FACT_TIMESHEET: (WORK_MONTH,),
}
# Columns numbered while a table is written.
ROW_IDS = {FACT_TIMESHEET: "id"}
_HELPERS = {
    LOAD_DATE: T.DateType(), LOAD_KEY: T.StringType(), REJECTED: T.BooleanType(), WORK_MONTH: T.StringType(), BATCH_KEY: T.StringType(),
}
# Columns of raw tables on disk for lines with a wrong number of fields.
_RECORDS = [f for f in schemas.REJECTS.fields if f.name in (RECORD, FIELDS, EXPECTED)]
_GROWING = (RAW_EMPLOYEE, RAW_TIMESHEET, EMPLOYEE_FILES, TIMESHEET_FILES, STG_EMPLOYEE, STG_TIMESHEET)


def load_key(loaded_at: Column) -> Column:
    """The partition of a load within its day."""
    return F.date_format(loaded_at, "HHmmss.SSSSSS")


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _versions(self, name: str) -> list[str]:
        done = paths.glob(self.spark, f"{self.path(name)}/version=*/_SUCCESS")
        return [p.rsplit("/", 1)[0] for p in done]

    def read(self, name: str, with_helpers: bool = False) -> DataFrame:
        """Table content; an empty DataFrame of the declared schema before the first write."""
        rows = self._stored(name)
        if name in FILES_OF:
            rows = rows.where(~F.col(REJECTED)).drop(REJECTED, *(f.name for f in _RECORDS))
        return rows if with_helpers else rows.select(*SCHEMAS[name].fieldNames())

    def rejects(self, name: str) -> DataFrame:
        """Lines of a raw table with more or fewer fields than their header: those with more were ``rejected``, the others filled with NULL."""
        return self._stored(name).where(F.col(RECORD).isNotNull()).select(*schemas.REJECTS.fieldNames())

    def stored_load(self, name: str, loaded_at: dt.datetime) -> DataFrame:
        """Rows of one load of a raw table as ``add`` takes them, with their records."""
        at = F.lit(loaded_at).cast("timestamp_ntz")
        mine = (F.col(LOAD_DATE) == at.cast("date")) & (F.col(LOAD_KEY) == load_key(at))
        return self._stored(name).where(mine).drop(LOAD_DATE, LOAD_KEY, REJECTED)

    def _stored(self, name: str) -> DataFrame:
        helpers = [T.StructField(c, _HELPERS[c]) for c in PARTITIONS.get(name, ()) if c in _HELPERS]
        stored = T.StructType([*SCHEMAS[name].fields, *(_RECORDS if name in FILES_OF else ()), *helpers])
        if name in _GROWING:
            place = self.path(name) if paths.exists(self.spark, self.path(name)) else None
        else:
            place = next(reversed(self._versions(name)), None)
        if place is None:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(place)

    def facts_between(self, first: dt.date, last: dt.date) -> DataFrame:
        """Timesheet facts of a range of work dates; folders of other months are not listed."""
        months = F.col(WORK_MONTH).between(f"{first:%Y-%m}", f"{last:%Y-%m}")
        dates = F.col("work_date").between(F.lit(first), F.lit(last))
        return self.read(FACT_TIMESHEET, with_helpers=True).where(months & dates).drop(WORK_MONTH)

    def _with_helpers(self, name: str, df: DataFrame, batch_key: str | None = None) -> DataFrame:
        out = df.select(*[c for c in SCHEMAS[name].fieldNames() if c != ROW_IDS.get(name)])
        if name in FILES_OF:
            records = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _RECORDS]
            out = df.select(*out.columns, *records).withColumn(REJECTED, F.coalesce(F.col(FIELDS) > F.col(EXPECTED), F.lit(False)))
        if LOAD_DATE in PARTITIONS.get(name, ()):
            out = out.withColumns({LOAD_DATE: F.to_date("loaded_at"), LOAD_KEY: load_key(F.col("loaded_at"))})
        if WORK_MONTH in PARTITIONS.get(name, ()):
            out = out.withColumn(WORK_MONTH, F.date_format("work_date", "yyyy-MM"))
        if BATCH_KEY in PARTITIONS.get(name, ()):
            out = out.withColumn(BATCH_KEY, F.lit(batch_key))
        return out

    def add(self, name: str, df: DataFrame, batch_key: str | None = None) -> int:
        """Add the partitions of one load in a single commit; those of the same batch are replaced. Gives the rows that readers see.

        Rows are counted by the tasks that write them, rejected lines not.

        Staging tables need the key of the batch, unlike its short id never the same for two batches.
        """
        if BATCH_KEY in PARTITIONS[name] and not batch_key:
            raise ValueError(f"{name} is stored by batch: the key of the batch is missing")
        rows, written = self._with_helpers(name, df, batch_key), Observation()
        seen = F.count_if(~F.col(REJECTED)) if REJECTED in rows.columns else F.count(F.lit(1))
        (
            rows.observe(written, seen.alias("n"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS[name])
            .parquet(self.path(name))
        )
        return written.get["n"]

    def replace(self, name: str, df: DataFrame, first_id: int = 1) -> None:
        """Write a new version. It may be computed from the current one, which stays until ``drop_old``."""
        versions = self._versions(name)
        number = int(versions[-1].rsplit("=", 1)[1]) + 1 if versions else 1
        self._write(name, df, f"{self.path(name)}/version={number:08d}", "overwrite", first_id)

    def extend(self, name: str, df: DataFrame, first_id: int = 1) -> None:
        """Add rows to the current version in one commit."""
        versions = self._versions(name)
        if not versions:
            return self.replace(name, df, first_id)
        self._write(name, df, versions[-1], "append", first_id)

    def rewrite(self, name: str, df: DataFrame, first_id: int = 1) -> None:
        """Replace the partitions that the rows belong to, in the current version; all others stay as they are."""
        versions = self._versions(name)
        if not versions:
            return self.replace(name, df, first_id)
        self._write(name, df, versions[-1], "overwrite", first_id, "dynamic")

    def _write(self, name: str, df: DataFrame, path: str, mode: str, first_id: int, replaced: str = "static") -> None:
        rows = df
        if name in PARTITIONS:
            # Files of even size per partition folder; AQE splits a partition that is too large.
            rows = self._with_helpers(name, rows).hint("rebalance", *PARTITIONS[name])
        if name in ROW_IDS:
            # Given by the task that writes the row, after the last shuffle: a repeated task
            # replaces all it wrote, so ids stay unique. They are not dense, which would take a sort.
            rows = rows.withColumn(ROW_IDS[name], F.monotonically_increasing_id() + F.lit(first_id))
        rows = rows.select(*SCHEMAS[name].fieldNames(), *[c for c in PARTITIONS.get(name, ()) if c in _HELPERS])
        writer = rows.write.mode(mode).option("partitionOverwriteMode", replaced)
        if name in PARTITIONS:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.parquet(path)

    def drop_old(self, name: str, keep: int = 2) -> None:
        for old in self._versions(name)[:-keep]:
            paths.remove(self.spark, old)

    def batches(self, name: str) -> set[str]:
        """Keys of the batches that a staging table holds, from the folder names alone."""
        found = paths.glob(self.spark, f"{self.path(name)}/{BATCH_KEY}=*")
        return {unquote(p.rsplit("=", 1)[1]) for p in found}

    def loads(self, name: str) -> set[str]:
        """Days and keys of the loads that a table holds, from the folder names alone."""
        found = paths.glob(self.spark, f"{self.path(name)}/{LOAD_DATE}=*/{LOAD_KEY}=*")
        return {p.split(f"/{LOAD_DATE}=", 1)[1] for p in found}

    def loaded_files(self, name: str) -> DataFrame:
        """Files loaded into a raw table, by their paths below the folder of the load.

        A load that stopped between its rows and its list of files is completed first.
        """
        lost = self.loads(name) - self.loads(FILES_OF[name])
        if lost:
            marks = F.concat(F.col(LOAD_DATE).cast("string"), F.lit(f"/{LOAD_KEY}="), F.col(LOAD_KEY))
            files = self._stored(name).where(marks.isin(*lost)).select("source_file", "loaded_at").distinct()
            none = {"length": F.lit(None).cast("long"), "modified_at": F.lit(None).cast("timestamp_ntz")}
            self.add(FILES_OF[name], files.withColumns(none))
        return self.read(FILES_OF[name]).select("source_file")
