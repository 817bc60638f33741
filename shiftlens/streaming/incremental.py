"""File streams into raw and staging tables.

The streaming checkpoint takes the place of the list of loaded files and of the stored
high-water marks. Each micro-batch overwrites its own partition, so a repeated batch
leaves no duplicates. The partition carries the id that the checkpoint gave the stream, so
a new checkpoint, whose batches count from zero again, replaces nothing of an older one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import ntz
from ..plans.silver import clean_employee, clean_timesheet, keep_known, stamp
from ..schemas import STG_EMPLOYEE
from ..sources import paths
from ..sources.files import source_name
from ..sources.tables import BATCH_KEY


def file_stream(
    spark: SparkSession,
    data_dir: str,
    prefix: str,
    header: Sequence[str],
    loaded_at: dt.datetime | str,
    sep: str = "|",
    files_per_batch: int = 1000,
    multi_line: bool = True,
) -> DataFrame:
    """Delimited files of one layout as a stream of text rows with lineage.

    Line breaks inside quotes are read right; without them, ``multi_line=False`` splits large files over tasks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return (
        spark.readStream.schema(schema)
        .options(sep=sep, quote='"', escape='"', header=True, multiLine=multi_line, pathGlobFilter=f"{prefix}*.csv", maxFilesPerTrigger=files_per_batch)
        .csv(data_dir)
        .select(
            *[F.nullif(F.col(c), F.lit("")).alias(c) for c in header],
            source_name().alias("source_file"), ntz(loaded_at).alias("loaded_at"),
        )
    )


def run_available(rows: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has arrived since the last call, then stop."""
    query = rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def batch_writer(
    target: str, transform: Callable[[DataFrame], DataFrame], processed_at: dt.datetime | str
) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch into the partition of its stream and number."""

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        (
            stamp(transform(batch), f"{number:08x}", processed_at)
            .withColumn(BATCH_KEY, F.lit(f"{stream}-{number:08x}"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_KEY)
            .parquet(target)
        )

    return write


def stream_silver_timesheets(
    raw: DataFrame, employees: DataFrame, target: str, checkpoint: str, processed_at: dt.datetime | str
) -> None:
    """Clean raw timesheets as they arrive and keep those of known employees."""
    run_available(raw, batch_writer(target, lambda b: keep_known(clean_timesheet(b), employees), processed_at), checkpoint)


def stream_silver_employees(raw: DataFrame, target: str, checkpoint: str, processed_at: dt.datetime | str) -> None:
    """Clean raw employees as they arrive."""
    run_available(raw, batch_writer(target, clean_employee, processed_at), checkpoint)


def stream_silver(
    employees: DataFrame, timesheets: DataFrame, employee_target: str, timesheet_target: str, checkpoints: str, processed_at: dt.datetime | str
) -> None:
    """Both staging tables from their raw streams, on one trigger: timesheets wait until all employees that have arrived are staged."""
    spark = employees.sparkSession
    stream_silver_employees(employees, employee_target, f"{checkpoints}/employee", processed_at)
    staged = spark.createDataFrame([], STG_EMPLOYEE)
    if paths.exists(spark, employee_target):
        staged = spark.read.schema(STG_EMPLOYEE).parquet(employee_target)
    stream_silver_timesheets(timesheets, staged, timesheet_target, f"{checkpoints}/timesheet", processed_at)
