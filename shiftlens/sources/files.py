"""Pipe-delimited source files."""

from __future__ import annotations

import csv
import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import ntz
from . import paths


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def discover(spark: SparkSession, root: str, prefix: str, suffix: str = ".csv", recursive: bool = False) -> list[str]:
    """Files whose name has the prefix and the suffix. Works on any store Spark can read."""
    if not recursive:
        return paths.glob(spark, f"{root.rstrip('/')}/{prefix}*{suffix}")
    names = paths.walk(spark, root)
    return [p for p in names if base_name(p).startswith(prefix) and p.endswith(suffix)]


def _scanned_path() -> Column:
    """Path of the file a row comes from, as the listing shows it, without its store."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, paths.STORE, "")


def source_name(root: str | None = None) -> Column:
    """The file a scanned row comes from: its path below the root, or its name alone."""
    path = _scanned_path()
    return F.element_at(F.split(path, "/"), -1) if root is None else F.substr(path, F.lit(len(root.rstrip("/")) + 2))


def listing(spark: SparkSession, root: str, prefix: str, suffix: str = ".csv", recursive: bool = False) -> DataFrame:
    """``discover`` as a table, listed by tasks: ``path``, ``source_file`` below the root, ``length`` and ``modified_at``. Empty files are left out."""
    folder = root.rstrip("/")
    reader, place = spark.read.format("binaryFile"), f"{folder}/{prefix}*{suffix}"
    if recursive:
        reader, place = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"{prefix}*{suffix}"), folder
    if not (paths.exists(spark, folder) if recursive else paths.glob(spark, place)):
        return spark.createDataFrame([], "path string, source_file string, length long, modified_at timestamp_ntz")
    below = len(paths.qualified(spark, root).rstrip("/")) + 2
    name = F.substr(F.regexp_replace("path", paths.STORE, ""), F.lit(below))
    found = reader.load(place).select("path", name.alias("source_file"), "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"))
    return found.where(F.col("length") > 0)


def first_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``(path, line)``: each file's path without its store and its first line, read by one task a file that stops after it."""
    lines = spark.read.text(list(files)).select(
        _scanned_path().alias("path"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("start")
    )

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    return lines.mapInArrow(first, lines.schema).where(F.col("start") == 0).select("path", "line")


def _one_file_a_task(spark: SparkSession, work):
    """Run ``work`` with as many tasks as files, however small these are."""
    name, largest = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    before = spark.conf.get(name)
    spark.conf.set(name, largest)
    try:
        return work()
    finally:
        spark.conf.set(name, before)


def header_fields(line: str, sep: str = "|") -> tuple[str, ...]:
    """Column names of a header line, without blanks and quotes."""
    fields = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar='"'), [])
    return tuple(f.strip().replace('"', "") for f in fields)


def headers_of(spark: SparkSession, files: Sequence[str], sep: str = "|") -> dict[str, tuple[str, ...]]:
    """Column names by path without its store, from one job; files without a line are left out."""
    if not files:
        return {}
    found = _one_file_a_task(spark, first_lines(spark, files).collect)
    return {r.path: header_fields(r.line, sep) for r in found if r.line}


#: The line of a row that had more or fewer fields than its header, and both numbers; NULL for all other rows.
RECORD, FIELDS, EXPECTED = "record", "n_fields", "n_expected"


def _fields_in(record: Column, sep: str) -> Column:
    """Fields of a line; separators inside quotes don't count."""
    bare = F.regexp_replace(record, r'"([^"]|"")*"', "")
    return F.size(F.split(bare, rf"\Q{sep}\E"))


def scan_delimited(
    spark: SparkSession,
    files: Sequence[str],
    columns: Sequence[str],
    loaded_at: dt.datetime | str,
    sep: str = "|",
    multi_line: bool = False,
    root: str | None = None,
    with_records: bool = False,
) -> DataFrame:
    """Read files as text columns with lineage; columns a file lacks are NULL.

    Files are grouped by header, so each is read by its own column order, with one scan per
    layout. ``multi_line`` reads files whole, for line breaks inside quotes. Missing fields are NULL, those beyond the
    header are cut; ``with_records`` adds the line of such rows and its number of fields, from the same parse.
    ``source_file`` is the path below ``root``, or without it the name of the file.
    """
    files = list(files)
    headers, layouts = headers_of(spark, files, sep), defaultdict(list)
    for f in files:
        if header := headers.get(paths.local_part(f)):
            layouts[header].append(f)

    def read(header: tuple[str, ...], members: list[str]) -> DataFrame:
        line = "__line"
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, line)])
        scan = (
            spark.read.schema(schema if with_records else T.StructType(schema.fields[:-1]))
            .options(sep=sep, quote='"', escape='"', header=True, multiLine=multi_line, columnNameOfCorruptRecord=line, columnPruning=not with_records)
            .csv(members)
        )
        wanted = [(F.nullif(F.col(c), F.lit("")) if c in header else F.lit(None).cast("string")).alias(c) for c in columns]
        records = []
        if with_records:
            expected = F.when(F.col(line).isNotNull(), F.lit(len(header)))
            records = [F.col(line).alias(RECORD), F.when(F.col(line).isNotNull(), _fields_in(F.col(line), sep)).alias(FIELDS), expected.alias(EXPECTED)]
        return scan.select(*wanted, source_name(root).alias("source_file"), ntz(loaded_at).alias("loaded_at"), *records)

    if not layouts:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "source_file")])
        rows = spark.createDataFrame([], empty).withColumn("loaded_at", ntz(loaded_at))
        none = {RECORD: F.lit(None).cast("string"), FIELDS: F.lit(None).cast("int"), EXPECTED: F.lit(None).cast("int")}
        return rows.withColumns(none) if with_records else rows
    return reduce(DataFrame.unionByName, [read(*layout) for layout in layouts.items()])


def spans_lines(record: Column) -> Column:
    """Whether a line opens a quoted field that it does not close, or closes one of a line before."""
    return (F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))) % 2 == 1


def write_delimited(df: DataFrame, path: str, sep: str = "|", prefix: str = "part", by: Sequence[str] = ()) -> None:
    """Add quoted text files that ``scan_delimited`` reads back unchanged, their names with a prefix, in folders ``by`` columns."""
    df.write.mode("append").partitionBy(*by).option("mapreduce.output.basename", prefix).options(
        sep=sep, quote='"', escape='"', quoteAll=True, header=True, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def new_files(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of files whose name was never loaded."""
    names = loaded.select("source_file").distinct()
    return incoming.join(names, "source_file", "left_anti")
