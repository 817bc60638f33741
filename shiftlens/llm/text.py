"""Words and lower case as every operator here counts them, and where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; the faster ``lower`` serves texts that are ASCII only."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words, repeats included; fewer words are one run, no words none."""
    n = F.size(tokens)
    run = lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(size)))
    return (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(n < size, F.array(F.xxhash64(F.concat_ws(" ", tokens), n)))
        .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), run))
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, for operators that run Python in their tasks."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='llm-code-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def stored(frame: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read again: lineage ends here and survives lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/llm-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Names a row where ids are repeated or missing, and holds the row itself.
ROW, BOXED = "_row_key", "_row"


def with_row_keys(docs: DataFrame) -> DataFrame:
    """Each row as a struct ``BOXED`` with a unique ``ROW``, stored, so that a second reading numbers them alike.

    Boxed, no column of the caller clashes with the key.
    """
    box = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(BOXED)
    return stored(docs.select(box, F.monotonically_increasing_id().alias(ROW)))
