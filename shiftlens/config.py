"""Sentinels, size limits and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed values: "no end date" markers, one per layer.
TERMINATION_SENTINEL = dt.date(2222, 12, 31)
SCD_END_SENTINEL = dt.date(2222, 12, 1)
REPORT_SENTINEL = dt.date(2262, 1, 1)

# The default shift and the tolerance of the punctuality KPIs.
SCHEDULED_START = "09:00:00"
SCHEDULED_END = "17:00:00"
GRACE_MINUTES = 5


@dataclass(frozen=True)
class Limits:
    """Sizes that decide between physical strategies; results never depend on them."""

    broadcast_bytes: int = 64 << 20  # a join side is broadcast only when measured below this
    hot_rows: int = 5_000_000  # a key with this many rows is too much for one task
    tracked_keys: int = 1 << 16  # a key is found frequent when it holds 3.5 of this many parts of the rows
    deep_page_rows: int = 2_000  # a top-k gathers this many rows a partition; pages further in are found by counts
    page_cuts: int = 64  # values at which a column is cut to find such a page


DEFAULT_LIMITS = Limits()

_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="shiftlens-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
