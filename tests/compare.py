"""Run a registered query and its oracle over one folder and compare."""

import sys
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in one order, one notation per kind of value."""
    out = pd.DataFrame()
    for c in sorted(frame.columns):
        column = frame[c]
        if str(column.dtype).startswith(("datetime", "timestamp")):
            column = pd.to_datetime(column).astype("datetime64[us]")
        out[c] = column.map(lambda v: "~" if v is None or v is pd.NaT or v != v else str(pd.Timestamp(v)) if hasattr(v, "year") else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(spark_rows, oracle_rows: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    ours, theirs = spark_rows.toPandas(), oracle_rows
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    kinds = {c: (_kind(ours[c]), _kind(theirs[c])) for c in ours.columns}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if wrong and len(ours):
        return f"types {wrong}"
    a, b = normal(ours), normal(theirs)
    if a.equals(b):
        return ""
    rows = (a != b).any(axis=1)
    return f"{rows.sum()} rows differ, first\n{a[rows].head(3).to_string()}\n{b[rows].head(3).to_string()}"


def _kind(column: pd.Series) -> str:
    kind = column.dtype.kind
    return "i" if kind in "iu" else kind if kind != "M" else "O"


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            rows = con.execute(oracles[name]).fetchdf() if name in oracles else None
            problem = difference(result, rows) if rows is not None else f"no oracle, {result.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'OK ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("bad:", bad)
