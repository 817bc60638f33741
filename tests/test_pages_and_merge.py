"""Pages of tied listings, hours beyond four decimals and repeated keys."""

from pyspark.sql import functions as F

from shiftlens.config import Limits
from shiftlens.functions.numbers import round_half_away
from shiftlens.operators import merge, ordering
from shiftlens.plans import kpi


def test_pages_of_ties_hold_every_row_once(spark):
    df = spark.range(300).select(F.lit("same").alias("day"), F.col("id").cast("string").alias("pay_code")).repartition(7)
    limits = Limits(deep_page_rows=100)  # both ways of finding a page within one walk
    seen = [r.pay_code for n in range(1, 16) for r in ordering.page(df, [ordering.By("day", down=True)], n, 20, limits).collect()]
    assert len(seen) == 300 and len(set(seen)) == 300


def test_hours_are_neither_cut_nor_fatal(spark):
    hours = [(1, 0.49996), (1, 0.50001), (2, -0.25), (3, 1e20), (4, 1e300)]
    fact = spark.createDataFrame(hours, "employee_key long, hours_worked double")
    names = spark.createDataFrame([(k, str(k), "a", "b") for k in range(1, 5)], "employee_key long, employee_id string, first_name string, last_name string")
    got = {r.employee_id: r.avg_daily_hours for r in kpi.avg_hours(fact, names).collect()}
    assert got["1"] == 0.0 and str(got["2"]) == "0.0" and got["3"] == 1e20 and got["4"] == 1e300


def test_zero_has_no_sign(spark):
    assert str(spark.range(1).select(round_half_away(F.lit(-0.25)).alias("x")).first().x) == "0.0"


def test_repeated_incoming_keys_stay_one(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (3, "p"), (3, "q")], "k long, v string")
    assert sorted(map(tuple, merge.upsert_by_key(old, new, ["k"]).collect())) == [(1, "y"), (2, "b"), (3, "q")]
    assert sorted(map(tuple, merge.insert_if_absent(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "q")]


def test_deep_pages_are_found_by_counts(spark, tmp_path):
    """All pages in order are the table: nulls, ties, copies, and a value that holds most rows."""
    rows = [(None if i % 50 == 0 else 7 if i % 3 else i % 11, float(i % 5) if i % 7 else None, f"x{i % 40}") for i in range(400)]
    spark.createDataFrame(rows, "a int, b double, c string").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [ordering.By("a", down=True), ordering.By("b")]
    limits = Limits(deep_page_rows=60, page_cuts=4)
    walked = [tuple(r) for n in range(1, 10) for r in ordering.page(df, order, n, 50, limits).collect()]
    assert walked == [tuple(r) for r in df.orderBy(F.desc("a"), F.asc("b"), F.asc("c")).collect()]


def test_deep_pages_write_and_shuffle_no_rows(spark, tmp_path):
    spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("k")).write.parquet(str(tmp_path / "t"))
    found = ordering.page(spark.read.parquet(str(tmp_path / "t")), [ordering.By("id")], 50, 50, Limits(deep_page_rows=100))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in found.collect()] == list(range(2450, 2500))
    assert "GreaterThan" in plan and plan.count("Scan parquet") <= 3
