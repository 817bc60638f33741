"""Operators: small limits force the paths meant for large or skewed inputs."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shiftlens.config import Limits
from shiftlens.operators import checks, merge, ordering, sizing
from shiftlens.operators.joins import sized_join

SHUFFLE = Limits(broadcast_bytes=0, hot_rows=10**9)  # never broadcast, nothing hot
SALTED = Limits(broadcast_bytes=0, hot_rows=50)  # hot keys are salted


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    keys = ["hot"] * 300 + [None] * 120 + [str(rng.randint(0, 40)) for _ in range(200)]
    left = spark.createDataFrame([(k, i % 90) for i, k in enumerate(keys)], "k string, v int")
    right = spark.createDataFrame([(str(i), f"n{i}") for i in range(5, 60)] + [("hot", "a"), ("hot", "b"), (None, "none")], "k string, name string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_sized_join_gives_the_same_rows_by_every_strategy(sides, how, null_safe):
    left, right = sides
    if how in ("left_semi", "left_anti"):
        right = right.select("k").distinct()
    other = right.withColumnRenamed("k", "k2")
    condition = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    wanted = bag(left.join(other, condition, how).drop("k2"))
    for limits in (Limits(), SHUFFLE, SALTED):
        joined = sized_join(left, right, "k", how, null_safe=null_safe, limits=limits)
        assert bag(joined.select(*[c for c in ("k", "v", "name") if c in joined.columns])) == wanted


def test_strategies_are_the_intended_ones(sides):
    left, right = sides

    def plan(limits):
        return sized_join(left, right, "k", "left", limits=limits)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(Limits())
    assert "strategy=broadcast" not in plan(SHUFFLE) and "Union" not in plan(SHUFFLE)
    assert "__salt" in plan(SALTED) and "Union" not in plan(SALTED)
    assert sizing.hot_keys(left, "k", SALTED) == {"hot": 300, None: 120}


def test_many_hot_keys_are_all_spread(spark, tmp_path):
    path = str(tmp_path / "left")
    spark.range(0, 120_000, 1, 6).selectExpr("CASE WHEN id % 4 = 0 THEN id ELSE id % 2000 END AS k", "id AS v").write.parquet(path)
    left = spark.read.parquet(path)
    right = spark.range(0, 2100).selectExpr("id AS k", "id * 2 AS w")
    hot = sizing.hot_keys(left, "k", SALTED)
    wanted = left.groupBy("k").count().where("count >= 50")
    assert len(hot) >= 1500 and {r.k for r in wanted.collect()} <= set(hot)
    joined = sized_join(left, right, "k", limits=SALTED)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # besides the pass that sketched the keys
    assert bag(joined.groupBy("k").agg(F.count("*"), F.sum("v"), F.sum("w"))) == bag(left.join(right, "k").groupBy("k").agg(F.count("*"), F.sum("v"), F.sum("w")))


def test_copies_of_one_row_are_spread(spark):
    left = spark.range(0, 4000, 1, 8).selectExpr("'same' AS k")
    right = spark.createDataFrame([("same", 1), ("other", 2)], "k string, w int")
    joined = sized_join(left, right, "k", limits=SALTED)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in sized_join(left, right, "k", limits=SALTED).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.count() == 4000 == sum(sizes) and max(sizes) < 3000


def test_surrogate_keys_are_dense_ordered_and_whole(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c"]), rng.randint(0, 3)) for _ in range(500)] + [("copy", 1)] * 700 + [(None, 2)] * 3
    df = spark.createDataFrame(rows, "name string, n int").repartition(7)
    for chunk_free in (df, df.distinct()):
        keyed = ordering.surrogate_keys(chunk_free, "key", ["name"], distinct=chunk_free is not df, start=10).collect()
        assert sorted(r.key for r in keyed) == list(range(11, 11 + chunk_free.count()))
        assert Counter((r.name, r.n) for r in keyed) == bag(chunk_free)
        by_key = [r.name or "" for r in sorted(keyed, key=lambda r: r.key)]
        assert by_key == sorted(by_key)


def test_surrogate_keys_of_nothing(spark):
    assert ordering.surrogate_keys(spark.createDataFrame([], "a string"), "key", ["a"]).collect() == []


def test_large_order_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = ordering.globally_ordered(spark.range(5000).select((F.col("id") * 7 % 5000).alias("x")), [F.desc("x")], "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ordered.starts) > 1 and ordered.total == 5000
    assert all(r.x == 4999 - r[ordering.POSITION] for r in ordered.rows.collect())


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10)], "x string, n long")
    got = ordering.repeat_rows(df, "n", "i", chunk=10).collect()
    assert Counter(r.x for r in got) == {"a": 1, "b": 25, "c": 10}
    assert sorted(r.i for r in got if r.x == "b") == list(range(25))


def test_deep_pages_equal_early_pages(spark):
    df = spark.createDataFrame([(i // 4, i % 2) for i in range(200)], "a int, b int")
    order = [ordering.By("a", down=True), ordering.By("b")]
    for number in (1, 3, 20, 21):
        early = [tuple(r) for r in ordering.page(df, order, number, 10).collect()]
        deep = [tuple(r) for r in ordering.page(df, order, number, 10, Limits(deep_page_rows=0)).collect()]
        assert early == deep and len(early) == (10 if number <= 20 else 0)
    for bad in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            ordering.page(df, order, *bad)


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    for limits in (Limits(), SHUFFLE):
        assert bag(merge.upsert_by_key(old, new, ["k"], limits)) == {(1, "a"): 1, (2, "B"): 1, (3, "C"): 1}
        assert bag(merge.insert_if_absent(old, new, ["k"], limits)) == {(1, "a"): 1, (2, "b"): 1, (3, "C"): 1}
        assert bag(merge.delete_by_key(old, new, "k", limits)) == {(1, "a"): 1}
    twice = merge.upsert_by_key(merge.upsert_by_key(old, new, ["k"]), new, ["k"])
    assert bag(twice) == bag(merge.upsert_by_key(old, new, ["k"]))


EMPLOYEES = (
    "employee_key long, employee_id string, first_name string, last_name string, job_title string, department_key long,"
    " hire_date date, termination_date date, is_active int, start_date date, end_date date"
)


def test_employee_changes(spark):
    day = dt.date(2024, 1, 1)
    dim = spark.createDataFrame(
        [(i, f"e{i}", "f", "l", "job", 1, day, dt.date(2222, 12, 31), 1, day, None) for i in (1, 2, 3)], EMPLOYEES
    )
    changes = spark.createDataFrame(
        [(1, "Lead", True, None, False), (2, None, True, None, True)],
        "employee_key long, job_title string, set_job_title boolean, termination_date date, set_termination_date boolean",
    )
    rows = {r.employee_key: r for r in merge.update_employees(dim, changes).collect()}
    assert rows[1].job_title == "Lead" and rows[1].termination_date == dt.date(2222, 12, 31)
    assert rows[2].job_title is None and rows[2].termination_date is None
    assert rows[3].job_title == "job"
    with pytest.raises(ValueError):
        merge.update_employees(dim, spark.createDataFrame([(1, day, True)], "employee_key long, start_date date, set_start_date boolean"))
    new = spark.createDataFrame([("n1", day, None), ("n2", day, 0)], "employee_id string, start_date date, is_active int")
    added = {r.employee_id: r for r in merge.insert_employees(dim, new).collect()}
    assert (added["n1"].employee_key, added["n1"].is_active) == (4, 1)
    assert (added["n2"].employee_key, added["n2"].is_active) == (5, 0)
    with pytest.raises(ValueError):
        merge.insert_employees(dim, new.drop("start_date"))


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 30.0), ("b", None), (None, float("nan")), (None, -1.0)], "k string, h double")

    def one(measure):
        return tuple(measure.first())

    assert one(checks.duplicate_count(df, ["k"])) == (4,)  # NULL equals NULL
    assert one(checks.duplicate_count(df, ["absent"])) == (0,)
    assert one(checks.null_counts(df, ["k", "absent"])) == (2,)
    assert one(checks.numeric_range(df, "h", 0, 24)) == (1, 1, -1.0, 30.0)
    assert one(checks.numeric_range(df, "absent", 0, 24)) == (0, 0, None, None)
    texts = spark.createDataFrame([("25",), ("x",), ("-3",)], "h string")
    assert one(checks.numeric_range(texts, "h", 0, 24)) == (1, 1, -3.0, 25.0)
    days = spark.createDataFrame([("1999-12-31",), ("2024-01-01",), ("x",)], "d string")
    assert one(checks.date_range(days, "d", dt.date(2000, 1, 1))) == (1, 0, dt.date(1999, 12, 31), dt.date(2024, 1, 1))
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert one(checks.ref_integrity(df, parent, "k", "k")) == (1,)
    assert one(checks.ref_integrity(df, parent, "k", "absent")) == (0,)
    assert [r.orphan for r in checks.orphan_samples(df, parent, "k", "k").collect()] == ["b"]
    assert one(checks.row_count(df, "t", 6)) == ("t", 5, False)
