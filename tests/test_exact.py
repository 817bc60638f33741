"""Rounded means of doubles against fractions of their shortest decimal forms."""

import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from shiftlens.functions import exact
from shiftlens.plans import kpi

EDGES = [0.49999999999, 0.5, 1.5, 2.5, 0.1, 0.2, 0.3, 0.7, 0.001, 0.002, 0.003, 1e-20, 1e-18, 1.2345678901234567e-5, 1e6, 1234567.8912345678, 1e16 + 2, 1e17, 1e20]


def rounded(values):
    mean = sum(Fraction(Decimal(repr(v))) for v in values) / len(values)
    whole = int(abs(mean) + Fraction(1, 2))
    return float(whole if mean >= 0 else -whole)


def test_rounded_means_equal_fractions(spark):
    rng, groups = random.Random(5), {}
    for g in range(3000):
        values = [rng.choice([1, -1]) * rng.choice([rng.choice(EDGES), rng.randrange(100) / 4, rng.random() * 10 ** rng.randrange(-12, 16)]) for _ in range(rng.randrange(1, 6))]
        if g % 3 == 0:  # large parts that cancel each other
            values += [-v for v in values] + [rng.choice([0.5, -0.5, 1.5, 0.49999999999, 1e-19])] * rng.randrange(1, 3)
        groups[g] = values
    groups |= {-1: [0.7, 0.3], -2: [-0.25], -3: [-0.0], -4: [0.49999999999], -5: [1e26, -1e26, 0.5], -6: [0.001, 0.002, -0.003, 0.5, -0.5]}
    rows = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(rows)
    numbers = spark.createDataFrame(rows, "g long, x double").withColumns({f"x_{n}": c for n, c in exact.pieces(F.col("x")).items()})
    added = numbers.groupBy("g").agg(*[c.alias(n) for n, c in exact.sums("x_").items()], F.count("*").alias("n"))
    for r in added.select("g", exact.rounded_mean("x_", F.col("n")).alias("mean")).collect():
        want = rounded(groups[r.g])
        assert r.mean == want or (abs(want) > 2**53 and abs(r.mean / want - 1) < 1e-15), groups[r.g]
        assert str(r.mean) != "-0.0"


def test_no_row_counts_without_its_hours(spark):
    values = {1: [8.0, 8.0, 1e30], 2: [0.49999999999], 3: [-0.25, None], 4: [8.0, 1e300, -1e300], 5: [None]}
    fact = spark.createDataFrame([(k, v) for k, hours in values.items() for v in hours], "employee_key long, hours_worked double")
    fact = fact.selectExpr("*", "DATE '2024-01-01' AS work_date", "CAST(NULL AS TIMESTAMP_NTZ) AS punch_in", "CAST(NULL AS TIMESTAMP_NTZ) AS punch_out")
    names = spark.createDataFrame([(k, f"e{k}", "f", "l") for k in values], "employee_key long, employee_id string, first_name string, last_name string")
    got = {r.employee_id: r.avg_daily_hours for r in kpi.avg_hours(fact, names).collect()}
    assert got == {"e1": 1e30 / 3, "e2": 0.0, "e3": 0.0, "e4": 3.0, "e5": 0.0}
    rolled = defaultdict(list)
    for r in kpi.rolling_avg_hours(fact, names).collect():
        rolled[r.employee_key].append(r.rolling_avg_7days)
    assert sorted(rolled[1]) == [8.0, 8.0, 1e30 / 3] and rolled[2] == [0.0] and rolled[5] == [None]
