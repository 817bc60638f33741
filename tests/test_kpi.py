"""KPIs against brute force on small tables with awkward rows."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from shiftlens.config import REPORT_SENTINEL, TERMINATION_SENTINEL, Limits
from shiftlens.plans import kpi

DAY0 = dt.date(2024, 1, 1)
EMPLOYEE = (
    "employee_key long, employee_id string, first_name string, last_name string, department_key long,"
    " hire_date date, termination_date date, is_active int"
)
FACT = "employee_key long, work_date date, punch_in timestamp_ntz, punch_out timestamp_ntz, scheduled_start string, scheduled_end string, hours_worked double"


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def employees():
    rng = random.Random(3)
    rows = []
    for key in range(1, 161):
        # Few ids, so that spans of one id overlap, touch, repeat and nest.
        employee_id = rng.choice(["UNKNOWN"] * 6 + [str(i) for i in range(12)] + [None])
        hire = None if rng.random() < 0.05 else day(rng.randint(0, 60))
        end = rng.choice([TERMINATION_SENTINEL, REPORT_SENTINEL, None, day(rng.randint(0, 70)), day(rng.randint(0, 70))])
        rows.append((key, employee_id, f"f{key % 5}", "l", rng.choice([1, 2, None]), hire, end, rng.choice([0, 1, None])))
    return rows


@pytest.mark.parametrize("sentinel", [TERMINATION_SENTINEL, REPORT_SENTINEL])
@pytest.mark.parametrize("active_only", [True, False])
def test_headcount_equals_comparing_every_employee_to_every_date(spark, employees, sentinel, active_only):
    dates = [day(n) for n in range(-2, 75, 3)]
    expected = {}
    for d in dates:
        ids = {
            e[1] for e in employees
            if e[1] is not None and (e[7] == 1 or not active_only) and e[5] is not None and d >= e[5]
            and e[6] is not None and (e[6] == sentinel or d <= e[6])
        }
        if ids:
            expected[d] = len(ids)
    dim_date = spark.createDataFrame([(d,) for d in dates], "work_date date")
    got = kpi.active_headcount(spark.createDataFrame(employees, EMPLOYEE), dim_date, sentinel, active_only)
    assert {r.work_date: r.active_headcount for r in got.collect()} == expected


def shifts():
    """One employee with most rows, many of them exact copies, and some small ones."""
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        key = rng.choice([1, 1, 1, 2, 3])
        start = dt.datetime(2024, 1, rng.randint(1, 20), rng.randint(0, 23), rng.choice([0, 4, 6]))
        rows.append((
            key, start.date() if rng.random() > 0.03 else None, start if rng.random() > 0.1 else None,
            start + dt.timedelta(hours=rng.randint(1, 12)) if rng.random() > 0.1 else None,
            "09:00:00", "17:00:00", rng.choice([None, -0.3, 0.0, 4.25, 7.75, 8.5, 12.0]),
        ))
    return rows + [(1, day(3), dt.datetime(2024, 1, 4, 9), None, "09:00:00", "17:00:00", 11.5)] * 90 + [(2, day(3), None, None, "09:00:00", "17:00:00", 3.5)] * 5


def names(spark, keys):
    return spark.createDataFrame([(k, f"e{k}", f"f{k}", "l", 1, DAY0, TERMINATION_SENTINEL, 1) for k in keys], EMPLOYEE)


def half_away(x):
    return float(int(abs(x) + 0.5)) * (1 if x >= 0 else -1)


def expected_rolling(rows):
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[0]].append(r)
    out = Counter()
    for key, mine in by_key.items():
        first = (dt.date.min, dt.datetime.min)
        mine.sort(key=lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[1], r[2], r[3], r[6])))
        for i, r in enumerate(mine):
            hours = [h[6] for h in mine[max(0, i - 6): i + 1] if h[6] is not None]
            mean = half_away(round(sum(hours) / len(hours), 9)) if hours else None
            out[key, f"f{key}", r[1], r[2], None if mean is None else mean + 0.0] += 1
    return out


@pytest.mark.parametrize("limits", [Limits(), Limits(hot_rows=100), Limits(hot_rows=20, broadcast_bytes=0)])
@pytest.mark.parametrize("splits", [None, 64])
def test_rolling_mean_by_every_strategy(spark, limits, splits):
    rows = shifts()
    if splits:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = kpi.rolling_avg_hours(spark.createDataFrame(rows, FACT).repartition(5), names(spark, (1, 2, 3)), limits=limits).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counted = Counter(
        (r.employee_key, r.first_name, r.work_date, r.punch_in, None if r.rolling_avg_7days is None else r.rolling_avg_7days + 0.0)
        for r in got
    )
    assert counted == expected_rolling(rows)


def test_punctuality(spark):
    def fact(clock_in, clock_out, start="09:00:00", end="17:00:00"):
        at = lambda t: dt.datetime.combine(DAY0, dt.time.fromisoformat(t)) if t else None
        return spark.createDataFrame([(1, DAY0, at(clock_in), at(clock_out), start, end, 8.0)], FACT)

    one = names(spark, (1,))
    late = lambda t, **k: kpi.late_arrivals(fact(t, None, **k), one).count()
    early = lambda t, **k: kpi.early_departures(fact(None, t, **k), one).count()
    over = lambda a, b: kpi.overtime(fact(a, b)).count()
    assert [late("09:05:00"), late("09:05:00.000001"), late("08:59:00"), late(None)] == [0, 1, 0, 0]
    assert [early("16:55:00"), early("16:54:59.999999"), early("17:30:00"), early(None)] == [0, 1, 0, 0]
    assert late("00:10:00", start="23:58:00") == 1  # the limit wraps to 00:03
    assert early("23:50:00", end="00:02:00") == 1  # the limit wraps to 23:57
    assert [over("09:00:00", "17:05:00"), over("09:00:00", "17:05:01"), over("22:00:00", "07:00:00"), over(None, "20:00:00")] == [0, 1, 0, 0]


def test_averages_and_attrition(spark, employees):
    facts = spark.createDataFrame(shifts(), FACT)
    got = {r.employee_id: r.avg_daily_hours for r in kpi.avg_hours(facts, names(spark, (1, 2, 3))).collect()}
    for key in (1, 2, 3):
        hours = [r[6] or 0.0 for r in shifts() if r[0] == key]
        assert got[f"e{key}"] == half_away(sum(hours) / len(hours))
    dim = spark.createDataFrame(employees, EMPLOYEE)
    gone = [e for e in employees if e[6] is not None and e[6] != TERMINATION_SENTINEL]
    early = sum(1 for e in gone if e[5] and (e[6] - e[5]).days <= 90)
    assert kpi.early_attrition(dim).first()[0] == pytest.approx(round(early / len(gone) * 100, 2))
    assert kpi.early_attrition(dim.limit(0)).first()[0] is None
    years = Counter(e[6].year for e in gone)
    assert {r.termination_year: r.total_terminated for r in kpi.turnover_trend(dim).collect()} == years
    departments = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "department_key long, department_id string, department_name string")
    tenure = {r.department_id: r.avg_tenure_years for r in kpi.avg_tenure(dim, departments).collect()}
    for key, name in ((1, "a"), (2, "b")):
        spans = [int((e[6] - e[5]).days / 365) for e in gone if e[4] == key and e[5]]
        assert tenure[name] == half_away(sum(spans) / len(spans))
