"""The nine workforce KPIs over the star schema.

Counts and averages are formed per key before any join, so joins see one row a key and
no employee is too large for a task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULT_LIMITS, GRACE_MINUTES, TERMINATION_SENTINEL, Limits
from ..functions.dates import clock_time, days_between, minutes, shift_clock, time_of_day
from ..functions.exact import pieces, rounded_mean, sums
from ..functions.numbers import round_half_away
from ..operators.joins import sized_join
from ..operators.ordering import COPIES, PART, POSITION, count_copies, globally_ordered, repeat_rows
from ..operators.sizing import hot_keys, is_one_of

_NAMES = ("employee_id", "first_name", "last_name")


def _terminated(dim_employee: DataFrame, sentinel: dt.date) -> DataFrame:
    return dim_employee.where(F.col("termination_date") != F.lit(sentinel))


def active_headcount(
    dim_employee: DataFrame, dim_date: DataFrame, sentinel: dt.date = TERMINATION_SENTINEL, active_only: bool = True
) -> DataFrame:
    """KPI 1: distinct employees employed on each date, without comparing employees to dates.

    Each employment adds one at its start and takes one away after its end; the running sum
    of these steps is the headcount. Steps are summed per day first, so the running sum
    has at most one row for each day of the calendar.
    """
    usable = F.col("hire_date").isNotNull() & F.col("employee_id").isNotNull() & F.col("termination_date").isNotNull()
    if active_only:
        usable = usable & (F.col("is_active") == 1)
    open_end = F.lit(dt.date(9999, 12, 30))
    end = F.when(F.col("termination_date") == F.lit(sentinel), open_end).otherwise(F.col("termination_date"))
    # At most one span for each employee and day of the calendar, whatever the copies.
    spans = (
        dim_employee.where(usable)
        .select("employee_id", F.col("hire_date").alias("start"), end.alias("end"))
        .where(F.col("end") >= F.col("start"))
        .groupBy("employee_id", "start")
        .agg(F.max("end").alias("end"))
    )
    earlier = Window.partitionBy("employee_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max("end").over(earlier)
    # Only the part of a span that no earlier span of the employee covers counts.
    added = spans.select(
        F.greatest("start", F.date_add(covered, 1)).alias("start"), F.col("end"), covered.alias("covered")
    ).where(F.col("covered").isNull() | (F.col("end") > F.col("covered")))
    steps = added.select(
        F.inline(F.array(
            F.struct(F.col("start").alias("day"), F.lit(1).alias("step")),
            F.struct(F.date_add("end", 1).alias("day"), F.lit(-1).alias("step")),
        ))
    ).groupBy("day").agg(F.sum("step").alias("step"))
    marks = steps.withColumn("asked", F.lit(False)).unionByName(
        dim_date.select(F.col("work_date").alias("day"), F.lit(0).cast("long").alias("step"), F.lit(True).alias("asked"))
    )
    per_day = marks.groupBy("day").agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    until = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_day.withColumn("active_headcount", F.sum("step").over(until))
        .where(F.col("asked") & (F.col("active_headcount") > 0))
        .select(F.col("day").alias("work_date"), "active_headcount")
        .orderBy("work_date")
    )


def turnover_trend(dim_employee: DataFrame, sentinel: dt.date = TERMINATION_SENTINEL) -> DataFrame:
    """KPI 2: terminations per year."""
    return (
        _terminated(dim_employee, sentinel)
        .groupBy(F.year("termination_date").alias("termination_year"))
        .agg(F.count(F.lit(1)).alias("total_terminated"))
        .orderBy("termination_year")
    )


def avg_tenure(dim_employee: DataFrame, dim_department: DataFrame, sentinel: dt.date = TERMINATION_SENTINEL) -> DataFrame:
    """KPI 3: mean of whole years employed, per department, of the terminated."""
    per_key = (
        _terminated(dim_employee, sentinel)
        .withColumn("years", F.expr("datediff(termination_date, hire_date) div 365"))
        .groupBy("department_key")
        .agg(F.sum("years").alias("years"), F.count("years").alias("n"))
    )
    return (
        per_key.join(dim_department.select("department_key", "department_id", "department_name"), "department_key")
        .groupBy("department_name", "department_id")
        .agg(round_half_away(F.try_divide(F.sum("years").cast("double"), F.sum("n"))).alias("avg_tenure_years"))
        .orderBy("department_id", "department_name")
    )


def _by_name(per_key: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Rows per employee key, grouped by the names of the employee."""
    return per_key.join(dim_employee.select("employee_key", *_NAMES), "employee_key").groupBy(*_NAMES)


_HOURS = "__hours_"


def _with_hours(rows: DataFrame, hours: Column) -> DataFrame:
    """The pieces of the hours, which add up without loss in any order of rows."""
    return rows.withColumns({f"{_HOURS}{name}": piece for name, piece in pieces(hours).items()})


def avg_hours(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """KPI 4: mean hours per fact row."""
    hours = _with_hours(fact.select("employee_key", F.coalesce(F.col("hours_worked"), F.lit(0.0)).alias("hours_worked")), F.col("hours_worked"))
    added = [c.alias(name) for name, c in sums(_HOURS).items()]
    per_key = hours.groupBy("employee_key").agg(*added, F.count(F.lit(1)).alias("n"))
    per_name = _by_name(per_key, dim_employee).agg(*added, F.sum("n").alias("n"))
    return per_name.select(*_NAMES, rounded_mean(_HOURS, F.col("n")).alias("avg_daily_hours")).orderBy(F.desc("avg_daily_hours"))


def _count_where(fact: DataFrame, condition: Column, name: str) -> DataFrame:
    """Rows per employee key that meet the condition.

    Counted by a conditional aggregate: as a filter the condition would move below the
    projections it builds on and have their expressions evaluated twice.
    """
    return fact.groupBy("employee_key").agg(F.count_if(condition).alias(name)).where(F.col(name) > 0)


def _days_per_employee(fact: DataFrame, condition: Column, dim_employee: DataFrame, name: str) -> DataFrame:
    per_key = _count_where(fact, condition, "n")
    return _by_name(per_key, dim_employee).agg(F.sum("n").alias(name)).orderBy(F.desc(name))


def _times(fact: DataFrame, **columns: Column) -> DataFrame:
    """Times of day in a projection of their own, so that each is parsed once a row."""
    return fact.select("employee_key", "work_date", *[c.alias(name) for name, c in columns.items()])


def late_arrivals(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """KPI 5: punches in more than the grace period after the scheduled start."""
    times = _times(fact, came=time_of_day(F.col("punch_in")), due=clock_time(F.col("scheduled_start")))
    late = F.col("came") > shift_clock(F.col("due"), GRACE_MINUTES)
    return _days_per_employee(times, late, dim_employee, "late_days")


def early_departures(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """KPI 6: punches out more than the grace period before the scheduled end."""
    times = _times(fact, left=time_of_day(F.col("punch_out")), due=clock_time(F.col("scheduled_end")))
    early = F.col("left") < shift_clock(F.col("due"), -GRACE_MINUTES)
    return _days_per_employee(times, early, dim_employee, "early_departure_days")


def overtime(fact: DataFrame) -> DataFrame:
    """KPI 7: shifts longer than scheduled plus grace. Times of day are compared, so overnight shifts are negative."""
    times = _times(
        fact,
        worked=time_of_day(F.col("punch_out")) - time_of_day(F.col("punch_in")),
        scheduled=clock_time(F.col("scheduled_end")) - clock_time(F.col("scheduled_start")),
    )
    longer = F.col("work_date").isNotNull() & (F.col("worked") > F.col("scheduled") + minutes(GRACE_MINUTES))
    return _count_where(times, longer, "overtime_count").orderBy(F.desc("overtime_count"))


_ROLLING_ORDER = ("work_date", "punch_in", "punch_out", "hours_worked")
_ROLLING_COLUMNS = ("employee_key", "first_name", "last_name", "work_date", "punch_in", "rolling_avg_7days")
_FRAME_ROWS = 7


def _with_rolling_mean(rows: DataFrame, *partition: str, order: list[Column]) -> DataFrame:
    """``rolling_avg_7days`` of the row and the six before it; a frame without hours has none."""
    frame = Window.partitionBy(*partition).orderBy(*order).rowsBetween(1 - _FRAME_ROWS, Window.currentRow)
    within = sums(_HOURS, lambda c: c.over(frame)) | {"__n": F.count("hours_worked").over(frame)}
    framed = _with_hours(rows, F.col("hours_worked")).select(*rows.columns, *[c.alias(name) for name, c in within.items()])
    return framed.select(*rows.columns, rounded_mean(_HOURS, F.col("__n")).alias("rolling_avg_7days"))


def _rolling_of_hot(fact: DataFrame) -> DataFrame:
    """Rolling means of employees with too many rows for one task.

    Copies of a row travel once: beyond the seventh all have the same mean. The rows are
    split along the global order, and each split borrows the six rows before it.
    """
    runs = count_copies(fact)
    shown = F.least(F.col(COPIES), F.lit(_FRAME_ROWS).cast("long"))
    single = runs.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), shown))).withColumn(
        "__times", F.when(F.col("__copy") == _FRAME_ROWS, F.col(COPIES) - (_FRAME_ROWS - 1)).otherwise(F.lit(1).cast("long"))
    ).drop(COPIES, "__copy")
    order = [F.col("employee_key"), *[F.col(c).asc_nulls_first() for c in _ROLLING_ORDER], F.col("__times").asc()]
    ordered = globally_ordered(single, order, "rolling")
    spark = fact.sparkSession
    borrowed = [
        (position, part)
        for part, start in enumerate(ordered.starts)
        for position in range(max(0, start - _FRAME_ROWS + 1), start)
    ]
    lenders = spark.createDataFrame(borrowed, f"{POSITION} long, __to int")  # six rows a split
    before = (
        ordered.rows.join(F.broadcast(lenders), POSITION)
        .withColumns({PART: F.col("__to"), "__times": F.lit(0).cast("long")})
        .drop("__to")
    )
    rows = ordered.rows.unionByName(before)
    wanted = _with_rolling_mean(rows, PART, "employee_key", order=[F.col(POSITION)]).where(F.col("__times") > 0)
    return repeat_rows(wanted, "__times", "__copy").select("employee_key", "work_date", "punch_in", "rolling_avg_7days")


def rolling_avg_hours(
    fact: DataFrame, dim_employee: DataFrame, ordered: bool = False, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """KPI 8: mean hours of the last seven rows of the employee, for every fact row.

    The result is as large as the fact; ``ordered`` sorts it for display.
    """
    punches = fact.select("employee_key", *_ROLLING_ORDER)
    names = dim_employee.select("employee_key", "first_name", "last_name")
    hot = hot_keys(punches, "employee_key", limits)
    is_hot = is_one_of("employee_key", hot)
    order = [F.col(c).asc_nulls_first() for c in _ROLLING_ORDER]
    cold = _with_rolling_mean(punches.where(~is_hot) if hot else punches, "employee_key", order=order)
    # A shuffle join on the key finds the rows where the window has put them.
    result = sized_join(cold, names, "employee_key", hot={}, limits=limits).select(*_ROLLING_COLUMNS)
    if hot:
        rolled = _rolling_of_hot(punches.where(is_hot))
        few = names.where(is_hot)  # one row a key, so small enough to broadcast
        rolled = sized_join(rolled, few, "employee_key", hot={}, limits=limits)
        result = result.unionByName(rolled.select(*_ROLLING_COLUMNS))
    return result.orderBy("employee_key", "work_date") if ordered else result


def early_attrition(dim_employee: DataFrame, sentinel: dt.date = TERMINATION_SENTINEL, within_days: int = 90) -> DataFrame:
    """KPI 9: percentage of the terminated who left within 90 days; NULL when nobody has left."""
    early = F.count_if(days_between(F.col("hire_date"), F.col("termination_date")) <= within_days)
    rate = F.try_divide(early.cast("double"), F.count(F.lit(1))) * 100
    return _terminated(dim_employee, sentinel).agg(F.round(rate, 2).alias("early_attrition_rate_percentage"))
