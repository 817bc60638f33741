"""Column functions against literal cases and plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftlens.functions import dates, numbers, text


def apply(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", function(F.col("v")).alias("r"))
    return [r.r for r in sorted(rows.collect(), key=lambda r: r.i)]


def test_clean_string(spark):
    cases = {
        '  "abc" ': "abc", "\"''x''\"": "x", '"NULL"': None, "Null": "Null", '" x "': " x ",
        "\tNA\t": None, ".": None, " y　": "y", "\x1cz\x1f": "z", "": None, '" "': None, '"   "': "   ",
    }
    assert apply(spark, text.clean_string, list(cases)) == list(cases.values())
    assert apply(spark, lambda c: text.clean_string(c, "UNKNOWN"), [None, "[null]", "a"]) == ["UNKNOWN", "UNKNOWN", "a"]


def test_clean_numeric(spark):
    cases = {"7.25": 7.25, '"8"': 8.0, "abc": 0.0, "--": 0.0, "1d": 0.0, None: 0.0, "-1.5": -1.5, "1e2": 100.0, ".5": 0.5, "inf": 0.0, "0x1": 0.0, '" 7 "': 7.0, "1e400": 0.0, "-1e400": 0.0, "1e-400": 0.0, "1_0": 0.0, "1,000": 0.0, "5f": 0.0}
    assert apply(spark, numbers.clean_numeric, list(cases)) == list(cases.values())


def test_clean_date(spark):
    day = dt.date(2024, 10, 28)
    cases = {
        '"2024-10-28"': day, " ": None, "[NULL]": None, "abc": None, None: None, "2024-10-28 09:30:00": day,
        "2024-10-28T09:30:00.5": day, "10/28/2024": None, "2024": None, "T09:30": None, "2024-02-30": None,
        "1500-01-01": None, "2500-01-01": None,
    }
    assert apply(spark, dates.clean_date, list(cases)) == list(cases.values())
    assert apply(spark, dates.clean_date_with_sentinel, [None, "2024-10-28"]) == [dt.date(2222, 12, 31), day]
    assert apply(spark, dates.is_active_flag, [None, "2024-10-28", "2222-12-31", "2222-12-31 08:00:00"]) == [1, 0, 1, 0]


def test_other_date_formats(spark):
    day = dt.date(2024, 10, 28)
    got = apply(spark, lambda c: dates.clean_date(c, ("MM/dd/yyyy", "yyyyMMdd")), ["10/28/2024", "20241028", "2024-10-28", "28/10/2024", None])
    assert got == [day, day, day, None, None]


def test_time_of_day(spark):
    moments = ["2024-03-10 02:30:00.000001", "2024-01-01 23:59:59.999999", None]
    got = apply(spark, lambda c: dates.time_of_day(c.cast("timestamp_ntz")), moments)
    assert got == [dt.timedelta(hours=2, minutes=30, microseconds=1), dt.timedelta(days=1, microseconds=-1), None]
    late = apply(spark, lambda c: dates.shift_clock(dates.clock_time(c), 5), ["09:00:00", "23:58:00", "nonsense"])
    assert late == [dt.timedelta(hours=9, minutes=5), dt.timedelta(minutes=3), None]
    early = apply(spark, lambda c: dates.shift_clock(dates.clock_time(c), -5), ["00:02:00"])
    assert early == [dt.timedelta(hours=23, minutes=57)]


def test_iso_week(spark):
    week = apply(spark, lambda c: dates.calendar_parts(c.cast("date"))["week"], ["2021-01-01", "2020-12-31", "2024-01-01"])
    assert week == [53, 53, 1]


def test_round_half_away(spark):
    got = apply(spark, lambda c: numbers.round_half_away(c.cast("double")), ["0.5", "-0.5", "2.5", "1.4", None])
    assert got == [1.0, -1.0, 3.0, 1.0, None]


LITERAL_CATEGORIES = {
    "EARLY_OUT": "EARLY OUT", "late in": "LATE IN", "VERY_LATE_IN": "LATE OUT", "MEAL_NOT_TAKEN": "UNSCHEDULED",
    "MISSED MEAL": "MEAL ISSUE", "Employee Missed In Punch": "MISSED PUNCH", "meal skipped": "MEAL ISSUE",
    "LATE_IN|MISSED_PUNCH": "LATE IN", "MISSED|FOO": "MISSED PUNCH", "MEAL|X": "MEAL ISSUE", "undefined": "OTHER",
    "hello": "OTHER", "--": "NA", None: "NA", '" "': "NA", '"  "': "OTHER", "VERY LATE": "LATE IN",
    "NO_PUNCH": "MISSED PUNCH", "SHORTSHIFT": "SHORT SHIFT", "deduction cancelled": "CANCELLED DEDUCTION",
}


def test_categories(spark):
    assert apply(spark, text.categorize_comment, list(LITERAL_CATEGORIES)) == list(LITERAL_CATEGORIES.values())


def expected_category(raw):
    """Plain reading of the rules: every keyword of every category, part by part for lists."""
    if raw is None:
        return "NA"
    comment = raw.strip().strip('"').strip("'").upper()
    if comment in text.COMMENT_PLACEHOLDERS:
        return "NA"

    def by_keyword(s):
        return next((c for c, words in text.COMMENT_KEYWORDS.items() if any(w in s for w in words)), None)

    if by_keyword(comment):
        return by_keyword(comment)
    if "MISSED" in comment and any(w in comment for w in ("PUNCH", "IN", "OUT")):
        return "MISSED PUNCH"
    if "MEAL" in comment and any(w in comment for w in ("NOT", "TAKEN", "SKIP", "MISSED")):
        return "MEAL ISSUE"
    if "|" in comment:
        found = set()
        for part in filter(None, (p.strip() for p in comment.split("|"))):
            category = by_keyword(part)
            if category:
                found.add(category)
            if not found:
                found |= {"MISSED PUNCH"} if "MISSED" in part else {"MEAL ISSUE"} if "MEAL" in part else set()
        if found:
            return ", ".join(sorted(found))
    return "OTHER"


def random_comments(n):
    rng = random.Random(7)
    words = sorted({w for ws in text.COMMENT_KEYWORDS.values() for w in ws} | {"MISSED", "MEAL", "IN", "OUT", "SKIP", "TAKEN", "X", "FOO", "O", "T", "_", "NA", "-"})
    pieces = [*words, *[w[:-1] for w in words], *[w[1:] for w in words]]
    return [rng.choice(["", " ", "|", "_", '"', "a"]).join(rng.choices(pieces, k=rng.randint(1, 3))).swapcase() for _ in range(n)]


def test_categories_of_random_comments(spark):
    comments = random_comments(20000)
    assert apply(spark, text.categorize_comment, comments) == [expected_category(c) for c in comments]


def test_second_pass_equals_categorizing_twice(spark):
    first = [*text.COMMENT_KEYWORDS, "OTHER", "NA", "", None]
    twice = apply(spark, text.categorize_comment, first)
    assert apply(spark, text.recategorize_comment, first) == twice
    assert {a: b for a, b in zip(first, twice) if a != b} == {"OTHER": "UNSCHEDULED", "": "NA", None: "NA"}


@pytest.mark.parametrize("category", list(text.COMMENT_KEYWORDS))
def test_every_keyword_stays_in_reach_of_its_rule(spark, category):
    words = list(text.COMMENT_KEYWORDS[category])
    assert apply(spark, text.categorize_comment, words) == [expected_category(w) for w in words]
