"""Text cleaning and punch-comment categories."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Characters that count as blank at either end of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "no value". Matched as written, so "Null" is a value.
NULL_PLACEHOLDERS = (
    "[NULL]", "[null]", "NULL", "null", "None", "none", "N/A", "n/a", "NA", "na",
    "NaN", "nan", "", " ", "  ", "-", "--", ".", "undefined",
)

# Comments (in upper case) that mean "no comment".
COMMENT_PLACEHOLDERS = (
    "[NULL]", "NULL", "NONE", "N/A", "NA", "NAN", "", " ", "-", "--", ".",
)

# Keywords per category. The first category, in this order, with a
# keyword anywhere in the comment wins.
COMMENT_KEYWORDS = {
    "EARLY OUT": ("EARLY_OUT", "EARLY OUT", "EARLYOUT", "EARLY", "LEFT_EARLY", "LEFT EARLY"),
    "LATE OUT": ("LATE_OUT", "LATE OUT", "LATEOUT", "VERY_LATE_OUT", "VERY LATE OUT", "VERY_LATE"),
    "LATE IN": ("LATE_IN", "LATE IN", "LATEIN", "LATE", "VERY_LATE", "ARRIVED_LATE", "ARRIVED LATE"),
    "MISSED PUNCH": (
        "MISSED_PUNCH", "MISSED PUNCH", "MISSEDPUNCH", "MISSING_PUNCH", "FORGOT_PUNCH",
        "FORGOT PUNCH", "NO_PUNCH", "NO PUNCH", "IN_CHAIN", "IN CHAIN",
    ),
    "PTO": (
        "PTO", "PAID_TIME_OFF", "PAID TIME OFF", "VACATION", "PERSONAL_DAY", "PERSONAL DAY",
        "SICK", "SICK_DAY", "SICK DAY", "HOLIDAY", "LEAVE", "TIME_OFF", "TIME OFF",
    ),
    "UNSCHEDULED": (
        "UNSCHEDULED", "UN_SCHEDULED", "NOT_SCHEDULED", "NOT SCHEDULED",
        "EXTRA_SHIFT", "EXTRA SHIFT", "OVERTIME", "OT",
    ),
    "MEAL ISSUE": (
        "MEAL_NOT_TAKEN", "MEAL NOT TAKEN", "MEAL_ISSUE", "MEAL ISSUE",
        "NO_MEAL", "NO MEAL", "MISSED_MEAL", "MISSED MEAL",
    ),
    "SHORT SHIFT": ("SHORT_SHIFT", "SHORT SHIFT", "SHORTSHIFT", "PARTIAL_SHIFT", "PARTIAL SHIFT"),
    "CANCELLED DEDUCTION": (
        "CANCELLED_DEDUCTION", "CANCELLED DEDUCTION", "CANCELED_DEDUCT",
        "CANCELED DEDUCTION", "DEDUCTION_CANCELLED", "DEDUCTION CANCELLED",
    ),
}
OTHER, NO_COMMENT = "OTHER", "NA"


# A text that starts and ends with a character that is neither blank nor quote ("(" to "~").
_PLAIN = r"(?s)^[(-~](?:.*[(-~])?$"


def unquote(text: Column) -> Column:
    """Strip outer blanks, then outer double quotes, then outer single quotes.

    Most texts are plain at both ends and skip the slow strips. A missing text becomes
    empty, which means the same to all that follows; without NULLs the generated code of
    the cleaning steps stays small enough for the JIT compiler.
    """
    given = F.coalesce(text, F.lit(""))
    stripped = F.btrim(F.btrim(F.btrim(given, F.lit(BLANKS)), F.lit('"')), F.lit("'"))
    return F.when(given.rlike(_PLAIN), given).otherwise(stripped)


def value_of(bare: Column, default: str | None = None) -> Column:
    """Unquoted text, or the default in place of a placeholder."""
    return F.when(bare.isin(*NULL_PLACEHOLDERS), F.lit(default)).otherwise(bare)


def clean_string(text: Column, default: str | None = None) -> Column:
    return value_of(unquote(text), default)


# Parts shared by all deciding keywords of a category: without one, its pattern is not tried.
_SHARED_PARTS = {
    "LATE OUT": ["LATE"],
    "MISSED PUNCH": ["PUNCH", "CHAIN"],
    "MEAL ISSUE": ["MEAL"],
    "SHORT SHIFT": ["SHIFT"],
    "CANCELLED DEDUCTION": ["DEDUCT"],
}


def _contains(text: Column, word: str) -> Column:
    return F.contains(text, F.lit(word))


def _contains_any(text: Column, words: list[str]) -> Column:
    """One test for a word, one pattern for several: a test per word would make the generated
    code of two comment columns too large for the JIT compiler."""
    return _contains(text, words[0]) if len(words) == 1 else text.rlike("|".join(map(re.escape, words)))


def _mentions(text: Column, category: str, words: list[str]) -> Column:
    """Whether a keyword of the category occurs."""
    found = _contains_any(text, words)
    parts = [_contains(text, part) for part in _SHARED_PARTS.get(category, [])]
    return reduce(lambda a, b: a | b, parts) & found if parts else found


def _deciding_words() -> dict[str, list[str]]:
    """Keywords that can decide: a word around another word of its own or an earlier category cannot."""
    earlier: list[str] = []
    deciding = {}
    for category, words in COMMENT_KEYWORDS.items():
        deciding[category] = [w for w in words if not any(o != w and o in w for o in (*earlier, *words))]
        earlier += words
    return deciding


def category_of(normalized: Column) -> Column:
    """Category of an unquoted comment in upper case."""
    result = F.when(normalized.isin(*COMMENT_PLACEHOLDERS), NO_COMMENT)
    for category, words in _deciding_words().items():
        result = result.when(_mentions(normalized, category, words), category)
    missed, meal = _contains(normalized, "MISSED"), _contains(normalized, "MEAL")
    # Lists ("a|b") need no splitting: a keyword of a part is a keyword of the whole, so here
    # a part can only hold MISSED or MEAL, and a list with both is a meal issue already.
    return (
        result.when(missed & _contains_any(normalized, ["PUNCH", "IN", "OUT"]), "MISSED PUNCH")
        .when(meal & _contains_any(normalized, ["TAKEN", "SKIP", "MISSED", "|"]), "MEAL ISSUE")
        .when(missed & _contains(normalized, "|"), "MISSED PUNCH")
        .otherwise(OTHER)
    )


def categorize_comment(text: Column) -> Column:
    """Category of a raw comment, as one expression; ``categorize_columns`` is faster on many rows."""
    return category_of(F.upper(unquote(text)))


def categorize_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace raw comments by categories, preparing each text once for all its tests."""
    prepared = df.withColumns({c: F.upper(unquote(F.col(c))) for c in columns})
    return prepared.withColumns({c: category_of(F.col(c)) for c in columns})


def recategorize_comment(category: Column) -> Column:
    """``categorize_comment`` of a column that holds categories (or nothing) already.

    Categories map to themselves, except OTHER, which contains the keyword OT.
    """
    return (
        F.when(category.isNull() | (category == ""), NO_COMMENT)
        .when(category == OTHER, "UNSCHEDULED")
        .otherwise(category)
    )
