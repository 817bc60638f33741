"""Which format the dates of a file are written in, by a vote of its texts.

Of each file and date column the format that parses most texts is taken, ISO before the others and these in their
order where several parse as many, so the order of rows decides nothing. ISO texts are read in any file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_LIMITS, Limits
from ..functions.dates import timestamp_of
from ..functions.text import unquote, value_of
from ..operators.joins import sized_join
from .quality import WARNING, check_row

ISO = "ISO"
#: Formats tried besides ISO; a time of day may follow.
CANDIDATES = tuple(f"{day}[ HH:mm[:ss]]" for day in ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "yyyyMMdd"))
_FILE, _VOTED = "source_file", "__voted"


def _text(column: str) -> Column:
    """The text without quotes, NULL for a placeholder."""
    return value_of(unquote(F.col(column)))


def _parsed(text: Column, form: str) -> Column:
    return timestamp_of(text) if form == ISO else F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")


def tally(raw: DataFrame, columns: Sequence[str], formats: Sequence[str] = CANDIDATES) -> DataFrame:
    """One row a file: for each column a struct of the format that won, its texts, and how many of them are read.

    One aggregate, combined before its shuffle, so that a file of any size is no hot key.
    """
    forms = (ISO, *formats)
    texts = raw.select(_FILE, *[_text(c).alias(c) for c in columns])
    counts = [F.count(c).alias(f"{c} texts") for c in columns]
    for c in columns:
        iso = _parsed(F.col(c), ISO)
        # ISO texts are read whatever format wins.
        counts += [F.count(F.coalesce(iso, _parsed(F.col(c), f)) if f != ISO else iso).alias(f"{c} {i}") for i, f in enumerate(forms)]
    per_file = texts.groupBy(_FILE).agg(*counts)

    def winner(c: str) -> Column:
        best = F.array_max(F.array(*[F.struct(F.col(f"{c} {i}").alias("n"), F.lit(-i).alias("way")) for i in range(len(forms))]))
        name = F.element_at(F.array(*map(F.lit, forms)), 1 - best["way"])
        return F.struct(name.alias("format"), F.col(f"{c} texts").alias("n_texts"), best["n"].alias("n_parsed")).alias(c)

    return per_file.select(_FILE, *[winner(c) for c in columns])


def votes(tallied: DataFrame) -> DataFrame:
    """``(source_file, column, format, n_texts, n_parsed)`` of a tally."""
    columns = [c for c in tallied.columns if c != _FILE]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}.format"), F.col(f"{c}.n_texts"), F.col(f"{c}.n_parsed")) for c in columns]
    return tallied.select(_FILE, F.inline(F.array(*rows)))


def iso_dates(raw: DataFrame, tallied: DataFrame, formats: Sequence[str] = CANDIDATES, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The raw rows with dates in the format of their file written as ISO texts; all other texts stay as they are."""
    columns = [c for c in tallied.columns if c != _FILE]
    voted = tallied.select(_FILE, F.struct(*[F.col(f"{c}.format").alias(c) for c in columns]).alias(_VOTED))
    rows = sized_join(raw, voted, _FILE, "left", null_safe=True, limits=limits)

    def rewritten(c: str) -> Column:
        text = _text(c)
        read = F.coalesce(*[F.when(F.col(f"{_VOTED}.{c}") == f, _parsed(text, f)) for f in formats])
        return F.when(timestamp_of(text).isNull(), F.coalesce(read.cast("string"), F.col(c))).otherwise(F.col(c))

    return rows.withColumns({c: rewritten(c) for c in columns}).select(*raw.columns)


def report(table: str, layer: str, tallied: DataFrame) -> DataFrame:
    """A warning a column whose texts are not all read, as rows of the staging report."""
    columns = [c for c in tallied.columns if c != _FILE]
    unread = tallied.agg(*[F.coalesce(F.sum(F.col(f"{c}.n_texts") - F.col(f"{c}.n_parsed")), F.lit(0)).cast("long").alias(c) for c in columns])
    rows = [check_row(table, f"Unread Dates: {c}", F.col(c), F.concat(F.col(c).cast("string"), F.lit(" texts are no dates")), WARNING) for c in columns]
    return unread.select(F.inline(F.array(*rows))).withColumn("layer", F.lit(layer))
