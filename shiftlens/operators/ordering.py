"""Positions in a global order, without bringing all rows into one task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import DEFAULT_LIMITS, Limits, scratch_path

PART, POSITION, COPIES = "__part", "__position", "__copies"


@dataclass(frozen=True)
class Ordered:
    """Rows in global order: the input columns plus ``__part`` and ``__position`` (from 0)."""

    rows: DataFrame
    starts: list[int]  # position of the first row of each part
    total: int
    has_copies: bool


def count_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row with its number of copies, combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def globally_ordered(df: DataFrame, order: list[Column], label: str) -> Ordered:
    """Range-partition, sort and number rows. A row counts ``__copies`` positions if it has that column.

    The sorted rows are written once to the shared scratch folder: range bounds come from
    a sample, so a second evaluation of the same plan could draw them elsewhere and number
    rows differently. Only the size of each partition reaches the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({PART: F.spark_partition_id(), POSITION: in_part})
        .write.parquet(path)
    )
    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType()), T.StructField(POSITION, T.LongType())])
    stored = spark.read.schema(schema).parquet(path)
    weight = F.col(COPIES) if COPIES in df.columns else F.lit(1)
    parts = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w")).collect()
    has_copies = any(p.n != p.w for p in parts)
    if has_copies:
        # Parts hold distinct rows and are of similar size, so a window per part is balanced.
        earlier = Window.partitionBy(PART).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
        stored = stored.withColumn(POSITION, F.coalesce(F.sum(COPIES).over(earlier), F.lit(0)))
    weights = {p[PART]: p.w for p in parts}
    starts = [0, *accumulate(weights.get(i, 0) for i in range(max(weights, default=-1) + 1))]
    total = starts.pop()
    if len(starts) > 1:
        first = F.expr(f"element_at(array({', '.join(f'{s}L' for s in starts)}), {PART} + 1)")
        stored = stored.withColumn(POSITION, F.col(POSITION) + first)
    return Ordered(stored, starts, total, has_copies)


def repeat_rows(df: DataFrame, times: str, number: str, chunk: int = 100_000) -> DataFrame:
    """Emit each row ``times`` times, numbered from 0.

    Long repeats are cut into chunks that spread over tasks before they grow.
    """
    steps = F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(chunk).cast("long"))
    chunks = df.withColumn("__from", F.explode(steps)).repartition("__from", *df.columns)
    last = F.least(F.col("__from") + chunk, F.col(times)) - 1
    return chunks.withColumn(number, F.explode(F.sequence("__from", last))).drop("__from", times)


def surrogate_keys(
    df: DataFrame, key: str, order: list[str], label: str = "keys", start: int = 0, distinct: bool = False
) -> DataFrame:
    """Add a dense key ``start + 1 .. start + n`` in the given order as the first column.

    All other columns follow in the order, so a frequent value of the order columns still
    spreads over partitions; exact copies travel as one row and get their keys at the end.
    ``distinct`` promises that there are no copies, which saves a shuffle.
    """
    full = [F.col(c) for c in [*order, *(c for c in df.columns if c not in order)]]
    ordered = globally_ordered(df if distinct else count_copies(df), full, label)
    rows, number = ordered.rows, F.col(POSITION)
    if ordered.has_copies:
        rows = repeat_rows(ordered.rows, COPIES, "__copy")
        number = number + F.col("__copy")
    return rows.select((number + F.lit(start + 1)).cast("long").alias(key), *df.columns)


# Pages


@dataclass(frozen=True)
class By:
    """A column to order by. NULL is the smallest value: first upwards, last downwards."""

    name: str
    down: bool = False

    def column(self) -> Column:
        return F.col(f"`{self.name}`").desc_nulls_last() if self.down else F.col(f"`{self.name}`").asc_nulls_first()

    def turned(self) -> By:
        return By(self.name, not self.down)


def _slice(df: DataFrame, order: list[By], skip: int, size: int) -> DataFrame:
    """A top-k with an offset; without an order the rows are copies, and any of them will do."""
    return df.orderBy(*[b.column() for b in order]).offset(skip).limit(size) if order else df.limit(size)


def _cuts(df: DataFrame, name: str, limits: Limits) -> list:
    """Values of a few rows drawn at random, different and in order, to cut the column at; whichever they are, pages are right."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = (column + 0).cast(kind)  # zero without a sign
    drawn = df.select(column.alias("cut")).where("cut IS NOT NULL").orderBy(F.rand()).limit(limits.page_cuts)
    return drawn.agg(F.array_sort(F.collect_set("cut"))).first()[0]


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(str(value) if isinstance(kind, T.TimestampNTZType) else value).cast(kind)


def _stretch(column: Column, cuts: list[Column], first: int, last: int) -> Column:
    """The rows of buckets ``first`` to ``last``: -1 holds NULL, 2 i + 1 the cut i, 2 i what lies below it."""
    within = F.lit(True)
    if first > 0:
        within = within & (column >= cuts[first // 2] if first % 2 else column > cuts[first // 2 - 1])
    if last < 2 * len(cuts):
        within = within & (column <= cuts[last // 2] if last % 2 else column < cuts[last // 2]) if last >= 0 else F.lit(False)
    return column.isNull() | within if first < 0 else column.isNotNull() & within


def _pieces(df: DataFrame, order: list[By], skip: int, size: int, total: int, limits: Limits) -> list[DataFrame]:
    """Rows ``skip`` to ``skip + size`` of ``total``, in pieces, each of them small."""
    if size <= 0:
        return []
    if size == total:
        return [df]
    if not order or skip + size <= limits.deep_page_rows:
        return [_slice(df, order, skip, size)]
    if total - skip <= limits.deep_page_rows:
        return [_slice(df, [b.turned() for b in order], total - skip - size, size)]
    lead, rest = order[0], order[1:]
    values = _cuts(df, lead.name, limits)
    if not values:
        return _pieces(df, rest, skip, size, total, limits)
    column, kind = F.col(f"`{lead.name}`"), df.schema[lead.name].dataType
    cuts = [_literal(v, kind) for v in values]
    known = F.array(*cuts)
    bucket = F.size(F.filter(known, lambda c: c < column)) + F.size(F.filter(known, lambda c: c <= column))
    counts = df.groupBy(F.when(column.isNull(), -1).otherwise(bucket).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    ordered = sorted(((r.bucket, r.n) for r in counts), reverse=lead.down)
    starts = [0, *accumulate(n for _, n in ordered)]
    met = [i for i, (_, n) in enumerate(ordered) if starts[i] < skip + size and starts[i] + n > skip]

    def taken(some: list[int]) -> list[DataFrame]:
        """What the page has of a run of buckets."""
        ends = sorted((ordered[some[0]][0], ordered[some[-1]][0]))
        begin, end = starts[some[0]], starts[some[-1] + 1]
        one_value = len(some) == 1 and ends[0] % 2
        rows = df.where(_stretch(column, cuts, *ends))
        from_, to = max(skip, begin), min(skip + size, end)
        return _pieces(rows, rest if one_value else order, from_ - begin, to - from_, end - begin, limits)

    # Buckets between the first and the last one belong to the page as a whole.
    groups = [met] if len(met) < 2 or starts[met[-1] + 1] - starts[met[0]] <= limits.deep_page_rows else [met[:1], met[1:-1], met[-1:]]
    return [piece for group in groups if group for piece in taken(group)]


def page(df: DataFrame, order: list[By], number: int = 1, size: int = 20, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows of one page of a table with atomic columns.

    Early pages, and late ones counted from the end, are a top-k. All others are found by counts: the first column is cut
    at a few of its values, rows are counted between the cuts, and only the stretch that holds the page is looked
    at again, down to the next columns where a value is frequent. Nothing is shuffled, sorted or written but
    the stretch at the end; each look is a scan of one column, with the bounds of the stretch pushed to it.

    The order is completed by all columns, so that only exact copies tie: pages neither lose nor repeat a row,
    whichever way each of them is found.
    """
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("page numbers start at 1 and a page has 1 to 100 rows")
    named = {b.name for b in order}
    order = [*order, *(By(c) for c in df.columns if c not in named)]
    skip = (number - 1) * size
    if skip + size <= limits.deep_page_rows:
        return _slice(df, order, skip, size)
    total = df.count()
    pieces = _pieces(df, order, skip, min(size, total - skip), total, limits) or [df.limit(0)]
    return reduce(DataFrame.unionByName, pieces).orderBy(*[b.column() for b in order])
