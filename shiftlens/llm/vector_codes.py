"""Product codes of vectors, each part's nearest codebook entry found by Orchard search.

A vector is cut into equal parts, and each part position has a codebook. Orchard search keeps, for every entry, the
list of all entries by their distance from it. From a first guess it walks that entry's list; an entry nearer to the
part is jumped to, and its list is walked instead; marked entries aren't measured again. Once the list is beyond twice
the current distance, no entry further on can be nearer, by the triangle inequality. Distances are whole numbers, so
the search is exact, and entries as far as the current one are still reached, so ties go to the lower index.

Codebooks start as the parts of the first vectors by key. A round assigns all parts and replaces each entry by the
floored mean of its parts. Only the codebooks and their sums (a fixed number) pass through the driver.

Rows without a usable vector (null, empty, or with a null or non-finite component) are dropped. Vectors of different
sizes, sizes that the parts don't divide and components of 2**18 or more are errors. Rows with a null key are coded too
and start a codebook only when other rows don't suffice; repeated rows count as often as they occur. Fewer rows than
entries give smaller codebooks, an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.text import ship_code
from shiftlens.llm.vectors import usable, whole_steps


@dataclass(frozen=True)
class Shape:
    parts: int = 16
    entries: int = 64
    rounds: int = 2


class Neighbours:
    """The entries of one codebook, and for each of them all entries by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = ((entries[:, None] - entries[None]) ** 2).sum(-1)
        self.lists = np.argsort(between, axis=1, kind="stable")
        self.away = np.take_along_axis(between, self.lists, 1)
        self.by_first = np.argsort(entries[:, 0], kind="stable")

    def _guess(self, parts: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.entries[self.by_first, 0], parts[:, 0])
        return self.by_first[np.minimum(place, len(self.entries) - 1)]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry to each part, of equal ones the lowest."""
        rows, at = np.arange(len(parts)), self._guess(parts)
        distance = ((parts - self.entries[at]) ** 2).sum(1)
        marked = np.zeros((len(parts), len(self.entries)), bool)
        marked[rows, at] = True
        place, walking = np.zeros(len(parts), np.int64), rows
        while len(walking):
            here, step = at[walking], place[walking]
            within = self.away[here, step] <= 4 * distance[walking]
            walking, other = walking[within], self.lists[here[within], step[within]]
            place[walking] += 1
            fresh = ~marked[walking, other]
            rows, other = walking[fresh], other[fresh]
            marked[rows, other] = True
            measured = ((parts[rows] - self.entries[other]) ** 2).sum(1)
            nearer = (measured < distance[rows]) | ((measured == distance[rows]) & (other < at[rows]))
            rows = rows[nearer]
            at[rows], distance[rows], place[rows] = other[nearer], measured[nearer], 0
            walking = walking[place[walking] < len(self.entries)]
        return at, distance


def assign(vectors: np.ndarray, books: list[Neighbours]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part (columns) of each vector (rows)."""
    width = vectors.shape[1] // len(books)
    found = [book.nearest(vectors[:, p * width : (p + 1) * width]) for p, book in enumerate(books)]
    return np.stack([at for at, _ in found], 1), np.stack([d for _, d in found], 1)


def _summed(codebooks: np.ndarray):
    """Sums and counts of the parts of each entry, combined within a task."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Neighbours(book) for book in codebooks]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = whole_steps(batch.column("vector"), parts * width)
            at, _ = assign(vectors, books)
            for p in range(parts):
                np.add.at(sums[p], at[:, p], vectors[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(at[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        place = np.repeat(part * entries + entry, width)
        columns = [place, np.tile(np.arange(width), len(part)), sums[part, entry].ravel(), np.repeat(counts[part, entry], width)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["place", "within", "total", "n"])

    return run


def _improved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    sums = rows.select("vector").mapInArrow(_summed(codebooks), "place long, within long, total long, n long")
    out = codebooks.copy()
    for r in sums.groupBy("place", "within").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r.place // codebooks.shape[1], r.place % codebooks.shape[1], r.within] = r.total // r.n
    return out


def _coded(codebooks: np.ndarray):
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Neighbours(book) for book in codebooks]
        for batch in batches:
            at, distance = assign(whole_steps(batch.column("vector"), parts * width), books)
            codes = pa.array([row.tobytes() for row in at.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), codes, pa.array(distance.sum(1))], ["key", "label", "code", "error"])

    return run


def compress(vectors: DataFrame, shape: Shape = Shape(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(key, label, code, error)`` of each usable row, and the final codebooks (part, entry, component).

    ``code`` holds a byte a part, the index of its entry; ``error`` is the squared distance from the vector to its
    entries, in steps of 1/256.
    """
    if not 1 <= shape.entries <= 256:
        raise ValueError("a code byte tells 256 entries apart at most")
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(shape.entries).select("vector").toArrow().column("vector").combine_chunks()
    schema = f"key {rows.schema['key'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, code binary, error long"
    if not len(first):
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((shape.parts, 0, 0), np.int64)
    size = len(first[0])
    if size % shape.parts:
        raise ValueError(f"{size} components don't fall into {shape.parts} equal parts")
    codebooks = np.ascontiguousarray(whole_steps(first, size).reshape(len(first), shape.parts, -1).transpose(1, 0, 2))
    for _ in range(shape.rounds):
        codebooks = _improved(rows, codebooks)
    return rows.mapInArrow(_coded(codebooks), schema), codebooks
