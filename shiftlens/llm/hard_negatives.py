"""Hard negatives by threshold joins over an inverted index of vector dimensions, in the manner of L2AP.

Anchors are searched against all rows in blocks. A block's dimensions are ordered by their weight, and its postings
leave out the last dimensions of a row where the norms of what follows show that these alone can't reach the lowest
threshold. Scores of anchors and rows are accumulated posting by posting; a pair is dropped as soon as its partial
score and the norms that remain stay below the anchor's threshold. Pairs that are left get their exact score.

An anchor starts with a high threshold, which is lowered until its windows are full: one window for its positives,
then one for each positive, between ``least_percent`` of the positive's score and that score. A full window's last
score is the threshold for further blocks. Each task keeps full windows of its rows only, and the windows of all tasks
are merged, so a few rows an anchor and task are shuffled, whatever the labels' sizes.

Anchors are a stated share of the rows: they go to the tasks in slices of about ``anchors_at_once``, each in two
passes over the rows, and each slice's result is stored. Bounds are rounded upwards; scores are exact in 64 bits.

Rows without key or label, and without a usable vector (null, empty, with a null or non-finite component), take no
part. Rows with an anchor's key are not its partners. Anchors that repeat in key, label and vector are one; other
repeated rows count as often as they occur; ties go to the smaller key. Vectors of different sizes and components of
2**18 or more are errors. An anchor without positives, or a positive without negatives, gives no row; an empty table
gives none. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlens.llm.text import shared_folder, ship_code, stored
from shiftlens.llm.vectors import usable, whole_steps


@dataclass(frozen=True)
class Mining:
    """How many partners, and negatives from which share of a positive's score on; slices of anchors and blocks of rows."""

    positives: int = 5
    negatives: int = 5
    least_percent: int = 80
    anchors_at_once: int = 1024
    block_rows: int = 4096


LOWEST, HIGHEST = -(1 << 62), 1 << 62
#: Thresholds of windows that are not full, as shares of the highest possible score; then all that a window takes.
LEVELS = (0.9, 0.6, 0.3, None)
#: Dimensions between two prunings, as shares of all, and pairs scored at once.
PRUNED_AT, PAIRS = (0.5, 0.75, 1.0), 1 << 16
FOUND = "anchor int, slot int, id long, score long"


class Index:
    """Postings of a block of rows by dimension, the heaviest dimension first."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        plain = rows.astype(np.float64)
        self.order = np.argsort(-(plain * plain).sum(0), kind="stable")
        self.y = plain[:, self.order]
        self.rest = remaining_norms(self.y)
        self.largest = float(self.rest[:, 0].max(initial=0.0))

    def reach(self, x: np.ndarray, x_rest: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of anchor and row whose score may be ``least`` of the anchor or more; dimensions of ``x`` are in ``order``."""
        size = x.shape[1]
        lowest = least.min()
        # From here on a row's dimensions can't reach the threshold without the ones before.
        omitted = self.rest * x_rest.max(0) * (1 + 1e-9) < lowest
        held = np.where(omitted.any(1), omitted.argmax(1), size)
        columns = np.argsort(-held, kind="stable")
        held = held[columns]
        columns, held = columns[held > 0], held[held > 0]
        postings = np.where(np.arange(size) < held[:, None], self.y[columns], 0.0)
        score = np.zeros((len(x), len(columns)))
        slack = 1e-9 * x_rest[:, :1] * self.rest[columns, 0] + 1e-6
        done, alive = 0, np.ones(score.shape, bool)
        for after in sorted({max(1, round(share * size)) for share in PRUNED_AT}):
            score += x[:, done:after] @ postings[:, done:after].T
            counted = np.minimum(after, held)
            bound = score + x_rest[:, counted] * self.rest[columns, counted] + slack
            alive = bound >= least[:, None]
            kept = alive.any(0)
            if not kept.all():
                score, alive, slack = score[:, kept], alive[:, kept], slack[:, kept]
                columns, held, postings = columns[kept], held[kept], postings[kept]
            done = after
        i, j = np.nonzero(alive)
        return i, columns[j]


def remaining_norms(rows: np.ndarray) -> np.ndarray:
    """The norm of each row from every dimension on, and 0 after the last."""
    squares = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1))


class Windows:
    """The best partners so far: window ``w`` of ``anchor[w]`` takes scores from ``low[w]`` to ``high[w]``."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, anchors: int, size: int):
        self.anchor, self.low, self.high, self.size, self.anchors = anchor, low, high, size, anchors
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(len(anchor), LOWEST)
        self.of = np.argsort(anchor, kind="stable")
        self.first = np.searchsorted(anchor[self.of], np.arange(anchors + 1))

    def least(self) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor the lowest score that a window may still take, and whether all its windows are full."""
        least, full = np.full(self.anchors, HIGHEST), np.ones(self.anchors, bool)
        np.minimum.at(least, self.anchor, np.maximum(self.low, self.last))
        np.logical_and.at(full, self.anchor, self.last > LOWEST)
        return least, full

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        times = np.diff(self.first)[anchor]
        pair = np.repeat(np.arange(len(anchor)), times)
        window = self.of[self.first[anchor][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)]
        fits = (score[pair] >= np.maximum(self.low, self.last)[window]) & (score[pair] <= self.high[window])
        window, pair = window[fits], pair[fits]
        window, score, ids = (np.concatenate(c) for c in ((self.window, window), (self.score, score[pair]), (self.id, ids[pair])))
        order = np.lexsort((ids, -score, window))
        window, score, ids = window[order], score[order], ids[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        best = rank < self.size
        self.last[window[rank == self.size - 1]] = score[rank == self.size - 1]
        self.window, self.score, self.id = window[best], score[best], ids[best]


@dataclass(frozen=True)
class Anchors:
    """A slice of anchors with their windows."""

    ids: np.ndarray
    labels: list[str]
    vectors: np.ndarray
    window_anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def search(self, same: bool, size: int, block_rows: int):
        """Fill windows of ``size`` from rows of the anchor's label, or else from rows of other labels."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = Windows(self.window_anchor, self.low, self.high, len(self.ids), size)
            codes = {name: code for code, name in enumerate(dict.fromkeys(self.labels))}
            labels = np.array([codes[name] for name in self.labels], np.int64)
            for batch in batches:
                rows = whole_steps(batch.column("vector"), self.vectors.shape[1])
                ids = batch.column("id").to_numpy()
                kinds = np.array([codes.get(name, -1) for name in batch.column("label").to_pylist()], np.int64)
                for first in range(0, len(rows), block_rows):
                    part = slice(first, first + block_rows)
                    self._scan(Index(rows[part]), ids[part], kinds[part], labels, windows, same)
            slot = np.arange(len(windows.anchor)) - windows.first[windows.anchor]  # windows come by anchor
            columns = [windows.anchor[windows.window], slot[windows.window], windows.id, windows.score]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor", "slot", "id", "score"])

        return run

    def _scan(self, index: Index, ids: np.ndarray, kinds: np.ndarray, labels: np.ndarray, windows: Windows, same: bool) -> None:
        x = self.vectors.astype(np.float64)[:, index.order]
        rest = remaining_norms(x)
        highest = np.full(len(x), float(LOWEST))
        np.maximum.at(highest, windows.anchor, windows.high.astype(np.float64))
        highest = np.minimum(highest, rest[:, 0] * index.largest)
        seen = np.full(len(x), HIGHEST)  # scores from here on are known
        for level in LEVELS:
            threshold, full = windows.least()
            searched = threshold < seen
            if level is not None:
                threshold = np.where(full, threshold, np.maximum(threshold, np.floor(level * highest).astype(np.int64)))
            searched = np.flatnonzero(searched & (threshold < seen))
            if len(searched):
                i, j = index.reach(x[searched], rest[searched], threshold[searched].astype(np.float64))
                i = searched[i]
                alike = labels[i] == kinds[j]
                fits = (alike & (self.ids[i] != ids[j])) if same else ~alike
                i, j = i[fits], j[fits]
                for first in range(0, len(i), PAIRS):
                    a, b = i[first : first + PAIRS], j[first : first + PAIRS]
                    score = np.einsum("ij,ij->i", self.vectors[a], index.rows[b])
                    new = (score >= threshold[a]) & (score < seen[a])
                    windows.add(a[new], score[new], ids[b[new]])
                seen[searched] = threshold[searched]


def _best(found: DataFrame, size: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mined(rows: DataFrame, anchors: list, shape: Mining) -> DataFrame:
    """The result for one slice of anchors."""
    spark = rows.sparkSession
    ids = np.array([a.id for a in anchors], np.int64)
    vectors = whole_steps(pa.array([a.vector for a in anchors], pa.list_(pa.float64())), len(anchors[0].vector))
    labels, each = [a.label for a in anchors], np.arange(len(anchors))
    everything = Anchors(ids, labels, vectors, each, np.full(len(each), LOWEST), np.full(len(each), HIGHEST))
    alike = _best(rows.mapInArrow(everything.search(True, shape.positives, shape.block_rows), FOUND), shape.positives)
    positives = sorted(alike.collect(), key=lambda r: (r.anchor, r.rank))
    positives = [r for r in positives if r.score >= 0]  # the window of a score below zero is empty
    scores = np.array([r.score for r in positives], np.int64)
    low = -((-shape.least_percent * scores) // 100)
    between = Anchors(ids, labels, vectors, np.array([r.anchor for r in positives], np.int64), low, scores)
    best = _best(rows.mapInArrow(between.search(False, shape.negatives, shape.block_rows), FOUND), shape.negatives)
    named = [(r.anchor, r.rank - 1, int(ids[r.anchor]), r.id, r.score) for r in positives]
    partners = spark.createDataFrame(named, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    joined = best.join(F.broadcast(partners), ["anchor", "slot"])  # as many rows as a slice has positives
    return joined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(
    vectors: DataFrame, is_anchor: Column, shape: Mining = Mining(), key: str = "vec_id", vector: str = "embedding", label: Column | str = "label"
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives: ``RESULT``.

    Positives are the anchor's best rows of its label, negatives the best rows of other labels within the positive's
    window. Scores are inner products of ``floor(256 x)``.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark)
    ship_code(spark)
    named = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), named.cast("string").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), is_anchor.alias("anchor")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    anchors = stored(rows.where("anchor").select("id", "label", "vector").distinct())
    slices = -(-anchors.count() // shape.anchors_at_once)
    paths = []
    for number in range(slices):
        some = anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(slices)) == number).orderBy("id", "label", "vector").collect()
        if some:
            paths.append(f"{folder}/llm-{uuid.uuid4().hex}")
            _mined(rows.drop("anchor"), some, shape).write.option("compression", "zstd").parquet(paths[-1])
    return spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)
