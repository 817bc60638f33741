"""Removal of repeated byte strings by suffix arrays, in shards that hold all that can match.

Each window of ``length`` bytes has an anchor, the smallest hash of its ``GRAM``-byte strings, so equal windows have
equal anchors. A text is cut where the anchor changes. Segments whose anchor occurs once in all documents can't
repeat. Of the others, equal segments are one: their windows repeat at once. Where an anchor has different
segments, these are dealt to shards by anchor, and the suffix array of a shard with its permuted common prefixes
tells which windows occur twice. What no other segment of an anchor shares with a segment to the left and right of the
anchor, too little for a window, is left out before, unless a segment holds the anchor twice. An anchor with more than ``group`` different segments (a passage that a large share of all
documents quote in different surroundings) is not put into one task: its windows are counted by a 128-bit digest.

Texts are UTF-8 bytes, null ones empty. Matches never cross documents but may overlap or lie in one document. Rows
are separate documents even when they share an id: ``key`` only names them, and repeated rows remove each other. All
occurrences are removed, judged on the input. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.suffix_array import permuted_lcp, suffix_array
from shiftlens.llm.text import shared_folder, ship_code, stored

#: Long enough that near copies with a change in every other line rarely share one.
GRAM = 64
#: Windows of one segment: text of one repeated symbol has one anchor throughout.
LONGEST = 4096
SHARD_BYTES = 1 << 18
_RNG = np.random.default_rng(400)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = tuple(np.uint64(int(x) | 1) for x in _RNG.integers(2**62, 2**63, 2))
OCCURRENCE = "doc long, twin long, start int, size int, anchor long, gram int, inner boolean, digest binary"


def _rolled(data: np.ndarray, width: int, factor: np.uint64) -> np.ndarray:
    """Hash of each ``width`` bytes (a power of two), built from halves."""
    hashes, span = _BYTE[data], 1
    while span < width:
        hashes = hashes[:-span] * factor + hashes[span:]
        factor, span = np.uint64(int(factor) ** 2 % 2**64), 2 * span
    hashes = hashes ^ (hashes >> np.uint64(29))
    return hashes * np.uint64(0xBF58476D1CE4E5B9)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments(data: bytes, length: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """``(start, size, anchor, gram, inner)`` of each run of windows with one anchor.

    ``gram`` is where in the segment the anchor's bytes begin, ``inner`` whether they occur in it again.
    """
    if len(data) < length:
        return
    grams = _rolled(np.frombuffer(data, np.uint8), GRAM, _FACTORS[0])
    width = length - GRAM + 1
    anchors = _smallest(grams, width)
    cuts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    ends = np.append(cuts[1:], len(anchors))
    if (ends - cuts).max() > LONGEST:
        cuts = np.unique(np.concatenate([cuts, *(np.arange(a, b, LONGEST) for a, b in zip(cuts, ends, strict=True) if b - a > LONGEST)]))
        ends = np.append(cuts[1:], len(anchors))
    for first, after in zip(cuts.tolist(), ends.tolist(), strict=True):
        value = anchors[first]
        places = np.flatnonzero(grams[first : after + width - 1] == value)
        yield first, after - first + length - 1, int(value.view(np.int64)), int(places[0]), len(places) > 1


def _occurrences(length: int):
    schema = pa.schema([("doc", pa.int64()), ("twin", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("anchor", pa.int64()), ("gram", pa.int32()), ("inner", pa.bool_()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, twin, data in zip(*(batch.column(c) for c in ("doc", "twin", "data")), strict=True):
                doc, twin, data = doc.as_py(), twin.as_py(), data.as_py()
                rows += [(doc, twin, cut[0], *cut[1:], hashlib.blake2b(data[cut[0] : cut[0] + cut[1]], digest_size=16).digest()) for cut in segments(data, length)]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether the window at each start occurs at another place of the shard."""
    joined = np.ones(sum(map(len, pieces)) + len(pieces), np.int64)
    starts = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    for at, piece in zip(starts, pieces, strict=False):
        joined[at : at + len(piece)] = np.frombuffer(piece, np.uint8).astype(np.int64) + 2
    shared, before = permuted_lcp(joined, suffix_array(joined))
    twice = shared >= length
    twice[before[twice]] = True
    # A window across two pieces holds a mark that no window within one has.
    return [twice[a : a + max(0, len(p) - length + 1)] for a, p in zip(starts, pieces, strict=False)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


#: A row: its id and a hash of its text, so that rows with one id don't mix.
DOC = ("doc", "twin")
RUNS = "anchor long, digest binary, runs array<struct<first:int,after:int>>"


PIECE = ("anchor", "digest", "gram", "inner", "piece")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in PIECE), strict=True)


def _shared_prefixes(texts: list[bytes]) -> list[int]:
    """For each text the longest prefix that it shares with any other one."""
    order, best = sorted(range(len(texts)), key=texts.__getitem__), [0] * len(texts)
    for i, j in zip(order, order[1:], strict=False):
        n = min(len(texts[i]), len(texts[j]))
        unlike = np.frombuffer(texts[i], np.uint8, n) != np.frombuffer(texts[j], np.uint8, n)
        shared = int(unlike.argmax()) if unlike.any() else n
        best[i], best[j] = max(best[i], shared), max(best[j], shared)
    return best


def _matchable(group: list[tuple], length: int) -> list[tuple]:
    """The parts ``(anchor, digest, offset, piece)`` of one anchor's segments that may hold a window of another one.

    Such a window holds the anchor, so it lies within what a segment shares with any other to its left and right. In
    an inner segment the window may hold the anchor at any of its places, so then all segments are passed whole.
    """
    if any(inner for _, _, _, inner, _ in group):
        return [(anchor, digest, 0, piece) for anchor, digest, _, _, piece in group]
    right = _shared_prefixes([piece[gram:] for _, _, gram, _, piece in group])
    left = _shared_prefixes([piece[:gram][::-1] for _, _, gram, _, piece in group])
    parts = []
    for (anchor, digest, gram, _, piece), back, on in zip(group, left, right, strict=True):
        first, after = gram - back, gram + on
        if after - first >= length:
            parts.append((anchor, digest, first, piece[first:after]))
    return parts


def _shards(length: int):
    runs_type = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))

    def solved(held: list[tuple]) -> pa.RecordBatch:
        flags = repeated_starts([piece for *_, piece in held], length)
        runs = [[{"first": at + a, "after": at + b} for a, b in _runs(f)] for (_, _, at, _), f in zip(held, flags, strict=True)]
        columns = [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary()), pa.array(runs, runs_type)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for _, group in groupby(_rows(batches), key=itemgetter(0)):
            held += _matchable(list(group), length)
            if sum(len(h[3]) for h in held) >= SHARD_BYTES:
                yield solved(held)
                held = []
        if held:
            yield solved(held)

    return run


def _windows(length: int):
    """Digests of all windows of a piece, 128 bits in two hashes that are independent of each other."""

    def digest(data: np.ndarray, factor: np.uint64) -> np.ndarray:
        out, place = np.zeros(len(data) - length + 1, np.uint64), 0
        for span in (1 << bit for bit in reversed(range(length.bit_length())) if length >> bit & 1):
            out = out * factor + _rolled(data, span, factor)[place : place + len(out)]
            place += span
        return out.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, key, _, _, piece in _rows([batch]):
                data = np.frombuffer(piece, np.uint8)
                x, y = (digest(data, f) for f in _FACTORS)
                columns = [pa.array([anchor] * len(x), pa.int64()), pa.array([key] * len(x), pa.binary()), pa.array(x), pa.array(y), pa.array(np.arange(len(x), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "x", "y", "first"])

    return run


def _pieces(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one occurrence of each wanted segment."""
    lists = wanted.groupBy(*DOC).agg(F.collect_list(F.struct("start", "size", "anchor", "digest", "gram", "inner", "kinds")).alias("cuts"))
    rows = texts.join(lists, [*DOC]).select("data", F.explode("cuts").alias("cut"))
    return rows.select("cut.anchor", "cut.digest", "cut.gram", "cut.inner", "cut.kinds", F.substring("data", F.col("cut.start") + 1, F.col("cut.size")).alias("piece"))


def repeated_runs(texts: DataFrame, length: int, group: int) -> DataFrame:
    """``(doc, twin, runs)``: the byte ranges of each document covered by repeated windows, not yet merged."""
    found = texts.mapInArrow(_occurrences(length), OCCURRENCE)
    often = found.groupBy("anchor").agg(F.count("*").alias("n"), F.max("inner").alias("inside")).where("n > 1 OR inside").select("anchor")
    occurrences = stored(found.join(often, "anchor"))
    contents = occurrences.groupBy("anchor", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct(*DOC, "start", "size", "gram", "inner")).alias("at")
    )
    kinds = contents.groupBy("anchor").agg(F.count("*").alias("kinds"))
    graded = stored(contents.join(kinds, "anchor").select("anchor", "digest", "copies", "kinds", "at.*"))

    whole = graded.where("copies > 1").select("anchor", "digest", F.array(F.struct(F.lit(0).alias("first"), (F.col("size") - length + 1).alias("after"))).alias("runs"))
    unlike = stored(_pieces(texts, graded.where("kinds > 1 OR inner")))
    dealt = unlike.where(F.col("kinds") <= group).select(*PIECE).repartition("anchor").sortWithinPartitions("anchor")
    solved = dealt.mapInArrow(_shards(length), RUNS)

    windows = unlike.where(F.col("kinds") > group).select(*PIECE).mapInArrow(_windows(length), "anchor long, digest binary, x long, y long, first int")
    twice = windows.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1").select("x", "y")
    single = F.struct("first", (F.col("first") + 1).alias("after"))
    counted = windows.join(twice, ["x", "y"]).groupBy("anchor", "digest").agg(F.collect_list(single).alias("runs"))

    runs = stored(whole.union(solved).union(counted).where(F.size("runs") > 0))
    placed = occurrences.join(runs, ["anchor", "digest"]).select(
        *DOC, F.transform("runs", lambda r: F.struct((F.col("start") + r["first"]).alias("first"), (F.col("start") + r["after"] + length - 1).alias("after"))).alias("runs")
    )
    return placed.groupBy(*DOC).agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _removed(size: int, runs: list[dict] | None) -> np.ndarray:
    change = np.zeros(size + 1, np.int64)
    for r in runs or ():
        change[r["first"]] += 1
        change[r["after"]] -= 1
    return np.cumsum(change)[:size] > 0


def whole_characters(data: bytes, gone: np.ndarray) -> np.ndarray:
    """The removed bytes without those of characters of which a part stays."""
    if not gone.any():
        return gone
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.minimum.reduceat(gone, np.flatnonzero(first))[np.cumsum(first) - 1]


def _cut(batches: Iterator[pa.RecordBatch], characters: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, kept = [], []
        for data, runs in zip(batch.column("data"), batch.column("runs"), strict=True):
            data, runs = data.as_py(), runs.as_py()
            gone = _removed(len(data), runs)
            if characters:
                gone = whole_characters(data, gone)
            spans.append([{"first": a, "after": b} for a, b in _runs(gone)])
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
        spans_type = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, spans_type), pa.array(kept, pa.binary())], ["row", "spans", "kept"])


def _cut_rows(docs: DataFrame, row: Column, length: int, group: int, key: str, text: str, characters: bool) -> DataFrame:
    """``row``, ``spans`` and ``kept`` bytes of each row."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} bytes at least")
    shared_folder(docs.sparkSession)
    ship_code(docs.sparkSession)
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    no_id = F.col(key).isNull()
    named = docs.select(
        F.coalesce(F.col(key), F.lit(-1)).cast("long").alias("doc"), F.xxhash64(data, no_id).alias("twin"), data.alias("data"), row.alias("row")
    )
    runs = repeated_runs(named.drop("row"), length, group)
    joined = named.join(runs, [*DOC], "left").select("row", "data", "runs")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(lambda batches: _cut(batches, characters), f"row {kind}, spans array<struct<first:int,after:int>>, kept binary")


def repeated_bytes(docs: DataFrame, length: int = 400, group: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_bytes``, ``spans`` (maximal removed ranges ``[first, after)`` of bytes) and ``kept`` bytes."""
    cut = _cut_rows(docs, F.col(key), length, group, key, text, characters=False)
    size = F.octet_length("kept") + F.aggregate("spans", F.lit(0), lambda n, s: n + s["after"] - s["first"])
    return cut.select(F.col("row").alias(key), size.cast("long").alias("n_bytes"), "spans", "kept")


def without_repeats(docs: DataFrame, length: int = 400, group: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their columns as they were, save the text, which loses its repeated strings.

    A character goes only if all its bytes do. Null texts stay null.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    cut = _cut_rows(docs, whole, length, group, key, text, characters=True)
    left = F.when(F.col("row").getField(text).isNotNull(), F.decode("kept", "UTF-8"))
    return cut.select(*((left if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns))
