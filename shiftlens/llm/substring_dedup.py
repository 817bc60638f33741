"""Later copies of word passages, found by an FM-index a shard through which the shard's documents are streamed.

A window is a run of ``window`` words. Its anchor is the smallest hash of its ``GRAM``-word strings, so equal windows
have equal anchors. A text is cut into segments where the anchor changes, and segments whose anchor occurs in one
document only can't be copies. All others are dealt to shards by anchor, each different segment once, with the smallest
document that holds it. A shard builds a compressed FM-index of its segments and streams them through it once for the
smallest and once for the largest document that holds them: backward search gives the matching statistics against
segments of smaller documents, and intervals of ``window`` words or more are reported. They are laid over all places
where the segment occurs. Words are compared as bytes; hashes only deal them out (segments are told apart by 128 bits).

An anchor with more than ``group`` different segments (a passage quoted in ever other surroundings) is too much for a
shard: its segments are cut again, into single windows, which are dealt by their own hash and go the same way.

Texts are UTF-8, words runs of bytes other than the six ASCII blanks. Windows never cross documents. The smallest
document keeps its words; the rows of one id are one document, and rows without id are one that comes after all others.
Null and empty texts have no words, texts below ``window`` words lose none, repeats within one document stay. Repeated
rows get the same result each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.fm_index import FMIndex
from shiftlens.llm.suffix_dedup import _runs, _smallest
from shiftlens.llm.text import shared_folder, ship_code, stored

#: Words whose hash may be an anchor; a power of two.
GRAM = 16
#: Windows of one segment: text of one repeated word has one anchor throughout.
LONGEST = 512
SHARD_WORDS, SLICE_BYTES = 1 << 17, 1 << 21
_RNG = np.random.default_rng(11)
_SYMBOL = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR, _STEP = (int(x) | 1 for x in _RNG.integers(2**62, 2**63, 2))
_BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
DOC = ("doc", "twin")
SEGMENT = "doc long, twin long, start int, size int, anchor long, digest binary"
NO_ID = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and after how many of them each text ends."""
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[True, _BLANK[data], True]))
    starts, ends = edges[::2], edges[1::2]
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * _powers(_FACTOR, len(data)), out=summed[1:])
    hashes = (summed[ends] - summed[starts]) * _powers(pow(_FACTOR, -1, 2**64), len(data))[starts] + (ends - starts).astype(np.uint64)
    return _mixed(hashes), np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def _grams(hashes: np.ndarray) -> np.ndarray:
    factor, span = np.uint64(_STEP), 1
    while span < GRAM:
        hashes = hashes[:-span] * factor + hashes[span:]
        factor, span = np.uint64(int(factor) ** 2 % 2**64), 2 * span
    return _mixed(hashes)


def segments(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """``(text, start, size, anchor)`` of each run of windows with one anchor; starts and sizes in words."""
    hashes, ends = word_hashes(texts)
    n = len(hashes) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    anchors = _smallest(_grams(hashes), window - GRAM + 1)
    owner = np.searchsorted(ends, np.arange(n), "right")
    inside = np.arange(n) + window <= ends[owner]
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(new)
    new |= (np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))) % LONGEST == 0
    new, at = new[inside], np.flatnonzero(inside)
    first = np.flatnonzero(new)
    counts = np.diff(np.r_[first, len(at)])
    first = at[first]
    begins = np.r_[0, ends[:-1]]
    return owner[first], first - begins[owner[first]], counts + window - 1, anchors[first].view(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of bounded size, with the row at which a group begins."""
    held: list[bytes] = []
    first = size = 0
    for row, text in enumerate(batch.column("data")):
        data = text.as_py()
        if held and size + len(data) > SLICE_BYTES:
            yield first, held
            held, first, size = [], row, 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def _digest(piece: bytes) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()


def _table(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], list(columns))


def _segments(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, twins = (batch.column(c).to_numpy() for c in DOC)
            for row, texts in _slices(batch):
                owner, start, size, anchor = segments(texts, window)
                digests, of, words = [], -1, []
                for text, a, n in zip(owner.tolist(), start.tolist(), size.tolist(), strict=True):
                    if text != of:
                        of, words = text, texts[text].split()
                    digests.append(_digest(b" ".join(words[a : a + n])))
                yield _table({
                    "doc": (docs[row + owner], pa.int64()), "twin": (twins[row + owner], pa.int64()), "start": (start, pa.int32()),
                    "size": (size, pa.int32()), "anchor": (anchor, pa.int64()), "digest": (digests, pa.binary()),
                })

    return run


CUT = ("start", "size", "anchor", "digest", "before", "upto")


def _cut_texts(texts: DataFrame, cuts: DataFrame) -> DataFrame:
    """The texts that have ``cuts``, with the list of them; a document has as many as it has segments at most."""
    lists = cuts.groupBy(*DOC).agg(F.collect_list(F.struct(*CUT)).alias("cuts"))
    return texts.join(lists, [*DOC])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of texts with cuts, copies of a row that follow it left out."""
    last = None
    for batch in batches:
        for row in range(batch.num_rows):
            doc, twin = (batch.column(c)[row].as_py() for c in DOC)
            if (doc, twin) != last:
                last = doc, twin
                yield doc, twin, batch.column("data")[row].as_py().split(), batch.column("cuts")[row].as_py()


PIECE = "anchor long, digest binary, before long, upto long, piece binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each cut, joined by one blank."""
    for _, _, words, cuts in _once(batches):
        yield _table({
            "anchor": ([c["anchor"] for c in cuts], pa.int64()), "digest": ([c["digest"] for c in cuts], pa.binary()),
            "before": ([c["before"] for c in cuts], pa.int64()), "upto": ([c["upto"] for c in cuts], pa.int64()),
            "piece": ([b" ".join(words[c["start"] : c["start"] + c["size"]]) for c in cuts], pa.binary()),
        })


def _single_windows(window: int):
    """Segments of one window each in place of the cuts, the anchor a hash of the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, twin, words, cuts in _once(batches):
            starts = [at for c in cuts for at in range(c["start"], c["start"] + c["size"] - window + 1)]
            digests = [_digest(b" ".join(words[at : at + window])) for at in starts]
            yield _table({
                "doc": ([doc] * len(starts), pa.int64()), "twin": ([twin] * len(starts), pa.int64()), "start": (starts, pa.int32()),
                "size": ([window] * len(starts), pa.int32()), "anchor": ([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                "digest": (digests, pa.binary()),
            })

    return run


RUNS = "anchor long, digest binary, smallest array<struct<first:int,after:int>>, later array<struct<first:int,after:int>>"


def _shards(window: int):
    """Ranges of words that a segment's smallest document loses, and those that later ones lose."""
    runs_type = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))

    def solved(held: list[tuple]) -> pa.RecordBatch:
        anchors, digests, before, upto, pieces = zip(*held, strict=True)
        owners = np.array([*before, *upto], np.int64)
        ranks = np.unique(owners, return_inverse=True)[1].astype(np.int32)
        smallest, largest = ranks[: len(held)], ranks[len(held) :]
        index = FMIndex([p.split() for p in pieces], smallest, window)
        later = np.flatnonzero(largest > smallest)
        streamed = [*index.sequences, *(index.sequences[i] for i in later)]
        lengths = index.matches(streamed, np.concatenate([smallest, largest[later]]), window)
        runs = [[{"first": a, "after": b + window - 1} for a, b in _runs(found >= window)] for found in lengths]
        of_later: list[list] = [[] for _ in held]
        for i, found in zip(later, runs[len(held) :], strict=True):
            of_later[i] = found
        return _table({"anchor": (anchors, pa.int64()), "digest": (digests, pa.binary()), "smallest": (runs[: len(held)], runs_type), "later": (of_later, runs_type)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        held: list[tuple] = []
        words = 0
        for _, group in groupby(rows, key=itemgetter(0)):
            known: dict[bytes, tuple] = {row[1]: row for row in group}
            held += known.values()
            words += sum(row[4].count(b" ") + 1 for row in known.values())
            if words >= SHARD_WORDS:
                yield solved(held)
                held, words = [], 0
        if held:
            yield solved(held)

    return run


def _shared(found: DataFrame) -> DataFrame:
    """The segments whose anchor occurs in more than one document."""
    often = found.groupBy("anchor").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("anchor")
    return stored(found.join(often, "anchor"))


def _contents(found: DataFrame) -> DataFrame:
    """Different segments, each at its smallest document, with the largest one that holds it."""
    at = F.min(F.struct(*DOC, "start", "size")).alias("at")
    return found.groupBy("anchor", "digest").agg(at, F.max("doc").alias("upto")).select("anchor", "digest", "at.*", F.col("at.doc").alias("before"), "upto")


def copied_runs(texts: DataFrame, window: int, group: int) -> DataFrame:
    """``(doc, twin, runs)``: the word ranges of each document covered by copied windows, not yet merged."""
    found = _shared(stored(texts.mapInArrow(_segments(window), SEGMENT)))
    crowded = stored(_contents(found).groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > group).select("anchor"))
    if not crowded.isEmpty():
        none = F.lit(None).cast("long")
        cuts = found.join(crowded, "anchor").withColumns({"before": none, "upto": none})
        single = stored(_cut_texts(texts, cuts).mapInArrow(_single_windows(window), SEGMENT))
        found = found.join(crowded, "anchor", "left_anti").select(*single.columns).union(_shared(single).select(*single.columns))
    wanted = _contents(found)
    pieces = _cut_texts(texts, wanted).mapInArrow(_pieces, PIECE)
    solved = pieces.repartition("anchor").sortWithinPartitions("anchor", "digest").mapInArrow(_shards(window), RUNS)
    solved = stored(solved.where((F.size("smallest") > 0) | (F.size("later") > 0)).join(wanted.select("anchor", "digest", "before"), ["anchor", "digest"]))
    lost = F.when(F.col("doc") > F.col("before"), F.col("later")).otherwise(F.col("smallest"))
    placed = found.join(solved, ["anchor", "digest"]).select(
        *DOC, F.transform(lost, lambda r: F.struct((F.col("start") + r["first"]).alias("first"), (F.col("start") + r["after"]).alias("after"))).alias("runs")
    )
    # Copies of a row bring the same ranges: each is kept once.
    return placed.where(F.size("runs") > 0).groupBy(*DOC).agg(F.flatten(F.collect_set("runs")).alias("runs"))


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
    for batch in batches:
        sizes, spans, kept = [], [], []
        for data, runs in zip(batch.column("data"), batch.column("runs"), strict=True):
            words, lost = data.as_py().split(), []
            sizes.append(len(words))
            for run in sorted(runs.as_py() or (), key=itemgetter("first", "after")):
                if lost and run["first"] <= lost[-1]["after"]:
                    lost[-1]["after"] = max(lost[-1]["after"], run["after"])
                else:
                    lost.append(run)
            for run in reversed(lost):
                del words[run["first"] : run["after"]]
            spans.append(lost)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "spans", "kept"]
        )


def first_copies(docs: DataFrame, window: int = 50, group: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_words``, ``spans`` (maximal removed ranges ``[first, after)`` of words) and the ``kept`` words joined by one blank."""
    if window < GRAM + 1:
        raise ValueError(f"a window must have {GRAM + 1} words at least")
    shared_folder(docs.sparkSession)
    ship_code(docs.sparkSession)
    data = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    row = F.col(f"`{key}`")
    named = docs.select(F.coalesce(row.cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(data).alias("twin"), data.alias("data"), row.alias("row"))
    runs = copied_runs(named.drop("row"), window, group)
    joined = named.join(runs, [*DOC], "left").select("row", "data", "runs")
    kind = joined.schema["row"].dataType.simpleString()
    left = joined.mapInArrow(_left, f"row {kind}, n_words long, spans array<struct<first:int,after:int>>, kept string")
    return left.select(F.col("row").alias(key), "n_words", "spans", "kept")
