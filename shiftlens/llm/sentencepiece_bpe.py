"""Encoding and decoding with a merge-type piece vocabulary, in Arrow batches.

The encoder keeps an agenda of adjacent symbol pairs that are pieces, best score first and leftmost among equal
ones, and merges until none is left. Symbols that are no piece become their UTF-8 bytes' pieces. No piece of such
a vocabulary spans the cut before a space, so texts are encoded in chunks, and each chunk once a worker.

Every Arrow batch is checked against the sentencepiece library: all chunks that the worker had not met before are
put into one text that the library encodes. Should the two differ, the batch is compared text by text, the
library's ids count and ``agrees`` is false where they are others. Null and empty texts give the begin and end ids only and decode to an empty text.
Rows are encoded one by one; the key and a text column are read, others are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.pieces import SPACE, Memory, Vocabulary
from shiftlens.llm.text import ship_code

#: Lines of the text by which the library checks new chunks, and rows whose ids are held as Python numbers at once.
LINES, ROWS = 256, 128


def merge_by_score(vocabulary: Vocabulary, chunk: str) -> list[int]:
    """Ids of one chunk by the agenda of pairs."""
    ids, worth = vocabulary.ids, vocabulary.merge_order
    symbols, n = list(chunk), len(chunk)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = []
    for left in range(n - 1):
        if (order := worth.get(both := chunk[left : left + 2])) is not None:
            agenda.append((order, left, left + 1, both))
    heapify(agenda)
    while agenda:
        _, left, right, piece = heappop(agenda)
        # A pair is stale when one of its symbols has been merged meanwhile.
        if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != piece:
            continue
        symbols[left], symbols[right] = piece, ""
        on = after[left] = after[right]
        if on < n:
            before[on] = left
            if (order := worth.get(both := piece + symbols[on])) is not None:
                heappush(agenda, (order, left, on, both))
        if (back := before[left]) >= 0 and (order := worth.get(both := symbols[back] + piece)) is not None:
            heappush(agenda, (order, back, left, both))
    out: list[int] = []
    for symbol in filter(None, symbols):
        if (known := ids.get(symbol)) is not None:
            out.append(known)
        elif vocabulary.byte_ids:
            out += [vocabulary.byte_ids[b] for b in symbol.encode()]
        else:
            out.append(vocabulary.unknown)
    return out


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.fresh: list[str] = []
        self.memory = Memory(self._first_time)
        self.first, self.last = (np.array([i], "<i4").tobytes() for i in (self.vocabulary.begin, self.vocabulary.end))

    def _first_time(self, chunk: str) -> bytes:
        parts = self.vocabulary.parts(chunk)
        if len(parts) > 1:
            return b"".join([self.memory[part] for part in parts])
        self.fresh.append(chunk)
        return np.array(merge_by_score(self.vocabulary, chunk), "<i4").tobytes()

    def fresh_agree(self) -> bool:
        """Whether the library encodes the new chunks alike, put on lines of a few texts; they are old from now on."""
        start, line = self.memory[SPACE], self.memory["\n"]
        fresh, self.fresh = self.fresh, []
        parts = [fresh[at : at + LINES] for at in range(0, len(fresh), LINES)]
        texts = ["".join("\n" + chunk.replace(SPACE, " ") for chunk in part) for part in parts]
        ours = [start + b"".join(line + self.memory[chunk] for chunk in part) for part in parts]
        theirs = self.vocabulary.library.encode_as_numpy(texts, num_threads=1)
        agree = all(np.array_equal(np.frombuffer(a, "<i4"), b) for a, b in zip(ours, theirs, strict=True))
        if not agree:
            self.memory.clear()  # chunks made of wrong ones are wrong too; later batches check all of them again
        return agree

    def encode(self, text: str) -> np.ndarray:
        chunks = map(self.memory.__getitem__, self.vocabulary.chunks(text))
        return np.frombuffer(b"".join([self.first, *chunks, self.last]), "<i4")


_CODECS: dict[int, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec a worker and model, kept for its later tasks."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _run(model, key: str, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        library = own.vocabulary.library
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            texts = batch.column("_text").to_pylist()
            ids = [own.encode(text) for text in texts]
            agrees = [True] * len(ids)
            if not own.fresh_agree():
                reference = library.encode_as_numpy(texts, add_bos=True, add_eos=True, num_threads=1)
                agrees = [np.array_equal(a, b) for a, b in zip(ids, reference, strict=True)]
                ids = [a if same else b.astype("<i4") for a, b, same in zip(ids, reference, agrees, strict=True)]
            decoded = library.decode([x.tolist() for x in ids], num_threads=1) if ids else []
            if packed:
                lists = pa.array([x.tobytes() for x in ids], pa.binary())
            else:
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, "<i4"), *ids]), pa.int32()))
            columns = [batch.column(key), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded", "agrees"])

    return run


def encode_and_decode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", packed: bool = False, keep_row: bool = False) -> DataFrame:
    """Per row: the key, ``ids`` (with begin and end), ``decoded`` and ``agrees``. The model file is read by the driver.

    ``packed`` gives the ids as little-endian 32-bit numbers in a binary column instead of an array. ``keep_row``
    puts the whole row as a struct ``row`` in place of the key.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(model_path, "rb") as file:  # a vocabulary: its size doesn't grow with the data
        model = spark.sparkContext.broadcast(file.read())
    own, name = (F.struct(*(F.col(f"`{c}`") for c in docs.columns)), "row") if keep_row else (F.col(key), key)
    rows = docs.select(own.alias(name), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = rows.schema[name].dataType.simpleString()
    ids = "binary" if packed else "array<int>"
    return rows.mapInArrow(_run(model, name, packed), f"`{name}` {kind}, ids {ids}, decoded string, agrees boolean")
