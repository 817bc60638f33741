"""Token counts of a unigram vocabulary without building the tokens.

An Aho-Corasick automaton lists the pieces that end at each character of a chunk; a forward pass carries the best
score of a segmentation up to there and how many tokens it has. Ties follow the tokenizer: among segmentations of
equal score up to a character the one whose last piece starts first wins, since longer pieces are tried before. A
character that is a piece of no segmentation costs ten less than the worst piece; neighbours of that kind are one
unknown token, which counts as its UTF-8 bytes where the vocabulary has byte pieces.

Null and empty texts have no tokens. Rows are counted one by one; only the key and the text column are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.pieces import Memory, Vocabulary
from shiftlens.llm.text import ship_code

UNKNOWN_PENALTY = 10.0


class Counter:
    """Counts of one worker."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        own = self.vocabulary
        self.unknown_score = min(own.scores) - UNKNOWN_PENALTY
        self.matches = ahocorasick.Automaton()
        for piece, i in own.ids.items():
            self.matches.add_word(piece, (len(piece), own.scores[i]))
        self.matches.make_automaton()
        self.memory = Memory(self.count_chunk)

    def count_chunk(self, chunk: str) -> int:
        """Tokens of the best segmentation of a chunk."""
        n = len(chunk)
        score, tokens, unknown = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        open_end, single = 0, -1  # the first end not settled yet, the last end with a piece of one character

        def settle(upto: int) -> None:
            for end in range(open_end, upto):
                if end != single and (here := score[end] + self.unknown_score) > score[end + 1]:
                    score[end + 1], unknown[end + 1] = here, True
                    cost = len(chunk[end].encode()) if self.vocabulary.byte_ids else 1 - unknown[end]
                    tokens[end + 1] = tokens[end] + cost

        # Matches come by their end, and of one end the longest first: a later one must be better to win.
        for end, (size, value) in self.matches.iter(chunk):
            if end > open_end:
                settle(end)
                open_end = end
            start = end + 1 - size
            if (here := score[start] + value) > score[end + 1]:
                score[end + 1], tokens[end + 1] = here, tokens[start] + 1
            if size == 1:
                single = end
        settle(n)
        return tokens[n]

    def count(self, text: str) -> int:
        return sum(map(self.memory.__getitem__, self.vocabulary.chunks(text)))


_COUNTERS: dict[int, Counter] = {}


def _run(model, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (name := hash(model.value)) not in _COUNTERS:
            _COUNTERS[name] = Counter(model.value)
        own = _COUNTERS[name]
        for batch in batches:
            counts = [own.count(text) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(counts, pa.int64())], [key, "n_tokens"])

    return run


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the key and ``n_tokens``."""
    spark = docs.sparkSession
    ship_code(spark)
    with open(model_path, "rb") as file:  # a vocabulary: its size doesn't grow with the data
        model = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(_run(model, key), f"`{key}` {kind}, n_tokens long")
