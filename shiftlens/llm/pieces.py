"""A piece vocabulary and how texts fall into chunks that are encoded one by one."""

from __future__ import annotations

import re
from collections.abc import Callable

import sentencepiece

SPACE = "▁"


class Vocabulary:
    """Pieces with scores, read from a serialized model; the model itself does the reference encoding."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, n = self.library, self.library.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.scores = [lib.get_score(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        #: The best score comes first.
        self.merge_order = {piece: -self.scores[i] for piece, i in self.ids.items()}
        self.unknown, self.begin, self.end = lib.unk_id(), lib.bos_id(), lib.eos_id()
        self.chunk = _chunk_pattern(list(self.ids))
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}

    def chunks(self, text: str) -> list[str]:
        """The normalized text in parts that no piece crosses; joined they are the whole, an empty text has none."""
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []


    def parts(self, chunk: str) -> list[str]:
        """A chunk cut between characters that stand side by side in no piece."""
        near, cuts = self.neighbours, [0]
        for at in range(1, len(chunk)):
            if chunk[at - 1 : at + 1] not in near:
                cuts.append(at)
        return [chunk[a:b] for a, b in zip(cuts, [*cuts[1:], len(chunk)], strict=True)]


def _chunk_pattern(pieces: list[str]) -> re.Pattern:
    """Cuts before runs of spaces and around line ends, if no piece of the vocabulary spans such a cut.

    That holds where spaces stand only at the start of a piece and line ends in none; else texts aren't cut at all.
    """
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        return re.compile(r".+", re.DOTALL)
    if any("\n" in p for p in pieces):
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    return re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class Memory(dict):
    """Results by chunk, worked out when first asked for; starts anew when it holds ``limit`` of them."""

    def __init__(self, work: Callable[[str], object], limit: int = 800_000):
        super().__init__()
        self.work, self.limit = work, limit

    def __missing__(self, chunk: str):
        if len(self) >= self.limit:
            self.clear()
        found = self[chunk] = self.work(chunk)
        return found
