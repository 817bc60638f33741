"""Language-model scores from a probabilistic suffix tree over words.

Contexts of up to two words are states of the tree. A context is a candidate if it occurs ``context_least`` times at
least, and is kept if the distribution of the next token after it diverges from the one after its own suffix by
``divergence`` nats at least; next tokens seen less than ``edge_least`` times after it are not told apart. Next tokens
are discounted and the freed mass goes to the suffix state; the root is the add-half unigram estimate over all words.
A text is scored token by token in the longest suffix state that was kept.

Counts come from all training rows, and the least counts are the same at every size, so the tree grows with the
corpus. Texts are stored once as slices of about two million tokens. In each round a slice sends its different words,
pairs or runs of three to buckets of their hashes, sorted and compressed; a bucket adds up what all slices say of a hash
and answers each in the order in which it asked, so keys travel one way only, and a slice asks once for what it holds
often, so no key is hot. Words and pairs are counted first; one slice, the owner, adds each pair to the state of its
first word. Runs are counted only where their first two words may be a state and both their pairs are seen often
enough, since no other run can be told apart; their owners add them to the states of two words. The number of buckets
follows that of the tokens, and shuffle files go as soon as their round is stored.

Tokens are words in ASCII lower case by 64-bit hashes, pairs and runs 64-bit hashes of these, and one end token a text.
Null and empty texts are the end alone. Rows are scored one by one, repeated rows count as often as they occur, null
ids hash as empty text. An empty training set scores everything by the root. Only the key and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.text import shared_folder, ship_code, stored


@dataclass(frozen=True)
class Shape:
    """Least counts of the tree and its smoothing.

    ``context_share`` asks contexts for a share of all training tokens besides, by default for none. Nothing is broadcast
    or sent as a dictionary any more, so ``broadcast_share`` and ``sent_share`` have no effect.
    """

    context_least: int = 2
    edge_least: int = 2
    context_share: float = 0.0
    divergence: float = 0.05
    discount: float = 0.5
    broadcast_share: float = 1e-5
    sent_share: float = 1e-6


_RNG = np.random.default_rng(6)
_SYMBOL = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = int(_RNG.integers(2**62, 2**63)) | 1
_INVERSE = pow(_FACTOR, -1, 2**64)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
END = np.uint64(0)
#: Bytes of text worked on at once, tokens of a slice, tokens to a bucket of hashes, and rounds that contexts of two are dealt
#: over by their buckets: each round shuffles its share only.
SLICE_BYTES, HELD_TOKENS, BUCKET_TOKENS, CONTEXT_ROUNDS = 1 << 21, 1 << 21, 1 << 22, 2


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def tokenize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row, each text's end included, and where each text's tokens begin."""
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_LOWER) or b" ", np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    edges = np.flatnonzero(np.diff(np.r_[True, _BLANK[data], True]))
    starts, ends = edges[::2], edges[1::2]
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * _powers(_FACTOR, len(data)), out=summed[1:])
    hashes = (summed[ends] - summed[starts]) * _powers(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    hashes ^= hashes >> np.uint64(29)
    hashes[hashes == END] = np.uint64(1)
    words_upto = np.searchsorted(starts, text_ends)
    tokens = np.insert(hashes, words_upto, END)
    return tokens, np.r_[0, words_upto[:-1] + np.arange(1, len(texts))] if texts else np.zeros(0, np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of bounded size, with the row at which a group begins."""
    held: list[bytes] = []
    first = size = 0
    for row, text in enumerate(batch.column("_text")):
        data = text.as_buffer().to_pybytes()
        if held and size + len(data) > SLICE_BYTES:
            yield first, held
            held, first, size = [], row, 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


#: A slice: whole texts in the order in which a task read them, of about ``HELD_TOKENS`` tokens.
SLICE = "slice long, tokens long, train_tokens long, docs array<struct<key:string,held_out:boolean,n_tokens:long,train:boolean>>, words binary, said binary"
DOC = pa.struct([("key", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("train", pa.bool_())])
COUNTED = "slice long, words_seen binary, pairs_seen binary"
#: What a slice says of those of its words, pairs or runs (kinds 0 to 2) that lie in a bucket of hashes, and the answers.
BLOCK = "kind int, bucket long, slice long, codes binary, values array<binary>"
ANSWER = "kind int, bucket long, slice long, answer binary, owned binary, different long"
SCORED = "key string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
WORDS, PAIRS, RUNS = range(3)


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers, compressed by planes of bytes; where most are zero, the others and a bit for each."""
    values = np.ascontiguousarray(values).view(np.uint64)
    used = values != 0
    sparse = 2 * np.count_nonzero(used) < len(values)
    told = values[used] if sparse else values
    width = max(1, (int(told.max(initial=0)).bit_length() + 7) // 8)
    raw = (np.packbits(used).tobytes() if sparse else b"") + told.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return np.array([len(values), len(raw), width, sparse], "<u4").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(data: bytes, number: type = np.int64) -> np.ndarray:
    size, length, width, sparse = np.frombuffer(data, "<u4", 4).tolist()
    raw = np.frombuffer(pa.decompress(memoryview(data)[16:], length, "zstd"), np.uint8)
    bits = -(-size // 8) if sparse else 0
    told = np.zeros(((length - bits) // width, 8), np.uint8)
    told[:, :width] = raw[bits:].reshape(width, -1).T
    if not sparse:
        return told.view(number).ravel()
    out = np.zeros(size, number)
    out[np.unpackbits(raw[:bits], count=size).view(bool)] = told.view(number).ravel()
    return out


def _batch(columns: dict, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    kinds = {name: types[kind] for name, kind in (c.split() for c in schema.split(", "))}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in kinds.items()], list(kinds))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices: their texts' keys, their different words, the most common first, and each token's place among these."""
    made, held, docs = TaskContext.get().partitionId() << 32, [], []

    def flush() -> pa.RecordBatch:
        nonlocal made
        tokens, rows = np.concatenate(held), pa.concat_arrays(docs)
        words, place, n = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        trained = rows.field("n_tokens").to_numpy() @ rows.field("train").to_numpy(zero_copy_only=False)
        columns = [pa.array([x]) for x in (made, len(tokens), int(trained))]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([words[order].tobytes()]), pa.array([_pack(rank[place])])]
        made += 1
        return pa.RecordBatch.from_arrays(columns, ["slice", "tokens", "train_tokens", "docs", "words", "said"])

    for batch in batches:
        for first, texts in _slices(batch):
            tokens, starts = tokenize(texts)
            part = batch.slice(first, len(texts))
            sizes = pa.array(np.diff(np.r_[starts, len(tokens)]).astype(np.int64))
            held.append(tokens)
            docs.append(pa.StructArray.from_arrays([part.column("key"), part.column("held_out"), sizes, part.column("train")], fields=list(DOC)))
            if sum(map(len, held)) > HELD_TOKENS:
                yield flush()
                held, docs = [], []
    if held:
        yield flush()


class Told:
    """A slice read back: tokens by their place among its ``words``, and the two tokens before each of the same text."""

    def __init__(self, row: dict) -> None:
        self.of, self.docs = row["slice"], row["docs"]
        self.words, self.said = np.frombuffer(row["words"], np.uint64), _unpack(row["said"]).astype(np.int32)
        self.sizes = self.docs.field("n_tokens").to_numpy()
        starts = np.cumsum(self.sizes) - self.sizes
        self.end = int(np.flatnonzero(self.words == END)[0])
        self.last, self.second = self.said.copy(), self.said.copy()
        self.last[1:], self.last[starts] = self.said[:-1], self.end
        self.second[1:], self.second[starts] = self.last[:-1], self.end

    def codes(self, *places: np.ndarray) -> np.ndarray:
        """Hash of the words at these places, one after the other."""
        code = self.words[places[0]]
        for place in places[1:]:
            code = _mixed(code) + self.words[place]
        return _mixed(code)

    def kind(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_distinct`` of the words of the slice, or of the pair at each token."""
        return _distinct(self.codes(np.arange(len(self.words))) if kind == WORDS else self.codes(self.last, self.said))

    def trained(self) -> np.ndarray:
        return np.repeat(self.docs.field("train").to_numpy(zero_copy_only=False), self.sizes)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes in order, the place of each hash among these, and where each is found."""
    order = np.argsort(codes)
    ordered = codes[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]][: len(codes)]
    place = np.empty(len(codes), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], place, order[new]


def _blocks(kind: int, of: int, codes: np.ndarray, values: list[np.ndarray], buckets: int, turn: int = 0, turns: int = 1) -> pa.RecordBatch:
    """Sorted hashes of one slice with their values, cut into buckets of equal ranges, of which one in ``turns`` is sent."""
    bucket = (codes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    used, first = np.unique(bucket, return_index=True)
    sent = used % np.uint64(turns) == turn
    spans = [s for s, yes in zip(pairwise([*first.tolist(), len(codes)]), sent, strict=False) if yes]
    used = used[sent]
    packed = [[_pack(v[a:b]) for v in values] for a, b in spans]
    gaps = [_pack(np.r_[codes[a], np.diff(codes[a:b])]) for a, b in spans]
    return _batch({"kind": [kind] * len(used), "bucket": used.astype(np.int64), "slice": [of] * len(used), "codes": gaps, "values": packed}, BLOCK)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; their texts' list stays an array."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].values if c == "docs" else batch.column(c)[i].as_py() for c in batch.schema.names}


def _asked(buckets: int):
    """How often a slice's training texts hold each of its words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            told = Told(row)
            trained = told.trained()
            counted = np.bincount(told.said, trained, len(told.words))
            codes, place, first = told.kind(WORDS)
            yield _blocks(WORDS, told.of, codes, [counted[first].astype(np.int64)], buckets)
            codes, place, _ = told.kind(PAIRS)
            yield _blocks(PAIRS, told.of, codes, [np.bincount(place, trained, len(codes)).astype(np.int64)], buckets)

    return run


def _solved(number: type, solve):
    """Each hash of a bucket gets ``solve`` of its values' sums over all slices; the first slice that has it owns it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        columns = {c: table.column(c).to_pylist() for c in ("kind", "bucket", "slice")}
        codes = [np.cumsum(_unpack(c, np.uint64), dtype=np.uint64) for c in table.column("codes").to_pylist()]
        ends = np.cumsum([len(c) for c in codes])[:-1]
        joined = np.concatenate(codes)
        order = np.argsort(joined, kind="stable")
        ordered = joined[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        at, group = np.flatnonzero(new), np.cumsum(new) - 1
        values = [np.concatenate([_unpack(v, number) for v in c]) for c in zip(*table.column("values").to_pylist(), strict=True)]
        solved = solve(columns["kind"][0], [np.add.reduceat(v[order], at) for v in values], values[0][order[at]])
        answer, owned = np.empty(len(joined), number), np.empty(len(joined), bool)
        answer[order], owned[order] = solved[group], new
        answers, flags = np.split(answer, ends), np.split(owned, ends)
        columns["answer"], columns["owned"] = [_pack(a) for a in answers], [np.packbits(f).tobytes() for f in flags]
        columns["different"] = [int(np.count_nonzero(f & (a > 0))) for f, a in zip(flags, answers, strict=True)]
        return pa.Table.from_batches([_batch(columns, ANSWER)])

    return run


def _counts(least: int):
    """Sums of counts; of pairs and runs those below ``least`` are zero, since nothing asks for them."""
    return _solved(np.int64, lambda kind, sums, _: np.where((kind == WORDS) | (sums[0] >= least), sums[0], 0))


def _answer(table: pa.Table, kind: int, number: type) -> tuple[np.ndarray, np.ndarray]:
    """What a slice gets back, and what of it it owns, in the order of its hashes."""
    mine = table.filter(pa.compute.equal(table.column("kind"), kind)).sort_by("bucket")
    answers = [_unpack(a, number) for a in mine.column("answer").to_pylist()]
    owned = [np.unpackbits(np.frombuffer(o, np.uint8), count=len(a)) for o, a in zip(mine.column("owned").to_pylist(), answers, strict=True)]
    return np.concatenate([*answers, np.zeros(0, number)]), np.concatenate([*owned, np.zeros(0, np.uint8)]).astype(bool)


def _seen(slices: pa.Table, counts: pa.Table) -> pa.Table:
    """The counts of a slice's words, and of the pair at each token, twice, plus one where the slice owns it."""
    told = Told(next(_rows(slices.to_batches())))
    words_seen = np.empty(len(told.words), np.int64)
    words_seen[told.kind(WORDS)[2]] = _answer(counts, WORDS, np.int64)[0]
    _, place, first = told.kind(PAIRS)
    n, owned = _answer(counts, PAIRS, np.int64)
    pairs_seen = 2 * n[place]
    pairs_seen[first] += owned & (n > 0)
    return pa.Table.from_batches([_batch({"slice": [told.of], "words_seen": [_pack(words_seen)], "pairs_seen": [_pack(pairs_seen)]}, COUNTED)])


@dataclass(frozen=True)
class Tree:
    """Turns counts into probabilities; ``total`` and ``norm`` are those of the root."""

    shape: Shape
    total: int
    norm: float

    def entries(self, context: np.ndarray, seen: np.ndarray, n: np.ndarray, shorter: np.ndarray) -> list[np.ndarray]:
        """Per context, how often it is seen and what next tokens with counts ``n`` and suffix probabilities ``shorter`` add to its state."""
        sums = (np.bincount(context, w, len(seen)) for w in (n, np.ones(len(n)), shorter, n * np.log(n / shorter)))
        return [seen.astype(float), *sums]

    def freed(self, kind: int, sums: list[np.ndarray], seen: np.ndarray) -> np.ndarray:
        """The mass that each context frees for its suffix, NaN where the context is not kept."""
        _, mass, told, shorter, heard = sums
        s = self.shape
        with np.errstate(divide="ignore", invalid="ignore"):
            rest, shorter_rest = (np.maximum(1 - x, 1e-12) for x in (mass / seen, shorter))
            gain = (heard - np.log(seen) * mass) / seen + rest * np.log(rest / shorter_rest)
            kept = (seen >= max(s.context_least, s.context_share * self.total)) & (told > 0) & (gain >= s.divergence)
            return np.where(kept, 1 - (mass - s.discount * told) / seen, np.nan)

    def probability(self, n: np.ndarray, seen: np.ndarray, freed: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Of a next token in its context, which is the one of the context's suffix where that was not kept."""
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(n >= self.shape.edge_least, (n - self.shape.discount) / seen, 0.0)
        return np.where(np.isnan(freed), shorter, share + freed * shorter)


class Judged(Told):
    """A slice with the counts of its words and pairs, and what else is known of it so far."""

    def __init__(self, row: dict, tree: Tree) -> None:
        super().__init__(row)
        self.tree, self.least = tree, tree.shape.edge_least
        self.words_seen, pairs = _unpack(row["words_seen"]), _unpack(row["pairs_seen"])
        self.pairs_seen, self.pair_owned = pairs >> 1, (pairs & 1).astype(bool)
        self.root = ((self.words_seen + 0.5) / tree.norm)[self.said]

    def words_asked(self, buckets: int) -> pa.RecordBatch:
        """What the pairs owned here add to the states of one word."""
        codes, place, first = self.kind(WORDS)
        new = np.flatnonzero(self.pair_owned & (self.pairs_seen >= self.least) & (self.last != self.end))
        values = self.tree.entries(place[self.last[new]], self.words_seen[first], self.pairs_seen[new], self.root[new])
        return _blocks(WORDS, self.of, codes, values, buckets)

    def words_told(self, answers: pa.Table) -> None:
        freed = _answer(answers, WORDS, float)[0][self.kind(WORDS)[1]]
        freed[self.end] = np.nan
        inside = freed[self.last]
        self.after_word = self.tree.probability(self.pairs_seen, self.words_seen[self.last], inside, self.root)
        # The pair before a token is its context of two; the first two tokens of a text have none.
        self.context_seen = np.r_[0, self.pairs_seen[:-1]]
        self.deep = np.flatnonzero((self.second != self.end) & ~np.isnan(inside) & (self.context_seen >= self.tree.shape.context_least))
        # A run that is told apart has pairs that are seen as often.
        self.often = self.deep[np.minimum(self.context_seen, self.pairs_seen)[self.deep] >= self.least]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _distinct(self.codes(self.second[self.often], self.last[self.often], self.said[self.often]))

    def runs_asked(self, buckets: int) -> pa.RecordBatch:
        """How often training texts have the runs that may be next tokens of a state."""
        codes, place, _ = self.runs()
        return _blocks(RUNS, self.of, codes, [np.bincount(place, self.trained()[self.often], len(codes)).astype(np.int64)], buckets)

    def runs_told(self, answers: pa.Table) -> None:
        _, place, first = self.runs()
        n, owned = _answer(answers, RUNS, np.int64)
        self.runs_seen, self.run_owned = np.zeros(len(self.said), np.int64), np.zeros(len(self.said), bool)
        self.runs_seen[self.often] = n[place]
        self.run_owned[self.often[first]] = owned
        self.contexts = _distinct(self.codes(self.second[self.deep], self.last[self.deep]))

    def pairs_asked(self, buckets: int, turn: int) -> pa.RecordBatch:
        """What the runs owned here add to the states of two words."""
        codes, place, first = self.contexts
        new = (self.run_owned & (self.runs_seen >= self.least))[self.deep]
        at = self.deep[new]
        values = self.tree.entries(place[new], self.context_seen[self.deep[first]], self.runs_seen[at], self.after_word[at])
        return _blocks(PAIRS, self.of, codes, values, buckets, turn, CONTEXT_ROUNDS)

    def scores(self, answers: pa.Table) -> pa.Table:
        freed = np.full(len(self.said), np.nan)
        freed[self.deep] = _answer(answers, PAIRS, float)[0][self.contexts[1]]
        final = self.tree.probability(self.runs_seen, self.context_seen, freed, self.after_word)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        add = lambda values: pa.array(np.bincount(owner, values, len(self.sizes)))
        known = add(self.words_seen[self.said] > 0).cast(pa.int64())
        columns = [*(self.docs.field(c) for c in ("key", "held_out", "n_tokens")), known, add(np.log10(self.root)), add(np.log10(final))]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])


def _judged(tree: Tree, rows: pa.Table, answers: pa.Table, runs: bool = True) -> Judged:
    judged = Judged(next(_rows(rows.to_batches())), tree)
    judged.words_told(answers)
    if runs:
        judged.runs_told(answers)
    return judged


def _kept(frame: DataFrame) -> DataFrame:
    """``stored``, without the shuffle files of the way there, which nothing reads again."""
    conf, name = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return stored(frame)
    finally:
        conf.set(name, before)


def score_texts(docs: DataFrame, held_out: Column, shape: Shape = Shape(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10).

    The tree learns from the rows for which ``held_out`` is false.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    ship_code(spark)
    rows = docs.select(F.col(key).cast("string").alias("key"), held_out.alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    slices = _kept(rows.withColumn("train", F.coalesce(~F.col("held_out"), F.lit(False))).mapInArrow(_cut, SLICE))
    total, tokens = slices.agg(F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    buckets = max(tokens // BUCKET_TOKENS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = _counts(min(shape.edge_least, shape.context_least))

    def answered(blocks: DataFrame, function) -> DataFrame:
        return _kept(blocks.groupBy("kind", "bucket").applyInArrow(function, ANSWER))

    def met(rows: DataFrame, answers: DataFrame, function, schema: str) -> DataFrame:
        return rows.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(function, schema)

    words_pairs = answered(slices.mapInArrow(_asked(buckets), BLOCK), counts)
    different = words_pairs.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("different"), F.lit(0))).first()[0]
    tree = Tree(shape, total, total + 0.5 * (different + 1))
    counted = slices.join(_kept(met(slices, words_pairs, _seen, COUNTED)).hint("merge"), "slice")

    one_word = answered(counted.mapInArrow(lambda batches: (Judged(row, tree).words_asked(buckets) for row in _rows(batches)), BLOCK), _solved(float, tree.freed))
    run_blocks = met(counted, one_word, lambda r, a: pa.Table.from_batches([_judged(tree, r, a, runs=False).runs_asked(buckets)]), BLOCK)
    known = one_word.union(answered(run_blocks, counts))

    def contexts(turn: int) -> DataFrame:
        pair_blocks = met(counted, known, lambda r, a: pa.Table.from_batches([_judged(tree, r, a).pairs_asked(buckets, turn)]), BLOCK)
        return answered(pair_blocks, _solved(float, tree.freed))

    two_words = reduce(DataFrame.union, map(contexts, range(CONTEXT_ROUNDS)), known)
    scored = met(counted, two_words, lambda r, a: _judged(tree, r, a).scores(a), SCORED)
    return scored.select(
        F.col("key").cast(docs.schema[key].dataType).alias(key), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )
