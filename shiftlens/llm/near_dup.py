"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

A signature has ``coordinates`` values, each made of ``minima`` minima of hashes over a text's word shingles.
Every distinct text is posted under its (coordinate, value) pairs, and two texts whose sets agree by the
threshold agree in far more than ``matches`` coordinates. Sorted from the rarest pair to the most common one, two
such texts must share a pair among the first ``coordinates - matches + 1`` (the prefix); all other postings, the
longest lists, are skipped. Texts that share a list are compared on whole signatures and, where enough
coordinates collide, on their whole shingle sets, so that no false link remains.

First each text is held against the leader of its lists, the text whose pairs are the most common ones, which joins
most of a large group of near copies at one row a posting. Only texts of a list that are still in different components
are compared further: those outside the list's largest component with all others, block against block in tasks of
their own, and a pair only in the first list that it shares. No link between different components is left out, and
components need no other.

Where a list has more than a block of texts outside its largest component, its texts are posted anew under shingles: those that
the list's leader lacks come first, and two sets that agree by the threshold must share one of the first few. So texts
that are alike but not near copies part without being compared pair by pair.

With the defaults a pair at exactly 80 % is missed with a probability of about 1e-6.

Equal word sequences are one node from the start. Null, empty and blank texts have no shingles and no links.
Rows that share an id are one document; rows without id are linked with nothing and kept. ``keep_one`` decides row by
row instead. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlens.llm.components import component_roots
from shiftlens.llm.text import BOXED, ROW, lower_ascii, shared_folder, shingle_hashes, ship_code, stored, with_row_keys, words


@dataclass(frozen=True)
class Scheme:
    """What counts as near, and how candidates are found."""

    shingle_words: int = 5
    percent: int = 80
    coordinates: int = 32
    minima: int = 2
    matches: int = 8
    block: int = 256

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2**63, count, dtype=np.uint64)


def signatures(hashes: pa.ListArray, scheme: Scheme) -> np.ndarray:
    """One row of coordinates a set; an empty set gets zeros."""
    a, b = _multipliers(scheme.coordinates * scheme.minima)
    flat, offsets = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64), hashes.offsets.to_numpy()
    offsets = offsets - offsets[0]
    out = np.zeros((len(hashes), len(a)), np.uint64)
    for row in np.flatnonzero(np.diff(offsets)):
        lowest = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(offsets[row], offsets[row + 1], 4096):  # a long text in pieces
            part = flat[at : min(at + 4096, offsets[row + 1]), None]
            np.minimum(lowest, (part * a + b).min(axis=0), out=lowest)
        out[row] = lowest >> np.uint64(32)
    grouped = out.reshape(len(out), scheme.coordinates, scheme.minima)
    mixed = np.zeros(grouped.shape[:2], np.uint64)
    for k in range(scheme.minima):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k]
    return mixed.view(np.int64)


def _long_lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1] or 1, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), pa.int64()))


def _sign(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = _long_lists(signatures(batch.column("hashes"), scheme))
            columns = [batch.column("id"), batch.column("text_key"), batch.column("n_shingles"), signed]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "n_shingles", "signature"])

    return run


def shingled(docs: DataFrame, scheme: Scheme, key: str, text: str) -> DataFrame:
    """``id``, ``text_key`` of the word sequence and the distinct shingle ``hashes``."""
    rows = docs.select(F.col(key).cast("long").alias("id"), words(lower_ascii(F.col(text))).alias("w"))
    return rows.select(
        "id", F.md5(F.concat_ws(" ", "w").cast("binary")).alias("text_key"),
        F.array_distinct(shingle_hashes(F.col("w"), scheme.shingle_words)).alias("hashes"),
    )


def postings(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """``(node, coordinate, value, weight)`` of each node's prefix, for values that at least two nodes have.

    ``weight`` sums over the node's values how many nodes have them: the largest of a group is in its middle.
    """
    tokens = nodes.select("node", F.posexplode("signature").alias("coordinate", "value"))
    shared = tokens.groupBy("coordinate", "value").agg(F.count("*").alias("df")).where("df > 1")
    rarest_first = Window.partitionBy("node").orderBy("df", "coordinate", "value")
    ranked = tokens.join(shared, ["coordinate", "value"]).withColumns(
        {
            "rank": F.row_number().over(rarest_first), "common": F.count("*").over(Window.partitionBy("node")),
            "weight": F.sum("df").over(Window.partitionBy("node")),
        }
    )
    # Values of one node only come first and fill the prefix without being posted.
    return ranked.where(f"rank <= {scheme.prefix} - ({scheme.coordinates} - common)").select("node", "coordinate", "value", "weight")


def _leader() -> Column:
    return F.max_by("node", F.struct("weight", -F.col("node"))).alias("leader")


def leader_links(posted: DataFrame, signed: DataFrame, sets: DataFrame, scheme: Scheme) -> tuple[DataFrame, DataFrame]:
    """Confirmed links ``(a, b)`` of nodes to that leader of their lists that their signatures agree with most.

    Also the ``hashes`` of these nodes and of those in lists of more than a block.
    """
    leaders = posted.groupBy("coordinate", "value").agg(_leader(), F.count("*").alias("n")).where("n > 1")
    pairs = posted.join(leaders, ["coordinate", "value"]).where("node <> leader").select("node", "leader").distinct()
    own = signed.select("node", "n_shingles", "signature")
    other = own.select(F.col("node").alias("leader"), F.col("n_shingles").alias("n_other"), F.col("signature").alias("other"))
    equal = F.size(F.filter(F.zip_with("signature", "other", lambda x, y: x == y), lambda same: same))
    sizes = 100 * F.least("n_shingles", "n_other") >= scheme.percent * F.greatest("n_shingles", "n_other")
    alike = pairs.join(own, "node").join(other, "leader").withColumn("equal", equal).where((F.col("equal") >= scheme.matches) & sizes)
    chosen = stored(alike.groupBy("node").agg(F.max_by("leader", F.struct("equal", -F.col("leader"))).alias("leader")))
    long = posted.join(leaders.where(F.col("n") > scheme.block), ["coordinate", "value"]).select("node")
    ends = stored(chosen.select("node").union(chosen.select("leader")).union(long).distinct())  # of known size, so sets need no shuffle to meet a small one
    hashes = stored(sets.select(F.col("id").alias("node"), "text_key", "hashes").join(ends, "node"))
    both = chosen.join(hashes.drop("text_key"), "node").join(hashes.select(F.col("node").alias("leader"), F.col("hashes").alias("others")), "leader")
    common = F.size(F.array_intersect("hashes", "others"))
    near = 100 * common >= scheme.percent * (F.size("hashes") + F.size("others") - common)
    return both.where(near).select(F.col("node").alias("a"), F.col("leader").alias("b")), hashes


def _sizes(posted: DataFrame) -> DataFrame:
    """Lists with several components: ``size`` and ``largest``, the size and name of the largest component."""
    members = posted.groupBy("coordinate", "value", "component").agg(F.count("*").alias("n"))
    return members.groupBy("coordinate", "value").agg(
        F.count("*").alias("components"), F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("largest")
    ).where("components > 1").drop("components")


#: The coordinate of lists of shingles.
SHINGLE = -1


def with_shingle_lists(grouped: DataFrame, hashes: DataFrame, scheme: Scheme) -> DataFrame:
    """Postings ``(node, coordinate, value, component)``, where lists with more than a block outside the largest component give way to lists of shingles.

    Of the ``n`` shingles of a set, one that agrees by the threshold with a set of ``least`` or more has ``overlap`` at
    least, so in any one order of all shingles both share one of their first ``n - overlap + 1``. The order of a list
    is its leader's: shingles that it lacks, then its own.
    """
    columns, place = ["node", "coordinate", "value", "component"], ["coordinate", "value"]
    long = stored(_sizes(grouped).where(F.col("size") - F.col("largest.n") > scheme.block).select(*place))
    inside = grouped.join(long, place)
    led = stored(inside.join(inside.groupBy(*place).agg(_leader()), place).select("node", "component", "leader").distinct())
    members = stored(led.join(hashes, "node").select("node", "component", "leader", "text_key", "hashes"))
    groups = members.groupBy("leader").agg(F.min(F.size("hashes")).alias("least"))
    heads = members.where("node = leader").groupBy("leader").agg(F.min_by("hashes", "text_key").alias("common")).join(groups, "leader")
    n = F.size("hashes")
    least = F.greatest("least", F.ceil(scheme.percent * n / 100))
    overlap = F.ceil(scheme.percent * (n + least) / (100 + scheme.percent))
    ordered = F.concat(F.array_sort(F.array_except("hashes", "common")), F.array_sort(F.array_intersect("hashes", "common")))
    first = F.slice(ordered, F.lit(1), (n - overlap + 1).cast("int"))
    shingles = members.join(heads, "leader").select("node", "component", "leader", F.explode(first).alias("shingle"))
    lists = shingles.select("node", F.lit(SHINGLE).alias("coordinate"), F.xxhash64("leader", "shingle").alias("value"), "component").distinct()
    return grouped.join(long, place, "left_anti").select(*columns).union(lists)


def lists_to_compare(posted: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows ``(coordinate, value, pair, node, component)``: members of a block, or of a pair of blocks, of a list to compare.

    Lists within one ``component`` are left out. The largest component of a list has blocks of its own, which meet the
    blocks of all others but not each other.
    """
    blocks = lambda n: F.ceil(n / scheme.block).cast("int")
    lists = _sizes(posted).select(
        "coordinate", "value", F.col("largest.component").alias("largest"), blocks(F.col("size") - F.col("largest.n")).alias("others"), blocks(F.col("largest.n")).alias("own")
    )
    rows = posted.join(lists, ["coordinate", "value"]).withColumn("inside", F.col("component") == F.col("largest"))
    block = F.when(F.col("inside"), F.col("others") + F.pmod(F.xxhash64("node"), "own")).otherwise(F.pmod(F.xxhash64("node"), "others"))
    last = F.when(F.col("inside"), F.col("others")).otherwise(F.col("others") + F.col("own")) - 1
    rows = rows.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    pair = F.least("block", "other").cast("long") * (1 << 31) + F.greatest("block", "other")
    return rows.select("coordinate", "value", pair.alias("pair"), "node", "component")


LIST = ("coordinate", "value", "pair")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one list at a time, also across batches, of rows sorted by list; a group has two blocks at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        columns = [table.column(name).to_numpy() for name in LIST]
        starts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
        for first, after in zip(starts[:-1], starts[1:], strict=True):
            yield table.slice(first, after - first)
        rest = table.slice(starts[-1])
        held = rest.to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _collisions(group: pa.Table, scheme: Scheme) -> np.ndarray:
    """Which members of different components have enough equal coordinates, for pairs whose first common posting is this list, in lists of shingles for all."""
    n = group.num_rows
    values = group.column("signature").combine_chunks().flatten().to_numpy().reshape(n, -1)
    posted = (group.column("posted").to_numpy()[:, None] >> np.arange(scheme.coordinates)) & 1 == 1
    sizes, components = group.column("n_shingles").to_numpy(), group.column("component").to_numpy()
    here, close = group.column("coordinate")[0].as_py(), np.zeros((n, n), bool)
    for i in range(n - 1):
        same = values[i + 1 :] == values[i]
        first = here if here == SHINGLE else (same & posted[i + 1 :] & posted[i]).argmax(axis=1)
        least, most = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
        close[i, i + 1 :] = (same.sum(axis=1) >= scheme.matches) & (first == here) & (components[i + 1 :] != components[i]) & (100 * least >= scheme.percent * most)
    return close


def _candidates(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            close = _collisions(group, scheme) if group.num_rows > 1 else np.zeros((0, 0), bool)
            near = close.any(axis=0) | close.any(axis=1)
            if near.any():
                yield from group.filter(pa.array(near)).combine_chunks().to_batches()

    return run


def _joined(links: np.ndarray) -> np.ndarray:
    """Of a boolean matrix of links, the first member of each member's component."""
    first = np.arange(len(links))
    links = links | links.T
    for start in range(len(links)):
        if first[start] != start:
            continue
        edge = np.array([start])
        while len(edge):
            found = np.flatnonzero(links[edge].any(axis=0) & (first == np.arange(len(links))))
            edge = found[found > start]
            first[edge] = start
    return first


def _links(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            close = _collisions(group, scheme) if group.num_rows > 1 else np.zeros((0, 0), bool)
            if not close.any():
                continue
            sets = group.column("hashes").combine_chunks()
            offsets = sets.offsets.to_numpy() - sets.offsets[0].as_py()
            _, codes = np.unique(sets.flatten().to_numpy(), return_inverse=True)
            sizes, linked = np.diff(offsets), np.zeros_like(close)
            for i in np.flatnonzero(close.any(axis=1)):
                member = np.zeros(codes.max() + 1, np.int64)
                member[codes[offsets[i] : offsets[i + 1]]] = 1
                both = np.add.reduceat(member[codes], offsets[:-1])
                linked[i] = close[i] & (100 * both >= scheme.percent * (sizes + sizes[i] - both))
            nodes, first = group.column("node").to_numpy(), _joined(linked)
            ends = np.flatnonzero(first != np.arange(len(first)))
            if len(ends):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[ends]), pa.array(nodes[first[ends]])], ["a", "b"])

    return run


def links_of(nodes: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Confirmed links ``(a, b)`` between nodes, only as many as connect them."""
    posted = stored(postings(nodes, scheme))
    led, hashes = leader_links(posted, nodes, sets, scheme)
    roots = stored(component_roots(stored(led)))
    grouped = stored(posted.join(roots, "node", "left").select("node", "coordinate", "value", "weight", F.coalesce("root", "node").alias("component")))
    masks = posted.groupBy("node").agg(F.expr("bit_or(shiftleft(1L, coordinate)) AS posted"))
    signed = nodes.join(masks, "node")
    rows = lists_to_compare(stored(with_shingle_lists(grouped, hashes, scheme)), scheme).join(signed, "node")
    columns = "node long, n_shingles long, signature array<bigint>, posted long, component long, coordinate int, value long, pair long"
    names = [c.split()[0] for c in columns.split(", ")]

    def by_list(frame: DataFrame) -> DataFrame:
        return frame.repartition(*LIST).sortWithinPartitions(*LIST)

    near = stored(by_list(rows.select(*names)).mapInArrow(_candidates(scheme), columns))
    wanted = sets.join(near.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    full = near.join(wanted.select(F.col("id").alias("node"), "text_key", "hashes"), ["node"]).drop("text_key")
    crossing = by_list(full).mapInArrow(_links(scheme), "a long, b long")
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(crossing)


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept`` (it is that id)."""
    shared_folder(docs.sparkSession)
    ship_code(docs.sparkSession)
    sets = shingled(docs, scheme, key, text)
    columns = "id long, text_key string, n_shingles long, signature array<bigint>"
    signed = stored(sets.withColumn("n_shingles", F.size("hashes").cast("long")).mapInArrow(_sign(scheme), columns))
    classes = signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy("text_key").agg(
        F.min("id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    nodes = stored(classes)
    links = links_of(nodes.drop("text_key"), sets, scheme)
    roots = component_roots(links)
    classes = nodes.select("text_key", "node").join(roots, "node", "left").select("text_key", F.coalesce("root", "node").alias("root"))
    found = signed.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("text_key")).alias("text_key"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return found.join(classes, "text_key", "left").select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, scheme: Scheme = Scheme(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near copies, with its columns as they were.

    Rows are documents of their own, whatever their ids: of a component the row with the smallest id is kept, the one
    with the smallest row key among several, and rows without id only where no row has one. Rows without words stay.
    """
    shared_folder(docs.sparkSession)
    rows = with_row_keys(docs)
    texts = rows.select(ROW, F.col(BOXED)[text].alias("said"))
    found = near_duplicates(texts, scheme, ROW, "said").select(ROW, "component_id").join(rows.select(ROW, F.col(BOXED)[key].alias("id")), ROW)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)).alias("first")
    stay = found.groupBy("component_id").agg(first).select(f"first.{ROW}")
    return rows.join(stay, ROW, "left_semi").select(f"{BOXED}.*")
