"""Benchmark items found inside documents by SimHash fingerprints of item-sized windows.

Windows as long as an item are laid where a document shares a run of five words with it, in line with the shared
run; a window that is similar enough shares one, so none is missed. Each window has a fingerprint of eight 16-bit
blocks over its words. An index holds every block of every item with all patterns up to ``BLOCK_RADIUS`` flipped
bits: fingerprints within ``RADIUS`` bits must agree with one of them. Candidates within the radius are verified on
their five-word shingles, weighted by how often each occurs: common weight over united weight, ``percent`` at least.

Words are runs of letters and digits in lower case. Items without words match nothing, shorter ones than five words
are one shingle and found where these words stand in a row, in texts of any length. Null and empty texts hold nothing. Rows that share an id are searched as one document, rows without
an id are not reported; ``without_items`` searches each row by itself. Equal items are found under each of their ids.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.text import BOXED, ROW, shared_folder, shingle_hashes, stored, with_row_keys

SHINGLE = 5
BLOCKS, BLOCK_BITS = 8, 16
BLOCK_RADIUS = 3
#: Were all blocks off by more than the block radius, the whole would be off by more than this.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Rows up to which a table is broadcast; a row is below 100 bytes. Larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000


def _sized(frame: DataFrame) -> DataFrame:
    """A stored table, to be broadcast where it is small enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _fingerprint(tokens: Column) -> Column:
    """The blocks of a SimHash: bit by bit what most words of the window say."""
    hashes = F.transform(tokens, lambda w: F.struct(F.xxhash64(w).alias("x"), F.xxhash64(w, F.lit(1)).alias("y")))
    half = BLOCKS // 2

    def block(rows: Column, k: int) -> Column:
        part = F.transform(rows, lambda h: F.shiftright(h["x" if k < half else "y"], BLOCK_BITS * (k % half)))

        def bit(j: int) -> Column:
            ones = F.aggregate(part, F.lit(0).cast("long"), lambda n, h: n + F.shiftright(h, j).bitwiseAND(F.lit(1).cast("long")))
            return F.when(2 * ones > F.size(part), 1 << j).otherwise(0)

        return sum((bit(j) for j in range(1, BLOCK_BITS)), bit(0))

    return F.get(F.transform(F.array(hashes), lambda rows: F.array(*(block(rows, k) for k in range(BLOCKS)))), F.lit(0))


def _shingle_counts(frame: DataFrame, *keys: str) -> DataFrame:
    rows = frame.select(*keys, F.explode(shingle_hashes(F.col("w"), SHINGLE)).alias("shingle"))
    return rows.groupBy(*keys, "shingle").agg(F.count("*").alias("times"))


def _short_runs(tokens: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words, as ``shingle_hashes`` gives them for a text of so few words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(tokens, i, F.lit(n))), F.lit(n)))


def find_items(docs: DataFrame, items: DataFrame, percent: int = 80, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``(key, item_key, similarity, start, n_words, distance)``: each item's best window in each document that holds it."""
    shared_folder(docs.sparkSession)
    named = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), _words(F.col(text)).alias("w"))
    known = stored(items.select(F.col(item_key).alias("item"), _words(F.col(text)).alias("w")).where(F.size("w") > 0).withColumn("n", F.size("w")))

    anchors = known.select("item", "n", F.posexplode(shingle_hashes(F.col("w"), SHINGLE)).alias("at", "shingle"))
    anchors = stored(anchors.select("shingle", "n", "at").distinct())
    runs = named.select("doc", F.size("w").alias("doc_words"), F.posexplode(shingle_hashes(F.col("w"), SHINGLE)).alias("place", "shingle"))
    # Items below five words are runs of their own length; there are four such lengths at most.
    for row in known.where(F.col("n") < SHINGLE).select("n").distinct().collect():
        whole = named.where(F.size("w") >= row.n)
        runs = runs.union(whole.select("doc", F.size("w"), F.posexplode(_short_runs(F.col("w"), row.n))))
    latest = F.greatest(F.col("doc_words") - F.col("n"), F.lit(0))
    start = F.greatest(F.least(F.col("place") - F.col("at"), latest), F.lit(0))
    laid = stored(runs.join(_sized(anchors), "shingle").select("doc", "n", start.alias("start")).distinct())

    # Bounded by the spots themselves, since a document may hold any number of them.
    spots = stored(laid.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spots")))
    few = laid.count() <= BROADCAST_ROWS
    cut = named.join(F.broadcast(spots) if few else spots, "doc").select("doc", "w", F.explode("spots").alias("spot"))
    windows = cut.select("doc", "spot.start", "spot.n", F.slice("w", F.col("spot.start") + 1, F.col("spot.n")).alias("w"))
    windows = stored(windows.withColumn("blocks", _fingerprint(F.col("w"))))

    patterns = F.lit([p for p in range(1 << BLOCK_BITS) if p.bit_count() <= BLOCK_RADIUS])
    marked = known.withColumn("blocks", _fingerprint(F.col("w")))
    marked = stored(marked.select("item", "n", "blocks"))
    index = marked.select("item", "n", F.posexplode("blocks").alias("k", "value"))
    index = index.withColumn("value", F.explode(F.transform(patterns, lambda p: p.bitwiseXOR(F.col("value")))))
    probes = windows.select("doc", "start", "n", "blocks", F.posexplode("blocks").alias("k", "value"))
    item_blocks = _sized(marked.select("item", F.col("blocks").alias("item_blocks")))
    distance = F.aggregate(F.zip_with("blocks", "item_blocks", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, d: n + d)
    # The index is thousands of rows an item: always a shuffle join, whatever its size is taken for.
    met = probes.join(index.hint("merge"), ["k", "value", "n"]).select("doc", "start", "n", "blocks", "item").distinct()
    near = met.join(item_blocks, "item").where(distance <= RADIUS).select("doc", "start", "n", "item", distance.alias("distance"))

    ours = _shingle_counts(windows, "doc", "start", "n")
    theirs = _shingle_counts(known, "item").withColumnRenamed("times", "item_times")
    common = near.join(ours, ["doc", "start", "n"]).join(theirs, ["item", "shingle"]).groupBy("doc", "start", "n", "item", "distance").agg(
        F.sum(F.least("times", "item_times")).alias("common")
    )
    # A document shorter than the item has a window of all its words.
    size = windows.select("doc", "start", "n", F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1)).alias("size")).distinct()
    weight = F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)) + F.col("size") - F.col("common")
    alike = common.join(size, ["doc", "start", "n"]).where(100 * F.col("common") >= percent * weight)
    best = F.max(F.struct((F.col("common") / weight).alias("similarity"), (-F.col("start")).alias("place"), (-F.col("distance")).alias("distance")))
    return alike.groupBy("doc", "item", "n").agg(best.alias("best")).select(
        F.col("doc").alias(key), F.col("item").alias(item_key), "best.similarity",
        (-F.col("best.place")).alias("start"), F.col("n").alias("n_words"), (-F.col("best.distance")).alias("distance"),
    )


def without_items(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows that hold no item, with their columns as they were. Each row is searched by itself, whatever its id."""
    shared_folder(docs.sparkSession)
    rows = with_row_keys(docs)
    texts = rows.select(ROW, F.col(BOXED)[text].alias(text))
    found = find_items(texts, items, key=ROW, text=text).select(ROW).distinct()
    return rows.join(found, ROW, "left_anti").select(f"{BOXED}.*")
