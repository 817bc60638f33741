"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns virtual nodes at fixed places of the ring; a key belongs to the next node clockwise. A shard may
take ``rows / shards`` keys, rounded so that counts differ by one at most, and its room is dealt to its nodes in
proportion to their arcs. A key that finds its node full continues clockwise to the next free room. Nodes keep
their own keys first, so only what overflows moves.

Overflow is settled on counts per node (``shards * nodes`` rows, whatever the input): overflowing keys and free
rooms are both numbered clockwise, starting where no key passes, and the k-th key takes the k-th room. Keys are
ranked along the ring by one global order of rows, which is cut into even ranges and numbered by the sizes of these,
so rows that share an id, or have none, spread over tasks like all others.

Null ids hash as empty text; equal ids share a place and are told apart by checksum and size, exact copies in any order.
No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftlens.llm.text import shared_folder, stored
from shiftlens.operators.ordering import POSITION, globally_ordered

RING_BITS, CELL_BITS = 32, 20
NODES_A_SHARD = 64


def ring_place(key: Column) -> Column:
    """The first 32 bits of MD5: a place that any engine can compute."""
    return F.conv(F.substring(F.md5(key), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, nodes: int = NODES_A_SHARD) -> DataFrame:
    """Virtual nodes ``(node, shard, lo, hi)`` clockwise; a node owns the places in ``(lo, hi]``, the first one wraps."""
    ids = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        ring_place(F.concat_ws("/", F.lit("node"), F.col("id").cast("string"))).alias("hi"),
    )
    clockwise = Window.orderBy("hi", "shard")
    return ids.select(
        (F.row_number().over(clockwise) - 1).alias("node"), "shard",
        F.lag("hi", 1, -1).over(clockwise).alias("lo"), "hi",
    )


def _places(nodes: DataFrame) -> DataFrame:
    """The stretches of the ring with their node, cut at cells, so that a key finds its node by an equi-join."""
    top = (1 << RING_BITS) - 1
    last = nodes.agg(F.max("hi").alias("lo")).select(F.lit(0).alias("node"), "lo", F.lit(top).cast("long").alias("hi"))
    stretches = nodes.select("node", "lo", "hi").union(last).where("hi > lo")
    cell = F.explode(F.sequence(F.shiftright(F.col("lo") + 1, CELL_BITS), F.shiftright("hi", CELL_BITS)))
    return stretches.select("node", "lo", "hi", cell.alias("cell"))


def _loads(nodes: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """``keys`` and ``room`` of each node: a shard's share of the rows, dealt along its arcs by rounding their running sum."""
    arc = F.when(F.col("node") == 0, F.col("hi") - F.max("hi").over(Window.partitionBy()) + (1 << RING_BITS)).otherwise(F.col("hi") - F.col("lo"))
    along = Window.partitionBy("shard").orderBy("node")
    whole = "decimal(18,0)"
    share = F.expr(f"rows div {shards}") + F.when(F.col("shard") < F.col("rows") % shards, 1).otherwise(0)
    upto_room = F.floor(share.cast(whole) * F.col("upto").cast(whole) / F.col("all").cast(whole)).cast("long")
    return (
        nodes.join(counts, "node", "left").na.fill(0, ["keys"])
        .withColumns({"arc": arc, "rows": F.sum("keys").over(Window.partitionBy())})
        .withColumns({"upto": F.sum("arc").over(along), "all": F.sum("arc").over(Window.partitionBy("shard"))})
        .withColumn("upto_room", upto_room)
        .select("node", "shard", "keys", "node_first", (F.col("upto_room") - F.coalesce(F.lag("upto_room").over(along), F.lit(0))).alias("room"))
    )


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", nodes_a_shard: int = NODES_A_SHARD) -> DataFrame:
    """Per row: the key, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless from 0 in each shard) and ``moved``.

    ``moved`` tells whether the key overflowed its own node. The law that holds is on counts: at most one apart.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    nodes = ring(spark, shards, nodes_a_shard)
    said = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"), (F.octet_length(said) + 8).cast("long").alias("size"),
        F.crc32(said.cast("binary")).alias("text_crc32"),
        ring_place(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("place"),
    ).withColumn("cell", F.shiftright("place", CELL_BITS))
    stretches = F.broadcast(_places(nodes))  # one row a node and cell: about 2 ** 12 + nodes
    homed = rows.join(stretches, "cell").where("place > lo AND place <= hi").drop("cell", "lo", "hi")

    # Dealt by the row's place in the input, so that copies of a row fall into several ranges.
    dealt = homed.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    along = ["node", "place", "_key", "text_crc32", "size", "deal"]
    in_order = globally_ordered(dealt, [F.col(c) for c in along], "sharding").rows

    counts = in_order.groupBy("node").agg(F.count("*").alias("keys"), F.min(POSITION).alias("node_first"))
    loads = stored(_loads(nodes, counts, shards))  # one row a node

    # Clockwise from the node after which the fewest keys pass on.
    passed = Window.orderBy("node")
    flow = loads.withColumn("flow", F.sum(F.col("keys") - F.col("room")).over(passed))
    start = F.max(F.struct(-F.col("flow"), F.col("node"))).over(Window.partitionBy())["node"]
    turned = flow.withColumn("step", F.pmod(F.col("node") - start - 1, F.lit(shards * nodes_a_shard)))
    upto = Window.orderBy("step")
    spare = turned.withColumns({
        "over": F.greatest(F.col("keys") - F.col("room"), F.lit(0)),
        "free": F.greatest(F.col("room") - F.col("keys"), F.lit(0)),
    }).withColumns({"over_hi": F.sum("over").over(upto), "free_hi": F.sum("free").over(upto)})
    own = F.least("keys", "room")
    # Slots of a shard: all that nodes keep, then the rooms taken by overflow, both clockwise.
    in_shard = Window.partitionBy("shard").orderBy("step")
    spare = spare.withColumns({
        "own_hi": F.sum(own).over(in_shard), "own": own, "shard_own": F.sum(own).over(Window.partitionBy("shard")),
        "shard_free_hi": F.sum("free").over(in_shard),
    })
    stay = spare.where("own > 0").select(
        "node", "shard", F.lit(0).cast("long").alias("first"), F.col("own").alias("after"),
        (F.col("own_hi") - F.col("own")).alias("slot_first"),
    )
    # Both sides are one row a node: an overflow stretch meets the rooms whose numbers it covers.
    edges = spare.select(F.explode(F.array("over_hi", "free_hi")).alias("edge")).distinct()
    ordered = Window.orderBy("edge")
    cuts = edges.select(F.col("edge").alias("cut_hi"), F.lag("edge", 1, 0).over(ordered).alias("cut_lo")).where("cut_hi > cut_lo")
    sources = spare.where("over > 0").select(F.col("over_hi").alias("cut_hi"), F.struct("node", "room", (F.col("over_hi") - F.col("over")).alias("lo")).alias("source"))
    targets = spare.where("free > 0").select(
        F.col("free_hi").alias("cut_hi"),
        F.struct("shard", (F.col("free_hi") - F.col("free")).alias("lo"), (F.col("shard_own") + F.col("shard_free_hi") - F.col("free")).alias("slot")).alias("target"),
    )
    onward = Window.orderBy("cut_hi").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = cuts.join(sources, "cut_hi", "left").join(targets, "cut_hi", "left").select(
        "cut_lo", "cut_hi",
        F.first("source", ignorenulls=True).over(onward).alias("source"),
        F.first("target", ignorenulls=True).over(onward).alias("target"),
    )
    first = F.col("source.room") + F.col("cut_lo") - F.col("source.lo")
    leave = taken.select(
        F.col("source.node").alias("node"), F.col("target.shard").alias("shard"), first.alias("first"),
        (first + F.col("cut_hi") - F.col("cut_lo")).alias("after"),
        (F.col("target.slot") + F.col("cut_lo") - F.col("target.lo")).alias("slot_first"),
    )
    plan = F.broadcast(stay.withColumn("moved", F.lit(False)).union(leave.withColumn("moved", F.lit(True))))

    firsts = F.broadcast(loads.select("node", "node_first"))
    ranked = in_order.join(firsts, "node").withColumn("rank", F.col(POSITION) - F.col("node_first"))
    placed = ranked.join(plan, "node").where("rank >= first AND rank < after")
    return placed.select(
        F.col("_key").alias(key), "size", "text_crc32", "shard",
        (F.col("slot_first") + F.col("rank") - F.col("first")).cast("long").alias("slot"), "moved",
    )
