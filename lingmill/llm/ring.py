"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `virtual_nodes` points on a ring of hashes. A key belongs to the first point clockwise
from its own hash; if that point's shard is full, it goes on to the next point whose shard is not. No
shard takes more than its bound, so balance is certain, and only overflowing keys leave their place.

Keys come in ring order, so the outcome does not depend on the order of rows. Because of that, keys
that pass over full shards keep their order, and the whole outcome is a list of runs: the next `n` keys
in ring order go to shard `s`. The list has at most two runs per point, whatever the number of keys. It
is worked out from the number of keys per arc, and each key finds its run by its rank in ring order.
All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize

#: Bits of a place on the ring.
RING_BITS = 52
#: Equal parts of the ring, or of the ranks, by which keys meet the arcs or runs that they may lie in.
CELLS = 4096


@dataclass(frozen=True)
class RingOptions:
    """`slack` is the room above an equal share: each shard takes at most (1 + slack) * rows / shards,
    rounded up. With 0 the bounds are the equal share rounded down or up and add up to the number of
    rows, so all shards are filled and differ by one row at most."""

    shards: int = 24
    virtual_nodes: int = 64
    slack: float = 0.0


def ring_place(key: Column) -> Column:
    """Place of a key on the ring, 0 to 2^52 - 1; NULL has the place of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, RING_BITS // 4), 16, 10).cast("long")


def ring_points(spark: SparkSession, options: RingOptions) -> DataFrame:
    """(arc, shard, low, high): the points in ring order; arc i holds the places in (low, high].

    Behind the last point lies one more arc, which belongs to the first point. The table has
    shards * virtual_nodes + 1 rows.
    """
    node = F.floor(F.col("id") / options.shards)
    points = spark.range(options.shards * options.virtual_nodes).select(
        (F.col("id") % options.shards).cast("int").alias("shard"), node.alias("node")
    )
    label = F.concat(F.lit("shard "), "shard", F.lit(" node "), "node")
    order = Window.partitionBy(F.lit(0)).orderBy("high", "shard", "node")
    arcs = points.withColumn("high", ring_place(label)).select(
        (F.row_number().over(order) - 1).alias("arc"),
        "shard",
        F.coalesce(F.lag("high").over(order), F.lit(-1)).alias("low"),
        "high",
    )
    behind = arcs.groupBy().agg(
        (F.max("arc") + 1).alias("arc"),
        F.min_by("shard", "arc").alias("shard"),
        F.max("high").alias("low"),
        F.lit(1 << RING_BITS).cast("long").alias("high"),
    )
    return arcs.unionByName(behind)


def _by_cells(spans: DataFrame, low: Column, high: Column, width: int) -> DataFrame:
    """`spans` once for every cell that [low, high] touches: spans + CELLS rows at most."""
    return spans.select("*", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))).alias("cell"))


def _runs(loads: DataFrame, rows: int, options: RingOptions) -> DataFrame:
    """(first, last, shard, slot): runs of ranks and the slot of their first key. One input row per arc.

    The arcs are gone through clockwise twice. At each point the keys that wait come first, then those of
    its arc; its shard takes what it has room for, the rest waits on. The second time only those that wait
    are left, and as there is room for all keys, none is left after it.
    """
    shards = F.sequence(F.lit(0), F.lit(options.shards - 1))
    if options.slack:
        bound = F.lit(math.ceil(rows * (1 + options.slack) / options.shards))
        room = F.transform(shards, lambda s: bound.cast("long"))
    else:
        small, large = divmod(rows, options.shards)
        room = F.transform(shards, lambda s: F.when(s < large, small + 1).otherwise(small).cast("long"))
    once = F.array_sort(F.collect_list(F.struct("arc", "shard", "load")))
    again = F.transform(once, lambda x: F.struct(x["arc"], x["shard"], F.lit(0).cast("long").alias("load")))
    start = F.struct(
        room.alias("room"), F.lit(0).cast("long").alias("waiting"), F.array().cast("array<bigint>").alias("taken")
    )

    def step(state: Column, point: Column) -> Column:
        come = state["waiting"] + point["load"]
        taken = F.least(come, F.get(state["room"], point["shard"]))
        left = F.transform(
            state["room"], lambda r, s: F.when(s == point["shard"], r - taken).otherwise(r)
        )
        return F.struct(
            left.alias("room"),
            (come - taken).alias("waiting"),
            F.concat(state["taken"], F.array(taken)).alias("taken"),
        )

    walked = loads.groupBy().agg(F.concat(once, again).alias("points"))
    steps = walked.select("points", F.aggregate("points", start, step)["taken"].alias("taken")).select(
        F.posexplode(F.arrays_zip("points", "taken"))
    )
    # two rows per arc: a bounded table
    order = Window.partitionBy(F.lit(0)).orderBy("pos")
    own = Window.partitionBy("shard").orderBy("pos")
    taken = steps.select("pos", F.col("col.points.shard").alias("shard"), F.col("col.taken").alias("taken"))
    return taken.filter("taken > 0").select(
        "shard",
        (F.sum("taken").over(order) - F.col("taken")).alias("first"),
        (F.sum("taken").over(order) - 1).alias("last"),
        (F.sum("taken").over(own) - F.col("taken")).alias("slot"),
    )


def _in_ring_order(keys: DataFrame) -> DataFrame:
    """`keys` with `rank`, 0, 1, 2, ... in ring order: sorted by range, then counted within each range.

    `tie` parts equal keys, so that a range boundary can lie between them.
    """
    order = ["place", "crc", "size", "id", "tie"]
    # the number has the partition above bit 33 and the place within it below
    number = F.monotonically_increasing_id()
    dealt = materialize(
        keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", number)
    ).withColumn("part", F.shiftright("number", 33))
    parts = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per partition
    offsets = dealt.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(parts) - F.col("n")).alias("before")
    )
    place = F.col("number") - F.shiftleft(F.col("part"), 33)
    return dealt.join(offsets, "part").withColumn("rank", F.col("before") + place)


def ring_shards(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", options: RingOptions = RingOptions()
) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot (0, 1, 2, ... within a shard).

    `size` is the UTF-8 bytes of the text plus 8, NULL counting none; `text_crc32` is NULL for NULL. The key
    is the id as text, NULL being the empty key. Rows of one place follow each other by text_crc32, size
    and id; equal rows may change places, which nobody can see. A key that holds a third of all
    rows is spread as any other rows are: ranks, not keys, are dealt out. An empty table gives an
    empty result. Other columns are neither read nor returned.
    """
    spark = docs.sparkSession
    keys = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        ring_place(F.col(id_col)).alias("place"),
        # parts equal rows; written at once, so that a second reading finds the same numbers
        F.monotonically_increasing_id().alias("tie"),
    )
    keys = materialize(keys)
    width = (1 << RING_BITS) // CELLS
    points = materialize(ring_points(spark, options))
    # bounded by the options: one row per arc and cell touched
    spans = F.broadcast(_by_cells(points, F.col("low") + 1, F.col("high"), width))
    place, cell = F.col("place"), F.floor(F.col("place") / width)
    loads = (
        keys.select("place", cell.alias("cell"))
        .join(spans, "cell")
        .filter((place > F.col("low")) & (place <= F.col("high")))
        .groupBy("arc")
        .agg(F.count("*").alias("load"))
    )
    loads = materialize(
        points.join(loads, "arc", "left").select("arc", "shard", F.coalesce("load", F.lit(0).cast("long")).alias("load"))
    )
    rows = loads.agg(F.sum("load")).first()[0]
    step = max(1, -(-rows // CELLS))
    runs = materialize(_runs(loads, rows, options))
    blocks = F.broadcast(_by_cells(runs, F.col("first"), F.col("last"), step))
    rank = F.col("rank")
    return (
        _in_ring_order(keys)
        .withColumn("cell", F.floor(rank / step))
        .join(blocks, "cell")
        .filter((rank >= F.col("first")) & (rank <= F.col("last")))
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("slot") + rank - F.col("first")).alias("slot"),
        )
    )
