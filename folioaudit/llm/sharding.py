"""Consistent-hash ring with virtual nodes and bounded loads (operator 1).

A key goes to the first virtual node clockwise of its hash. A full shard passes
keys on, clockwise, so that no shard holds more than its share. How many keys
of each ring segment end on which shard follows from the segments' key counts
alone: one row per segment, a number that does not grow with the data. Keys
then find their shard by their rank within the segment.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
VIRTUAL_NODES = 64  # per shard
RING = 2**32
LAW = "rows"  # what the bound holds for: numbers of rows


def _point(*parts: Column) -> Column:
    """A place on the ring."""
    return F.pmod(F.xxhash64(*parts), F.lit(RING))


def ring(spark: SparkSession, shards: int, virtual: int) -> list[tuple[int, int]]:
    """Virtual nodes by place, ``(place, shard)``: as many as the parameters say."""
    shard = (F.col("id") % shards).cast("int")
    nodes = spark.range(shards * virtual).select(_point(F.lit("node"), shard, F.floor(F.col("id") / shards)).alias("place"), shard.alias("shard"))
    return [(r["place"], r["shard"]) for r in nodes.orderBy("place", "shard").collect()]


def walks(nodes: list[tuple[int, int]]) -> list[list[int]]:
    """Shards in the order in which a walk from each node meets them first."""
    own = [shard for _, shard in nodes]
    return [list(dict.fromkeys(own[s:] + own[:s])) for s in range(len(own))]


def segment_of(point: Column, nodes: list[tuple[int, int]]) -> Column:
    """Number of the first node at or after ``point``; behind the last comes the first.

    Halving the sorted places takes as many steps as their number has bits.
    """
    places = F.lit([place for place, _ in nodes])

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = F.get(places, middle) < point
        going = state["low"] < state["high"]
        return F.struct(
            F.when(going & right, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(going & ~right, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(nodes)).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(len(nodes).bit_length())), start, halve, lambda s: s["low"])
    return F.pmod(found, F.lit(len(nodes)))


def _allotments(counts: DataFrame, nodes: list[tuple[int, int]], shards: int, slack: float) -> DataFrame:
    """``segment, shard, low, high, base``: ranks of a segment's keys that a shard takes.

    Keys are admitted in ring order. Each segment fills its own shard first and
    then those that follow clockwise. Without slack the first ``n mod shards``
    shards take one row more than the others and all end up full.
    """
    one = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("segment", "n"))).alias("held"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    share = F.floor(F.col("total") / shards)
    if slack > 0:
        room = F.array_repeat(F.ceil(F.col("total") * (1 + slack) / shards), shards)
    else:
        extra = F.col("total") - share * shards
        room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: share + F.when(s < extra, 1).otherwise(0))
    one = one.select("held", room.alias("room"), F.lit(walks(nodes)).alias("walks"))
    taken = F.struct(
        F.lit(0).cast("long").alias("left"),
        F.transform("room", lambda r: F.lit(0).cast("long")).alias("load"),
        F.array().cast("array<struct<segment:int,shard:int,low:bigint,high:bigint,base:bigint>>").alias("out"),
    )

    def visit(state: Column, at: Column) -> Column:
        """One segment and one shard of its walk."""
        shard = at["shard"]
        asked = F.when(at["first"], at["n"]).otherwise(state["left"])
        load = F.get(state["load"], shard)
        take = F.least(asked, F.get(F.col("room"), shard) - load)
        entry = F.struct(
            at["segment"].alias("segment"),
            shard.alias("shard"),
            (at["n"] - asked).alias("low"),
            (at["n"] - asked + take).alias("high"),
            load.alias("base"),
        )
        return F.struct(
            (asked - take).alias("left"),
            F.transform(state["load"], lambda x, k: F.when(k == shard, x + take).otherwise(x)).alias("load"),
            F.when(take > 0, F.concat(state["out"], F.array(entry))).otherwise(state["out"]).alias("out"),
        )

    stop = lambda shard, k, s: F.struct(
        s.alias("segment"), shard.alias("shard"), (k == 0).alias("first"), F.try_element_at("held", s).alias("n")
    )
    stops = F.flatten(F.transform("walks", lambda walk, s: F.transform(walk, lambda shard, k: stop(shard, k, s))))
    one = one.select("room", F.filter(stops, lambda x: x["n"] > 0).alias("stops"))
    return one.select(F.explode(F.aggregate("stops", taken, visit, lambda s: s["out"])).alias("x")).select("x.*")


def shard(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL_NODES, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot`` for every row of ``docs``.

    ``slack`` is the part by which a shard may exceed the mean; 0 gives counts
    at most one apart. A NULL text counts as no bytes: size 1, checksum 0. Rows with a
    NULL ``doc_id`` and rows that repeat one are keys like any other: equal rows
    are counted before they are dealt out and numbered from that count, so no
    task gathers them. An empty table gives no rows.
    """
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    keys = read.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("rows"))
    nodes = ring(docs.sparkSession, shards, virtual)
    placed = keys.withColumn("point", _point(F.lit("key"), F.col("doc_id")))
    placed = placed.withColumn("segment", segment_of(F.col("point"), nodes))
    counts = placed.groupBy("segment").agg(F.sum("rows").alias("n"))
    dealt = _allotments(counts, nodes, shards, slack)
    order = Window.partitionBy("segment").orderBy("point", "doc_id", "size", "text_crc32")
    ranked = placed.withColumn("to", F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("from", F.col("to") - F.col("rows"))
    # Rows here: at most segments times shards, whatever the data.
    met = ranked.join(F.broadcast(dealt), "segment").filter((F.col("from") < F.col("high")) & (F.col("to") > F.col("low")))
    first = F.greatest("from", "low")
    slots = F.sequence(first, F.least("to", "high") - 1)
    return met.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.explode(F.transform(slots, lambda r: F.col("base") + r - F.col("low"))).alias("slot"),
    )


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: keys, and how many of them two assignments place differently."""
    was = before.select("doc_id", F.col("shard").alias("_was"))
    return was.join(after.select("doc_id", "shard"), "doc_id").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_was") != F.col("shard")).alias("moved")
    )
