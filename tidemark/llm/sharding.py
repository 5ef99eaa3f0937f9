"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

A row's slot is a hash of its identifier and never changes. Bytes and rows are
summed per slot, and a map gives each slot a shard so that the shards' bytes come
out even. The map is a small table with a version; rebalancing edits the newest
version (slots move from shards that hold too much) and stores the next.

Only DataFrame operations. The map has as many rows as there are slots, a fixed
number, so sorting it in one task does not grow with the data.

Defined results: a NULL text has no bytes and counts 1 like any row's overhead; a
NULL identifier is hashed like a value; repeated rows get places of their own; an
empty input gives no rows and a map of empty slots. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

SLOTS = 4096


def sized(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot of each row."""
    text = text_of()
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("vslot"),
    )


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """vslot, bytes, rows; slots without rows included."""
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(sums, "vslot", "left").na.fill(0, ["bytes", "rows"])


def edited_map(sizes: DataFrame, shards: int, before: DataFrame | None = None) -> DataFrame:
    """The next version of the map: version, vslot, shard, bytes, rows.

    A shard keeps its slots, largest first, as long as their sum stays within an
    even share. Slots that do not fit, and slots of shards that no longer exist,
    are free; from the largest to the smallest each goes to the shard with the
    fewest bytes (the lowest number if several).
    """
    if before is None:
        slots = sizes.select("*", F.lit(None).cast("int").alias("old"))
        version = F.lit(1)
    else:
        newest = before.select("vslot", F.when(F.col("shard") < shards, F.col("shard")).alias("old"), "version")
        slots = sizes.join(newest, "vslot", "left")
        version = F.coalesce(F.max("version").over(Window.partitionBy()), F.lit(0)) + 1
    share = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    order = Window.partitionBy("old").orderBy(F.desc("bytes"), "vslot")
    placed = slots.select(
        "vslot", "bytes", "rows", "old", version.cast("int").alias("version"), share.alias("share")
    ).select("*", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("held"))
    placed = placed.withColumn("stays", F.coalesce(F.col("old").isNotNull() & (F.col("held") <= F.col("share")), F.lit(False)))
    one = placed.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("bytes")).alias("less"), "vslot", "old", "stays", "rows", "version"))
        ).alias("slots")
    )
    shard_numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    kept_load = F.transform(
        shard_numbers,
        lambda s: F.aggregate(
            F.filter("slots", lambda x: x["stays"] & (x["old"] == s)), F.lit(0).cast("long"), lambda a, x: a - x["less"]
        ),
    )
    one = one.select("slots", kept_load.alias("load"))
    start = F.struct(F.col("load").alias("load"), F.array().cast("array<int>").alias("to"))

    def place(state, slot):
        lightest = (F.array_position(state["load"], F.array_min(state["load"])) - 1).cast("int")
        to = F.when(slot["stays"], slot["old"]).otherwise(lightest)
        load = F.transform(
            state["load"],
            lambda load, i: F.when(~slot["stays"] & (i == to), load - slot["less"]).otherwise(load),
        )
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(to)).alias("to"))

    done = one.select("slots", F.aggregate("slots", start, place)["to"].alias("to"))
    return done.select(F.inline(F.arrays_zip("slots", "to"))).select(
        "slots.version", "slots.vslot", F.col("to").alias("shard"), (-F.col("slots.less")).alias("bytes"), "slots.rows"
    )


def placed_rows(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with shard and place: the rows of a shard count from 0, slot by
    slot, by identifier within a slot."""
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "vslot")  # one row for each slot, a fixed number
        .withColumn("slot", (F.col("first") + F.col("nth") - 1).cast("long"))
        .drop("first", "nth")
    )


def shard_documents(documents: DataFrame, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard, slot of each document."""
    rows = stored(sized(documents, slots), "shard-sizes")
    slot_map = stored(edited_map(slot_sizes(rows, slots), shards), "shard-map")
    return placed_rows(rows, slot_map)
