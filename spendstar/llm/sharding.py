"""Sharding by fixed virtual slots and a stored, versioned slot map.

Records hash by key into a fixed number of virtual slots. A table maps each
slot to a shard; bytes and rows are aggregated per slot beside it. Rebalancing
edits the map only: each edit writes a new version (Parquet, folder
``version=<n>``), and a record moves only if its slot did. Growing by one shard
gives the new shard its even share of slots, taken from the fullest shards
first, so no record moves between old shards. The starting map and the growth
edits depend on the number of shards alone (law ``key``); ``move_heavy_slots``
is the edit that looks at bytes.

Scale: every record is hashed where it is read. A shard's rows are numbered by
numbering each virtual slot on its own and adding the slot's offset within its
shard, so no task holds a shard. The map has one row per virtual slot.

Defined cases: a null key is a key of its own; a null text has no bytes; rows
with one key share a slot, in the order of their text hashes. Output columns
replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import md5_number

SLOTS = 8192


def slot_of(key, slots: int = SLOTS):
    """Virtual slot of a key column; a null key hashes as a key of its own."""
    text = F.when(key.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), key.cast("string")))
    return F.pmod(md5_number(text), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt round robin. Columns vslot, shard, version."""
    return spark.range(slots).select(F.col("id").cast("int").alias("vslot"),
                                     F.pmod("id", F.lit(shards)).cast("int").alias("shard"),
                                     F.lit(1).alias("version"))


def grow_map(slot_map: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The next version with shard number ``shards`` added to ``shards`` old
    ones: the new shard takes floor(slots / (shards + 1)) slots, from the
    fullest shards first, by slot hash."""
    mixed = md5_number(F.concat(F.lit("move"), F.col("vslot").cast("string")))
    place = F.row_number().over(Window.partitionBy("shard").orderBy(mixed, "vslot"))
    take = slots // (shards + 1)
    ranked = slot_map.withColumn("__place", place)
    # one row per virtual slot: the map is bounded by its fixed number of slots
    order = F.row_number().over(Window.orderBy(F.col("__place").desc(), "shard"))
    return ranked.withColumn("__order", order).select(
        "vslot", F.when(F.col("__order") <= take, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"),
        (F.col("version") + 1).alias("version"))


def slot_sizes(records: DataFrame, vslot: str, size: str) -> DataFrame:
    """Rows and bytes per virtual slot (aggregated map-side)."""
    return records.groupBy(F.col(vslot).alias("vslot")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).cast("long").alias("bytes"))


def move_heavy_slots(slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """The next version, rebalanced by bytes: shards above the mean give up
    slots, heaviest first, while they stay at or above it; the slots go to the
    shards below the mean, by the same running bytes. One edit narrows the
    spread; repeat it to narrow it further."""
    full = slot_map.join(sizes, "vslot", "left").fillna({"bytes": 0, "rows": 0})
    per = full.groupBy("shard").agg(F.sum("bytes").alias("__b"))
    mean = per.agg(F.avg("__b").alias("__mean"))
    per = per.withColumn("__mean", mean.scalar())
    run = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
                              .rowsBetween(Window.unboundedPreceding, 0))
    giving = (full.join(per, "shard").filter(F.col("__b") > F.col("__mean"))
                  .withColumn("__run", run).filter(F.col("__run") <= F.col("__b") - F.col("__mean")))
    # positions on one line: bytes given up so far, room found so far (rows: at most one per slot)
    giving = giving.withColumn("__at", F.sum("bytes").over(
        Window.orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes") / 2)
    room = per.filter(F.col("__b") < F.col("__mean")).withColumn("__room", F.col("__mean") - F.col("__b"))
    room = room.withColumn("__to", F.sum("__room").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)))
    room = room.select(F.col("shard").alias("__new"), (F.col("__to") - F.col("__room")).alias("__from"), "__to")
    moved = giving.join(room, (F.col("__at") >= F.col("__from")) & (F.col("__at") < F.col("__to"))) \
                  .select("vslot", "__new")
    return slot_map.join(moved, "vslot", "left").select(
        "vslot", F.coalesce("__new", "shard").cast("int").alias("shard"), (F.col("version") + 1).alias("version"))


def store_map(slot_map: DataFrame, sizes: DataFrame | None, folder: str, version: int) -> DataFrame:
    """Write one version of the map (with the slots' rows and bytes) and read it back."""
    out = slot_map.drop("version")
    if sizes is not None:
        out = out.join(sizes, "vslot", "left").fillna({"rows": 0, "bytes": 0})
    path = f"{folder.rstrip('/')}/version={version}"
    out.coalesce(1).write.mode("errorifexists").parquet(path)
    return slot_map.sparkSession.read.parquet(path).withColumn("version", F.lit(version))


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/version={version}").withColumn("version", F.lit(version))


def assign(records: DataFrame, slot_map: DataFrame, key: str = "doc_id", text: str = "text",
           slots: int = SLOTS, grown: DataFrame | None = None) -> DataFrame:
    """``records`` with ``vslot``, ``shard``, ``slot`` (place in the shard,
    gapless from 0) and, if ``grown`` is given, ``grown_shard``. The map (one
    row per virtual slot) is the side that is broadcast: its size is fixed."""
    made = ("vslot", "shard", "slot", "grown_shard")
    rows = records.select(*[c for c in records.columns if c not in made])
    rows = rows.withColumn("vslot", slot_of(F.col(key), slots))
    maps = slot_map.select("vslot", "shard")
    if grown is not None:
        maps = maps.join(grown.select("vslot", F.col("shard").alias("grown_shard")), "vslot")
    else:
        maps = maps.withColumn("grown_shard", F.lit(None).cast("int"))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy(key, F.xxhash64(F.col(text))))
    ranked = rows.withColumn("__rank", rank)
    counts = rows.groupBy("vslot").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("vslot")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")
    # as many rows as there are virtual slots: bounded, so safe to broadcast
    offsets = counts.join(F.broadcast(maps), "vslot").withColumn("__before", before).drop("__n")
    return (ranked.join(F.broadcast(offsets), "vslot")
                  .withColumn("slot", (F.col("__before") + F.col("__rank") - 1).cast("long"))
                  .drop("__rank", "__before"))
