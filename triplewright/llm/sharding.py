"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's virtual slot is a hash of the whole record (id and text) modulo a fixed number of
slots, so it never changes. Bytes are summed per slot, and the slots, not the records, are
assigned to shards: heaviest slot first, to the lightest shard. The map is stored with a
version; growing or rebalancing edits a few of its entries and adds a version, and only the
records of the edited slots move. A map has as many rows as slots, whatever the input.

Defined results: a null text has no bytes; null ids hash like any value. Equal records
share a slot and so a shard. An empty table gives a map with all slots and no bytes. Result
columns replace input columns of the same names.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplewright.session import materialize

N_SLOTS = 8192
# Bytes that a record takes besides its text.
RECORD_BYTES = 8
# Parts into which the rows of a slot are dealt for numbering.
N_PARTS = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long"


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(RECORD_BYTES)


def virtual_slot(*columns: str, n_slots: int = N_SLOTS) -> Column:
    """The fixed slot of a record."""
    return F.pmod(F.xxhash64(*columns), F.lit(n_slots)).cast("int")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot: one partial aggregation, at most one number per slot."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    return {row["virtual_slot"]: row["bytes"] for row in rows}


def first_map(sizes: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> dict[int, int]:
    """Slot -> shard: heaviest first, each to the lightest shard."""
    heap = [(0, 0, shard) for shard in range(n_shards)]
    assigned = {}
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, count, shard = heapq.heappop(heap)
        assigned[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), count + 1, shard))
    return assigned


def rebalanced_map(assigned: dict[int, int], sizes: dict[int, int], n_shards: int) -> dict[int, int]:
    """Edit a map for another number of shards, or for sizes that have changed.

    Shards beyond ``n_shards`` give up all slots. Then shards above the mean give slots to
    the lightest shard as long as that narrows the gap; all other entries stay.
    """
    edited = dict(assigned)
    load = dict.fromkeys(range(n_shards), 0)
    slots = defaultdict(list)
    homeless = []
    for slot, shard in sorted(assigned.items()):
        if shard < n_shards:
            load[shard] += sizes.get(slot, 0)
            slots[shard].append(slot)
        else:
            homeless.append(slot)
    light = [(bytes_, shard) for shard, bytes_ in load.items()]
    heapq.heapify(light)

    def give(slot: int) -> None:
        bytes_, shard = heapq.heappop(light)
        edited[slot], load[shard] = shard, bytes_ + sizes.get(slot, 0)
        heapq.heappush(light, (load[shard], shard))

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        give(slot)
    mean = sum(load.values()) / n_shards
    for shard in sorted(load, key=lambda s: (-load[s], s)):
        for slot in sorted(slots[shard], key=lambda s: (-sizes.get(s, 0), s)):
            size = sizes.get(slot, 0)
            if size and load[shard] - size >= mean and light[0][0] + size <= mean:
                load[shard] -= size
                light = [(load[s], s) for s in load]
                heapq.heapify(light)
                give(slot)
    return edited


def map_table(
    spark: SparkSession, versions: dict[int, dict[int, int]], sizes: dict[int, int]
) -> DataFrame:
    """All versions of a map as one stored table."""
    rows = [
        (version, slot, shard, sizes.get(slot, 0))
        for version, assigned in versions.items()
        for slot, shard in assigned.items()
    ]
    return materialize(spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1), "slot_map")


def assign(records: DataFrame, slot_map: DataFrame, version: int, column: str = "shard") -> DataFrame:
    """Add the shard that a version of the map gives. The map has one row per slot, hence the broadcast."""
    entries = slot_map.filter(F.col("version") == version).select("virtual_slot", F.col("shard").alias(column))
    return records.drop(column).join(F.broadcast(entries), "virtual_slot")


def number_in_shard(records: DataFrame, order: list[str]) -> DataFrame:
    """Add ``slot``: 0, 1, 2, … within each shard, without gaps.

    Rows are numbered within (virtual slot, part), many small groups, and shifted by the
    rows of the groups before them in the shard; a part is taken from where the row is read,
    so that even copies of one record are dealt over several groups. There are at most
    slots x parts shifts. ``records`` must be a stored table: it is read twice.
    """
    group = ["shard", "virtual_slot", "part"]
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        records.groupBy(*group)
        .agg(F.count("*").alias("n"))
        .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
    return records.withColumn("place", place).join(shifts, group).withColumn("slot", F.col("place") + F.col("shift")).drop("place", "shift")


def shard_table(df: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, virtual_slot, part, shard, grown): the assignment of every record.

    ``grown`` is the shard after the map was edited for one more shard.
    """
    records = materialize(
        df.select(
            F.col(key),
            record_size(F.col(text)).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
            virtual_slot(key, text).alias("virtual_slot"),
            F.pmod(F.spark_partition_id(), F.lit(N_PARTS)).alias("part"),
        ),
        "records",
    )
    sizes = slot_bytes(records)
    now = first_map(sizes, n_shards)
    versions = {1: now, 2: rebalanced_map(now, sizes, n_shards + 1)}
    slot_map = map_table(df.sparkSession, versions, sizes)
    return assign(assign(records, slot_map, 1), slot_map, 2, "rebalanced_shard")


def write_shards(df: DataFrame, table: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the records of ``df`` (unique keys) into one folder per shard, several files each."""
    placed = df.join(table.select(key, "shard", "part"), key)
    placed.repartition("shard", "part").drop("part").write.partitionBy("shard").parquet(path)
