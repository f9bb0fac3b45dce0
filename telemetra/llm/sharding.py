"""Shards by fixed virtual slots and a versioned map from slots to shards.

Records hash into thousands of slots once and for all. The bytes of each slot are summed, and a map
that sends every slot to a shard is made from those sums. Rebalancing edits the map and writes it as
a new version; it never hashes a record again. A map also lists the groups of equal texts that are too
large for one shard: each record of such a group goes where the map sends the slot of its id. The list
is made with the first map and stored in it, so records that come later change no place of earlier
ones. Everything that touches records is built-in expressions; the driver only sees one sum per slot,
and their number is fixed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

VIRTUAL_SLOTS = 4096
#: Bytes that one record counts besides its text.
RECORD_BYTES = 8
#: Rows that are numbered together; larger slots are numbered in parts.
ROWS_NUMBERED = 50_000


def fixed_array(values: Iterable[int]) -> Column:
    """A constant array; its length is the number of slots."""
    return F.expr(f"array({','.join(map(str, values))})")


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot, and which groups of equal texts are spread, as of a version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    spread: tuple[int, ...] = ()

    def column(self, slot: Column) -> Column:
        return F.get(fixed_array(self.shard_of), slot)

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row per slot, and a row per spread group with its hash in place of a slot."""
        places = [(slot, shard, None) for slot, shard in enumerate(self.shard_of)]
        groups = [(None, None, group) for group in self.spread]
        lines = spark.createDataFrame(places + groups, "virtual_slot int, shard int, spread_group bigint")
        return lines.select(F.lit(self.version).alias("version"), F.lit(self.shards).alias("shards"), "*")


def slot_of(*key: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    """The virtual slot of a record, from a hash of its key."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + RECORD_BYTES


def slot_sums(records: DataFrame, slots: int = VIRTUAL_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot of a frame with ``placed_by`` and ``size``: two lists of fixed length."""
    sizes, counts = [0] * slots, [0] * slots
    for line in records.groupBy("placed_by").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        sizes[line["placed_by"]], counts[line["placed_by"]] = line["b"], line["n"]
    return sizes, counts


def first_map(sizes: list[int], shards: int, spread: Iterable[int] = ()) -> SlotMap:
    """Largest slots first, each to the shard with the fewest bytes."""
    load = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        held, shard = heapq.heappop(load)
        shard_of[slot] = shard
        heapq.heappush(load, (held + sizes[slot], shard))
    return SlotMap(1, shards, tuple(shard_of), tuple(sorted(spread)))


def rebalanced(current: SlotMap, sizes: list[int], shards: int) -> SlotMap:
    """The next version of a map for ``shards`` shards, moving slots only while that evens the bytes out.

    With more shards than before, only the new ones take slots, from the fullest shards. With fewer,
    the slots of the shards that go are dealt to the emptiest ones.
    """
    shard_of = list(current.shard_of)
    held = [0] * max(shards, current.shards)
    slots_in: list[list[int]] = [[] for _ in held]
    for slot, shard in enumerate(shard_of):
        held[shard] += sizes[slot]
        slots_in[shard].append(slot)

    def move(slot: int, to: int) -> None:
        slots_in[shard_of[slot]].remove(slot)
        held[shard_of[slot]] -= sizes[slot]
        shard_of[slot] = to
        held[to] += sizes[slot]
        slots_in[to].append(slot)

    for gone in range(shards, current.shards):
        for slot in sorted(slots_in[gone], key=lambda s: (-sizes[s], s)):
            move(slot, min(range(shards), key=lambda s: (held[s], s)))
    takers = range(current.shards, shards) if shards > current.shards else range(shards)
    while True:
        full = max(range(shards), key=lambda s: (held[s], -s))
        empty = min(takers, key=lambda s: (held[s], s))
        gap = held[full] - held[empty]
        # A slot smaller than the gap narrows it; the one nearest to half of it narrows it most.
        useful = [s for s in slots_in[full] if 0 < sizes[s] < gap]
        if not useful:
            break
        move(min(useful, key=lambda s: (abs(2 * sizes[s] - gap), s)), empty)
    return SlotMap(current.version + 1, shards, tuple(shard_of), current.spread)


def write_map(spark: SparkSession, slot_map: SlotMap, folder: str) -> None:
    """Adds a version to the stored maps; earlier versions stay readable."""
    slot_map.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={slot_map.version:06d}")


def read_map(spark: SparkSession, folder: str, version: int) -> SlotMap:
    lines = spark.read.parquet(f"{folder}/version={version:06d}").orderBy("virtual_slot", "spread_group").collect()
    shard_of = tuple(line["shard"] for line in lines if line["virtual_slot"] is not None)
    spread = tuple(line["spread_group"] for line in lines if line["virtual_slot"] is None)
    return SlotMap(version, lines[0]["shards"], shard_of, spread)


def groups_to_spread(base: DataFrame, shards: int) -> list[int]:
    """Hashes of the texts whose records hold more than a quarter of a shard's bytes: at most 4 * ``shards``."""
    total = base.agg(F.sum("size")).first()[0] or 0
    heavy = base.groupBy("text_hash").agg(F.sum("size").alias("group_size"))
    heavy = heavy.where(F.col("group_size") > max(1, total // (4 * shards)))
    return [line["text_hash"] for line in heavy.select("text_hash").collect()]


def assign(
    docs: DataFrame,
    shards: int = 24,
    slots: int = VIRTUAL_SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_map: SlotMap | None = None,
) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version)`` per record.

    The law is ``bytes``: shards hold nearly equal sums of ``size``. Equal texts share a virtual slot,
    whatever else the table holds, and so a shard; the records of a group that the map spreads go to the
    shards of the slots of their ids, which keeps the law. Without ``slot_map`` a first map is made, which
    spreads the groups of more than a quarter of a shard's bytes; a stored map is used as it is, with
    ``slots`` as many as it has. ``slot`` numbers the records of a shard from 0 without gaps.
    ``grown_shard`` is null, as only a law by key defines it. A null text has size 8 and checksum 0, a null
    id is hashed like a value, repeated rows are placed each, an empty table gives no rows, other columns
    are not read.
    """
    text = F.col(text_col)
    base = docs.select(
        F.col(id_col),
        record_size(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    slots = len(slot_map.shard_of) if slot_map else slots
    spread = slot_map.spread if slot_map else groups_to_spread(base, shards)
    by_text = slot_of("text_hash", slots=slots)
    by_id = slot_of(F.col("text_hash"), F.col(id_col), slots=slots)
    placed = base.withColumn("virtual_slot", by_text).withColumn(
        "placed_by", F.when(F.col("text_hash").isin(list(spread)), by_id).otherwise(by_text) if spread else by_text
    )
    sizes, counts = slot_sums(placed, slots)
    slot_map = slot_map or first_map(sizes, shards, spread)

    # Numbers: rows of a part of a slot, after all rows of earlier parts of the same shard.
    parts = [max(1, -(-n // ROWS_NUMBERED)) for n in counts]
    of_slot = F.get(fixed_array(parts), F.col("placed_by"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), F.col(id_col)), of_slot).cast("int"))
    placed = placed.withColumn("shard", slot_map.column(F.col("placed_by")))
    cells = placed.groupBy("shard", "placed_by", "part").agg(F.count("*").alias("cell_rows"))
    in_shard = Window.partitionBy("shard").orderBy("placed_by", "part")
    earlier = cells.select(
        "placed_by",
        "part",
        (F.sum("cell_rows").over(in_shard) - F.col("cell_rows")).alias("before"),
    )
    in_cell = Window.partitionBy("placed_by", "part").orderBy(id_col, "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(in_cell))
    return numbered.join(earlier, ["placed_by", "part"]).select(
        F.col(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("nth") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(slot_map.version).alias("map_version"),
    )
