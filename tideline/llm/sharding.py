"""Sharding by fixed virtual slots.

A record belongs for good to one of `SLOTS` virtual slots, by a hash of its id, its text's checksum and its size. A slot map says which shard owns
each slot; it is a small versioned table. Bytes and rows are summed per slot, with partial sums in the map tasks, and the
map is edited by moving whole slots: `balanced` moves slots from shards with too many bytes to those with too few,
`grown` adds a shard that takes slots from the others while none moves between those. Every edit is a new version.
Only the slots' sums (SLOTS rows) reach the driver.

The law is `bytes`: the shards' bytes are near equal, to within about the size of a small slot as long as no slot holds more than
a shard's share; a record larger than a share has a shard nearly to itself.

Defined cases: a null text has no bytes, checksum 0 and size `OVERHEAD`, as an empty text. Rows without an id are hashed by
the rest. Rows that are equal in id and text fall into the same slot and take places after each other. An empty
table gives an empty result. Extra columns take no part; `write_shards` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import fresh, numbered, stored

SLOTS, SHARDS, OVERHEAD, LAW = 8192, 40, 16, "bytes"


def text_bytes() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def size_of() -> Column:
    return (F.octet_length(text_bytes()) + OVERHEAD).cast("bigint")


def slot_of(slots: int) -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id"), F.crc32(text_bytes()), size_of()), F.lit(slots)).cast("int")


@dataclass(frozen=True)
class SlotMap:
    """owner[s] is the shard of slot s."""

    version: int
    shards: int
    owner: np.ndarray

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s, int(o)) for s, o in enumerate(self.owner)]
        return spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1)


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
    """Version 1: the slots dealt in turn."""
    return SlotMap(1, shards, np.arange(slots) % shards)


def save(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """The version below `path`; a version that is there already is never written over."""
    frame = slot_map.frame(spark).withColumn("shards", F.lit(slot_map.shards))
    frame.write.mode("errorifexists").parquet(f"{path}/version={slot_map.version}")


def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A saved version, the newest if none is named."""
    rows = spark.read.parquet(path)
    version = version or rows.agg(F.max("version")).first()[0]
    held = rows.where(F.col("version") == version).orderBy("virtual_slot").select("shard", "shards").collect()
    return SlotMap(version, held[0]["shards"], np.array([r["shard"] for r in held]))


def slot_bytes(sized: DataFrame, slots: int) -> np.ndarray:
    """Bytes per slot of rows with virtual_slot and size."""
    out = np.zeros(slots, np.int64)
    for row in sized.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect():
        out[row["virtual_slot"]] = row["bytes"]
    return out


def loads(slot_map: SlotMap, sizes: np.ndarray) -> np.ndarray:
    """Bytes per shard."""
    return np.bincount(slot_map.owner, sizes, slot_map.shards).astype(np.int64)


def evened(owner: np.ndarray, sizes: np.ndarray, shards: int, rounds: int = 2000) -> np.ndarray:
    """Swap or move single slots between the fullest and the emptiest shard as long as they come nearer."""
    owner = owner.copy()
    totals = np.bincount(owner, sizes, shards).astype(np.int64)
    for _ in range(rounds):
        full, empty = int(totals.argmax()), int(totals.argmin())
        gap = totals[full] - totals[empty]
        giving, taking = np.flatnonzero(owner == full), np.flatnonzero(owner == empty)
        # what goes over if a slot of the one changes place with a slot of the other, or with none
        back = np.concatenate([[0], sizes[taking]])
        over = sizes[giving][:, None] - back[None, :]
        best = np.abs(2 * over - gap)
        if not best.size or best.min() >= gap:
            break
        i, j = np.unravel_index(int(best.argmin()), best.shape)
        owner[giving[i]] = empty
        if j:
            owner[taking[j - 1]] = full
        totals[full] -= over[i, j]
        totals[empty] += over[i, j]
    return owner


def balanced(slot_map: SlotMap, sizes: np.ndarray) -> SlotMap:
    """The next version: shards over their share give up slots, shards under it get them.

    A shard keeps its largest slots that fit its share (one that fits no share stays alone); the rest goes, largest first, to the
    shard with the fewest bytes. Then single slots are exchanged between the fullest and the emptiest shard.
    """
    share = -(-int(sizes.sum()) // slot_map.shards)
    owner, freed = slot_map.owner.copy(), []
    totals = np.zeros(slot_map.shards, np.int64)
    for slot in np.lexsort((np.arange(len(sizes)), -sizes)):
        shard = owner[slot]
        if totals[shard] and totals[shard] + sizes[slot] > share:
            freed.append(slot)
        else:
            totals[shard] += sizes[slot]
    for slot in freed:
        shard = int(totals.argmin())
        owner[slot] = shard
        totals[shard] += sizes[slot]
    return replace(slot_map, version=slot_map.version + 1, owner=evened(owner, sizes, slot_map.shards))


def grown(slot_map: SlotMap, sizes: np.ndarray) -> SlotMap:
    """The next version with one more shard, which takes slots from the fullest shards up to its share; no other slot moves."""
    owner, new = slot_map.owner.copy(), slot_map.shards
    share = int(sizes.sum()) // (new + 1)
    totals = loads(slot_map, sizes)
    held = 0
    while held < share:
        full = int(totals.argmax())
        there = np.flatnonzero(owner == full)
        fits = there[(sizes[there] > 0) & (sizes[there] <= share - held)]
        if not len(fits):
            break
        slot = fits[np.abs(sizes[fits] - (totals[full] - share)).argmin()]
        owner[slot] = new
        held += sizes[slot]
        totals[full] -= sizes[slot]
    return SlotMap(slot_map.version + 1, new + 1, owner)


def balanced_map(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
    """The map of a first load: version 1, edited by the bytes of the documents."""
    sized = docs.select(slot_of(slots).alias("virtual_slot"), size_of().alias("size"))
    return balanced(first_map(slots, shards), slot_bytes(sized, slots))


def assign(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot): each row's shard under a balanced
    map and its place in the shard, gapless from 0, by virtual slot and id. grown_shard is null under this law."""
    sized = stored(docs.select("doc_id", size_of().alias("size"), F.crc32(text_bytes()).alias("text_crc32"), slot_of(slots).alias("virtual_slot")))
    slot_map = balanced(first_map(slots, shards), slot_bytes(sized, slots))
    owned = sized.join(F.broadcast(slot_map.frame(docs.sparkSession)), "virtual_slot")  # `slots` rows
    placed = numbered(owned, ["shard"], ["virtual_slot", "doc_id", "text_crc32", "size"], "slot")
    law, later = F.lit(LAW).alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", later, "virtual_slot")


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str) -> None:
    """The documents, all columns, below path/shard_no=N; a task writes slots of one shard or several, never a whole shard alone."""
    (at,) = fresh(docs, "virtual_slot")
    owner = slot_map.frame(docs.sparkSession).select(F.col("virtual_slot").alias(at), F.col("shard").alias("shard_no"))
    slotted = docs.withColumn(at, slot_of(len(slot_map.owner))).join(F.broadcast(owner), at)
    slotted.repartition(at).drop(at).write.partitionBy("shard_no").parquet(path)
