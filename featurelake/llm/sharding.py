"""Sharding by fixed virtual slots.

Records are hashed into ``n_slots`` virtual slots, bytes and rows are
aggregated per slot, and a slot-to-shard map decides the shard.  The map is a
small versioned table in a folder that outlives a run: version 0 deals slots
out in turn, each later version is an edit of the newest stored one and moves
only the slots needed to even out the bytes or to fill new shards.  The driver
only ever sees the per-slot sums (``n_slots`` rows, a constant).
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featurelake.llm.common import stored
from featurelake.session import fresh_dir
from featurelake.sources.lake import new_version, newest_version

N_SLOTS = 4096
ROW_OVERHEAD = 16
MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long, first_position long"


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot).  A null text counts as
    empty: size 16, checksum 0.  The slot hashes id, checksum and size, so
    rows that share an id (or have none) still spread out.

    Rows that agree in all three and together outweigh a mean slot, of which
    there can be ``n_slots`` groups at most, are dealt over the slots by their
    place in the table, else one slot would hold them all.
    """
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    key = ["doc_id", "text_crc32", "size"]
    rows = docs.select(docs["doc_id"], (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    groups = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    mean = rows.agg(F.sum("size") / n_slots).scalar()
    heavy = F.broadcast(groups.filter(F.col("n") * F.col("size") > mean).select(*[F.col(c).alias(f"_{c}") for c in key], F.lit(True).alias("_heavy")))
    same = [rows[c].eqNullSafe(heavy[f"_{c}"]) for c in key]
    place = F.when(F.col("_heavy"), F.monotonically_increasing_id()).otherwise(F.lit(0))
    dealt = rows.join(heavy, same, "left").withColumn("_place", place)
    # without a place the hash is that of the three alone, whatever the run
    slot = F.when(F.col("_heavy"), F.xxhash64(*key, "_place")).otherwise(F.xxhash64(*key))
    return dealt.select(*[F.col(c) for c in ("doc_id", "size", "text_crc32")], F.pmod(slot, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_sums(rows: DataFrame, n_slots: int = N_SLOTS) -> dict[int, tuple[int, int]]:
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    found = {r["virtual_slot"]: (r["b"], r["n"]) for r in sums}
    return {s: found.get(s, (0, 0)) for s in range(n_slots)}


def first_map(n_slots: int, n_shards: int) -> list[int]:
    return [s % n_shards for s in range(n_slots)]


def rebalanced(shards: list[int], sums: dict[int, tuple[int, int]], n_shards: int) -> list[int]:
    """The next version of a map.  Each shard keeps its largest slots up to
    the mean load; what it holds beyond goes, largest first, to the least
    loaded shards.  Slots of shards that stay under the mean do not move."""
    mean = sum(b for b, _ in sums.values()) / n_shards
    load = [0] * n_shards
    new, surplus = list(shards), []
    for slot in sorted(sums, key=lambda s: (-sums[s][0], s)):
        size, shard = sums[slot][0], shards[slot]
        if shard < n_shards and load[shard] + size <= mean:
            load[shard] += size
        elif size or shard >= n_shards:
            surplus.append(slot)
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in surplus:
        b, shard = heapq.heappop(heap)
        new[slot] = shard
        heapq.heappush(heap, (b + sums[slot][0], shard))
    return new


def save_map(spark: SparkSession, path: str, version: int, shards: list[int], sums: dict[int, tuple[int, int]]) -> DataFrame:
    """Store a version of the map, which readers see once it is committed;
    ``first_position`` is the number of rows in the shard's lower slots."""
    rows, before = [], {}
    for slot, shard in enumerate(shards):
        b, n = sums[slot]
        rows.append((version, slot, shard, b, n, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + n
    target = f"{path}/version={new_version()}"
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(target)
    return spark.read.schema(MAP_SCHEMA).parquet(target)


def load_map(spark: SparkSession, path: str) -> tuple[int, list[int]] | None:
    """(version, shard of each slot) of the newest committed map, if any."""
    current = newest_version(spark, path)
    if current is None:
        return None
    rows = sorted(tuple(r) for r in spark.read.schema(MAP_SCHEMA).parquet(current).select("slot", "shard", "version").collect())
    return rows[0][2], [shard for _, shard, _ in rows]


def rebalance(spark: SparkSession, path: str, sums: dict[int, tuple[int, int]], n_shards: int) -> DataFrame:
    """The next version under ``path``: the stored map edited for ``sums``."""
    found = load_map(spark, path)
    if found is not None and len(found[1]) != len(sums):
        raise ValueError(f"the map under {path} has {len(found[1])} slots, not {len(sums)}")
    if found is None:
        save_map(spark, path, 0, first_map(len(sums), n_shards), sums)
        found = 0, first_map(len(sums), n_shards)
    version, shards = found
    return save_map(spark, path, version + 1, rebalanced(shards, sums, n_shards), sums)


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard and gapless position (``slot``, from 0 in each shard) per record.
    Positions number the records inside a virtual slot, not inside a shard,
    so a window holds 1/n_slots of the rows."""
    numbered = rows.withColumn("_n", F.row_number().over(
        W.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")))
    chosen = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "first_position", F.col("version").alias("map_version"))
    # n_slots rows: a constant
    return numbered.join(F.broadcast(chosen), "virtual_slot").withColumn(
        "slot", F.col("first_position") + F.col("_n") - 1).drop("_n", "first_position")


def shard_documents(docs: DataFrame, n_shards: int = 40, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """One row per document under the law of near equal bytes.

    ``map_path`` names the folder of the slot-to-shard map: the newest version
    there is edited and stored as the next, so between runs only the slots
    move that must.  Without it the map is this run's own.

    Repeated rows keep a row each and are spread if they are many; null ids
    are a value like another; a null text is empty; a very long text is one
    record of its size; an empty table gives no rows; further columns of
    ``docs`` are not carried.
    """
    spark = docs.sparkSession
    rows = stored(records(docs, n_slots), "shard-records")
    slot_map = rebalance(spark, map_path or fresh_dir(spark, "slot-map"), slot_sums(rows, n_slots), n_shards)
    return assign(rows, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
