"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Records hash into thousands of virtual slots that never change. Bytes are
summed per slot, and a small map from slot to shard is kept in versions in a
folder: each call takes up the latest one, moves as few slots as bring the
shards to near equal bytes, and writes the next version; records keep their
slots. Only the slot totals (one row per slot, a fixed number) reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragloom.session import ensure_checkpoint_dir, path_exists

from .session import stored

VIRTUAL_SLOTS = 4096
PARTS = 64  # of a slot's rows, so that a slot with a hot key is many tasks' work


def virtual_slot(key: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    """The virtual slot of a record's key (a null key has one too)."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def first_map(slots: int, shards: int) -> list[int]:
    """Version 0: slots dealt to the shards in turn."""
    return [s % shards for s in range(slots)]


def rebalance(mapping: Sequence[int], sizes: Sequence[int], shards: int) -> list[int]:
    """The next version of the map: shards above the mean give up slots, the
    largest first that keep them at or above it, then one more; freed slots, and
    those of shards that are no longer there, go, largest first, to the lightest
    shard; at last the heaviest and the lightest shard trade slots (or hand one
    over) as long as that brings them closer."""
    out = list(mapping)
    own: list[list[int]] = [[] for _ in range(shards)]
    load = [0] * shards
    pool: list[int] = []
    for slot, shard in enumerate(out):
        if shard >= shards:
            pool.append(slot)
            continue
        own[shard].append(slot)
        load[shard] += sizes[slot]
    mean = sum(sizes) / shards
    for shard in range(shards):
        own[shard].sort(key=lambda s: (-sizes[s], s))
        kept = []
        for slot in own[shard]:
            if load[shard] - sizes[slot] >= mean and sizes[slot] > 0:
                load[shard] -= sizes[slot]
                pool.append(slot)
            else:
                kept.append(slot)
        if load[shard] > mean and kept:
            small = next((s for s in reversed(kept) if sizes[s] > 0), None)
            if small is not None:
                kept.remove(small)
                load[shard] -= sizes[small]
                pool.append(small)
        own[shard] = kept
    for slot in sorted(pool, key=lambda s: (-sizes[s], s)):
        shard = min(range(shards), key=lambda x: (load[x], x))
        own[shard].append(slot)
        load[shard] += sizes[slot]
    while True:  # every trade lowers the sum of squared loads, so this ends
        heavy = max(range(shards), key=lambda x: (load[x], -x))
        light = min(range(shards), key=lambda x: (load[x], x))
        gap = load[heavy] - load[light]
        give = sorted(own[heavy], key=lambda s: sizes[s])
        take = sorted(own[light], key=lambda s: sizes[s])
        best, pair = gap, None
        i = 0
        for g in give:  # the slot to take back grows with the slot given
            while i + 1 < len(take) and sizes[g] - sizes[take[i + 1]] >= gap / 2:
                i += 1
            for t in [None, *take[max(0, i - 1):i + 2]]:
                moved = sizes[g] - (sizes[t] if t is not None else 0)
                if 0 < moved < gap and abs(gap - 2 * moved) < best:
                    best, pair = abs(gap - 2 * moved), (g, t)
        if pair is None:
            break
        g, t = pair
        own[heavy].remove(g)
        own[light].append(g)
        load[heavy] -= sizes[g]
        load[light] += sizes[g]
        if t is not None:
            own[light].remove(t)
            own[heavy].append(t)
            load[light] -= sizes[t]
            load[heavy] += sizes[t]
    for shard, slots in enumerate(own):
        for slot in slots:
            out[slot] = shard
    return out


def map_table(spark: SparkSession, mapping: Sequence[int], version: int) -> DataFrame:
    """One version of the map as a table (version, virtual_slot, shard)."""
    return spark.range(len(mapping)).select(
        F.lit(version).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        F.element_at(F.lit(list(mapping)), F.col("id").cast("int") + 1).cast("int").alias("shard"))


def slot_sizes(records: DataFrame, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Bytes of each virtual slot (``slots`` numbers, whatever the table's size)."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    out = [0] * slots
    for r in rows:
        out[r["virtual_slot"]] = int(r["bytes"])
    return out


def stored_map(spark: SparkSession, store: str) -> tuple[int, list[int]] | None:
    """Number and slots of the latest version in the folder ``store``; None
    where there is no version yet."""
    if not path_exists(spark, store):
        return None
    maps = spark.read.option("recursiveFileLookup", "true").parquet(store)
    version = maps.agg(F.max("version")).first()[0]
    rows = maps.where(F.col("version") == version).select("virtual_slot", "shard").collect()  # a row per slot
    out = [0] * len(rows)
    for r in rows:
        out[r["virtual_slot"]] = r["shard"]
    return version, out


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS,
          store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Deal all rows to ``shards`` shards of nearly equal bytes.

    Returns the placement (id column, ``size``, ``text_crc32``, ``virtual_slot``,
    ``shard``, ``slot``: the row's place in its shard, gapless from 0, and
    ``map_version``) and the stored versions of the map. ``store`` is the folder
    of the versions (by default a fresh one in the shared folder): where it holds
    a version, that one is taken up, for new rows or another number of shards;
    ``slots`` must be the same. A version is written only if a slot moves. The
    size is the UTF-8 length of the text plus 8; a null text has no bytes (crc of
    nothing: 0). Equal ids share a virtual slot, a null id is a key like any
    other; equal rows are interchangeable and counted before they are shuffled,
    and a slot's other rows are dealt to ``PARTS`` parts, so that an id with very
    many rows is no single task's. Very long texts are only measured. Other
    columns are not read. An empty table gives an empty placement. Text is read
    once; what is shuffled is a few numbers a row.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("_text"), F.lit("")).cast("binary")
    records = stored(
        docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
        .select("_id", (F.length(raw) + 8).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
                virtual_slot(F.col("_id"), slots).alias("virtual_slot")), "shard-records")
    store = store or f"{ensure_checkpoint_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex}"
    held = stored_map(spark, store)
    if held is None:
        held = 0, first_map(slots, shards)
        map_table(spark, held[1], 0).coalesce(1).write.parquet(f"{store}/v0")
    version, mapping = held
    if len(mapping) != slots:
        raise ValueError(f"the stored map has {len(mapping)} slots, not {slots}")
    edited = rebalance(mapping, slot_sizes(records, slots), shards)
    if edited != mapping:
        version += 1
        map_table(spark, edited, version).coalesce(1).write.parquet(f"{store}/v{version}")
    maps = spark.read.option("recursiveFileLookup", "true").schema("version int, virtual_slot int, shard int").parquet(store)
    current = maps.where(F.col("version") == version)
    same = (records.groupBy("_id", "size", "text_crc32", "virtual_slot").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("part", F.pmod(F.xxhash64("text_crc32", "size", "_id"), F.lit(PARTS))))
    same = stored(same, "shard-rows")
    # a row's place: rows of its shard's earlier slots and parts, plus its place in the part
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (same.groupBy("virtual_slot", "part").agg(F.sum("n").alias("rows"))
              .join(F.broadcast(current), "virtual_slot")  # one row per slot
              .select("virtual_slot", "part", "version", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    earlier = Window.partitionBy("virtual_slot", "part").orderBy("_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (same.withColumn("at", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .join(starts, ["virtual_slot", "part"])  # laid out by these keys already
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
              .select(F.col("_id").alias(id_col), "size", "text_crc32", "virtual_slot", "shard",
                      (F.col("start") + F.col("at") + F.col("copy")).cast("bigint").alias("slot"), F.col("version").alias("map_version")))
    return placed, maps
