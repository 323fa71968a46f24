"""Sharding by fixed virtual slots: records hash into thousands of slots, a versioned map sends slots to shards."""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import saved, scratch_dir

#: Virtual slots. The number is fixed for the life of a corpus: it bounds every table that is collected or broadcast here.
SLOTS = 4096
MAP_SCHEMA = T.StructType(
    [T.StructField("version", T.IntegerType()), T.StructField("virtual_slot", T.IntegerType()), T.StructField("shard", T.IntegerType())]
)


def virtual_slot(doc_id: Column, text_crc32: Column, copy: Column) -> Column:
    """The slot of a record. The text takes part so that rows with a null or repeated id still spread, and so does copy
    where one id and text has many rows."""
    return F.pmod(F.xxhash64(doc_id, text_crc32, copy), F.lit(SLOTS)).cast("int")


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, virtual_slot; null text counts as empty.

    An id and text with more rows than a slot should hold (fewer than SLOTS of them) is dealt over slots row by row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "shard-records")
    total = rows.count()
    often = rows.groupBy("doc_id", "text_crc32", "size").agg(F.count("*").alias("n")).filter(f"n > 1 and n * {SLOTS} > {total}")
    often = often.select(F.col("doc_id").alias("i"), F.col("text_crc32").alias("c"), F.col("size").alias("s"), F.lit(True).alias("often"))
    rows = rows.join(F.broadcast(often), F.expr("doc_id <=> i and text_crc32 = c and size = s"), "left")
    copy = F.when(F.col("often"), F.col("row")).otherwise(F.lit(0).cast("long"))
    return rows.select("doc_id", "size", "text_crc32", virtual_slot(F.col("doc_id"), F.col("text_crc32"), copy).alias("virtual_slot"))


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot: at most SLOTS numbers."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def first_map(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Largest slot first, each to the shard with the fewest bytes so far. Ties: lower slot, lower shard."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for slot in sorted(range(SLOTS), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), shard))
    return out


def edited_map(old: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """The next version of a map: slots move only from shards above the mean (or no longer there) to the lightest ones.

    A slot moves where that leaves the receiving shard no heavier than the giving one was, so few slots move.
    """
    out = dict(old)
    load = dict.fromkeys(range(shards), 0)
    held: dict[int, list[int]] = {k: [] for k in range(shards)}
    homeless = []
    for slot, shard in old.items():
        if shard in load:
            load[shard] += sizes.get(slot, 0)
            held[shard].append(slot)
        else:
            homeless.append(slot)
    mean = sum(sizes.values()) / shards
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        to = min(load, key=lambda k: (load[k], k))
        out[slot] = to
        load[to] += sizes.get(slot, 0)
        held[to].append(slot)
    for shard in sorted(load, key=lambda k: (-load[k], k)):
        for slot in sorted(held[shard], key=lambda s: (-sizes.get(s, 0), s)):
            to = min(load, key=lambda k: (load[k], k))
            size = sizes.get(slot, 0)
            if size and load[shard] - size >= mean - size / 2 and load[to] + size < load[shard]:
                out[slot] = to
                load[shard] -= size
                load[to] += size
    return out


def map_frame(spark: SparkSession, shard_of: dict[int, int], version: int) -> DataFrame:
    return spark.createDataFrame([(version, slot, shard) for slot, shard in sorted(shard_of.items())], MAP_SCHEMA)


def store_map(spark: SparkSession, shard_of: dict[int, int], path: str, version: int) -> DataFrame:
    """Writes one version of the map; an existing version is never overwritten."""
    map_frame(spark, shard_of, version).coalesce(1).write.mode("errorifexists").parquet(f"{path}/v{version:06d}")
    return load_map(spark, path, version)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v{version:06d}")


def place(rows: DataFrame, shard_map: DataFrame) -> DataFrame:
    """rows with shard, slot and map_version. slot counts the rows of a shard from 0 without gaps.

    Rows are numbered inside their virtual slot and moved on by the rows of the shard's earlier slots, so no task
    holds a shard.
    """
    per_slot = rows.groupBy("virtual_slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = shard_map.join(F.broadcast(per_slot), "virtual_slot").select(
        "virtual_slot", "shard", F.col("version").alias("map_version"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("i", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", (F.col("start") + F.col("i")).cast("long"))
        .drop("i", "start")
    )


def latest(spark: SparkSession, path: str) -> int | None:
    """The number of the newest map stored under path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    return max([int(f.getPath().getParent().getName()[1:]) for f in found], default=None)


def shard(docs: DataFrame, shards: int, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, map_version, slot: one row per row of docs.

    The map is stored under path (a new place in the shared folder if there is none) and rows are placed by what is read
    from there. The first version deals all slots; where a version lies there already, the next one is that version edited
    for today's bytes and number of shards, so few rows move. Sizes of shards are near equal. Null text has size 1; rows
    with equal or null ids keep their own slots; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    path = path or f"{scratch_dir(spark)}/shard-map-{uuid.uuid4().hex}"
    rows = saved(records(docs), "shard-rows")
    old, sizes = latest(spark, path), slot_bytes(rows)
    if old is None:
        return place(rows, store_map(spark, first_map(sizes, shards), path, 0))
    held = {r.virtual_slot: r.shard for r in load_map(spark, path, old).collect()}
    return place(rows, store_map(spark, edited_map(held, sizes, shards), path, old + 1))
