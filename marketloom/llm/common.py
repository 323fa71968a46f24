"""Shared pieces of the corpus operators: scratch tables, skew-safe joins, key sieves of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key counts as hot when it holds more than one in HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000
#: Bits of a sieve: eight for each key, within these bounds (half a megabyte and 64 MB).
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 29
#: With this setting Spark deletes a query's shuffle files when the query ends. Without it they stay until the driver's
#: garbage happens to be collected, so a job of many queries may hold the shuffles of all of them on disk.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Scratch tables that this process has written.
_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one is set only where that is unset and Spark runs in one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; afterwards the session's own setting holds again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_deleted(spark):
        writer.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables saved inside are deleted at the end, but for those that are put in the list; shuffles with their query."""
    before, kept = len(_written), []
    with shuffles_deleted(spark):
        yield kept
    for path in _written[before:]:
        if path not in {df._scratch for df in kept}:
            _delete(spark, path)


def deleted(df: DataFrame) -> None:
    """The files of a saved table go before its scratch ends; nothing may read it afterwards."""
    _delete(df.sparkSession, df._scratch)


def _delete(spark: SparkSession, path: str) -> None:
    _written.remove(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of rows with their group's row. rows and groups must be saved tables, groups with one row a key.

    Groups with over a thousandth of all rows are fewer than a thousand, so those are broadcast; the rest are
    joined by a shuffle in which no key is large.
    """
    total, most = groups.agg(F.coalesce(F.sum(count), F.lit(0)), F.coalesce(F.max(count), F.lit(0))).first()
    if most * HOT_SHARE <= total:
        return rows.join(groups, key)
    hot = groups.filter(F.col(count) * HOT_SHARE > total)
    cold = groups.filter(F.col(count) * HOT_SHARE <= total)
    of_hot = rows.join(F.broadcast(hot), key)
    of_cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return of_hot.unionByName(of_cold)


def sieve(rows: DataFrame, key: Column, keys: DataFrame, keys_col: str) -> DataFrame:
    """rows without most of those whose key isn't in keys; every row whose key is there stays.

    keys (a saved table) become a bitmap of at most MOST_BITS in rows of 4 kB, so what is broadcast has a bound. The
    caller still joins with keys; this only spares that join the rows that cannot match.
    """
    wanted = 8 * keys.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, wanted - 1).bit_length()))
    position = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    at = keys.select(position(F.col(keys_col)).alias("p")).distinct()
    bits = at.groupBy(F.bitmap_bucket_number("p").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits")
    )
    byte = "cast(conv(hex(substring(__bits, cast(__at div 8 as int) + 1, 1)), 16, 10) as int)"
    return (
        rows.withColumns({"__bucket": F.bitmap_bucket_number(position(key)), "__at": F.bitmap_bit_position(position(key))})
        .join(F.broadcast(bits), "__bucket")
        .filter(F.expr(f"shiftright({byte}, cast(__at % 8 as int)) & 1 = 1"))
        .drop("__bucket", "__at", "__bits")
    )
