"""Table maintenance on Parquet frames: upserts, first-write-wins inserts, backfills, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

APPEND_ONLY = {"video_snapshots", "channel_snapshots", "demand_snapshots", "demand_series", "discoveries", "keyword_metrics", "raw_records"}


def upsert(stored: DataFrame, new: DataFrame, key: list[str], update: list[str] | None = None) -> DataFrame:
    """stored with new merged in: listed columns (all that new has by default) take the new value where a new row exists,
    NULL included; columns that new lacks keep theirs."""
    update = [c for c in new.columns if c not in key] if update is None else update
    mine = new.select(*key, F.lit(True).alias("__new"), *[F.col(c).alias(f"__n_{c}") for c in new.columns if c not in key])
    both = stored.withColumn("__old", F.lit(True)).join(mine, key, "full_outer")
    pick = lambda c: (
        F.col(c) if c in key or f"__n_{c}" not in both.columns
        else F.when(F.col("__new") & (F.col("__old").isNull() | F.lit(c in update)), F.col(f"__n_{c}")).otherwise(F.col(c))
    )
    return both.select(*[pick(c).alias(c) for c in stored.columns])


def upsert_days(new: DataFrame, path: str, key: list[str], day: str, update: list[str] | None = None) -> None:
    """Merges new into the table under path, which is partitioned by `day`, a part of its key.

    Only partitions of days that new has are read and rewritten, all put in place when the last is written; files of other
    days stay as they are. A second write of the same rows changes nothing. new is computed once."""
    new = new.persist()
    days = [r[0] for r in new.select(day).distinct().collect()]  # the days of one build
    try:
        stored = new.sparkSession.read.schema(new.schema).parquet(path).filter(F.col(day).isin(days))
    except Exception as missing:  # nothing is stored yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        stored = new.limit(0)
    merged = upsert(stored, new, key, update).hint("rebalance", day)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    new.unpersist()


def first_writes(new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order."""
    return new.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__k = 1").drop("__k")


def insert_ignore(stored: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The rows of new to append: first write wins inside the batch and against what is stored."""
    return first_writes(new, key, order).join(stored.select(*key), key, "left_anti").select(new.columns)


def append(df: DataFrame, path: str, kind: str, mode: str = "append") -> None:
    """Writes without looking at keys; an append-only table takes nothing but appends."""
    if kind in APPEND_ONLY and mode != "append":
        raise ValueError(f"{kind} is append-only")
    df.write.mode(mode).parquet(path)


def combine_supplied(batch: DataFrame, key: list[str], seq: str, supplied: str) -> DataFrame:
    """One row per key from rows that supply some columns each (array column `supplied` names them): per column the last
    supplied value, an explicit NULL included."""
    columns = [c for c in batch.columns if c not in (*key, seq, supplied)]
    last = [F.max_by(F.struct(F.col(c).alias("v")), F.when(F.array_contains(supplied, c), F.col(seq))).getField("v").alias(c) for c in columns]
    return batch.groupBy(*key).agg(*last)


def fill_nulls(stored: DataFrame, raw: DataFrame, key: str, column: str, at: str) -> DataFrame:
    """Where stored's column is NULL, the newest non-empty text that raw has for the key; no new rows."""
    newest = raw.filter(F.length(column) > 0).groupBy(key).agg(F.max_by(column, at).alias("__text"))
    return stored.join(newest, key, "left").withColumn(column, F.coalesce(column, "__text")).drop("__text").select(stored.columns)


def retained(raw: DataFrame, needed: DataFrame, key: str, at: str, before: str, on: str | None = None) -> DataFrame:
    """raw without rows whose `on` (`at` by default) is older than `before`, but with the newest row, by `at`, of every key that
    needed still lacks a text for."""
    newest = Window.partitionBy(key).orderBy(F.desc(at))
    marked = raw.withColumn("__k", F.row_number().over(newest)).join(needed.select(key, F.lit(True).alias("__need")).distinct(), key, "left")
    old = F.col(on or at) < F.lit(before).cast("timestamp")
    return marked.filter(~old | ((F.col("__k") == 1) & F.col("__need"))).select(raw.columns)


def stamp(df: DataFrame, **values: object) -> DataFrame:
    """Provenance columns, set only where they are absent."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in values.items()})


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows and sha256, a hash of the sums of four numbers that each row's sha256 gives, whatever the order of rows.
    Sums are combined before the shuffle, so it takes constant memory."""
    line = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    part = lambda i: F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    sums = df.select(line.alias("h")).agg(F.count("*").alias("rows"), *[part(i).alias(f"s{i}") for i in range(4)])
    return sums.select("rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), *[f"s{i}" for i in range(4)]), 256).alias("sha256"))


def write_artefact(df: DataFrame, path: str) -> DataFrame:
    """Writes df where nothing may lie yet (an existing path is refused) and returns the fingerprint of what was written."""
    df.write.mode("errorifexists").parquet(path)
    return fingerprint(df.sparkSession.read.schema(df.schema).parquet(path))
