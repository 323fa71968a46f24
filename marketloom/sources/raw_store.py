"""Raw payloads on disk: landed as they came, partitioned by source, kind and day, and pruned by whole partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ["source", "kind", "day"]
SCHEMA = "record long, key string, run_id string, at timestamp, sha256 string, body variant, text string, source string, kind string, day date"


class LastCopy(RuntimeError):
    """A prune would have removed the last payload that holds what is still needed."""


def land(raw: DataFrame, path: str) -> None:
    """Appends raw (record, source, kind, key, payload, run_id, at).

    JSON is stored as VARIANT, so that fields are read without parsing text; the text itself is kept beside it only where the
    VARIANT doesn't give it back byte for byte. A source's day of payloads, however large, is dealt over several tasks."""
    body = F.try_parse_json("payload")
    kept = F.when(~F.to_json(body).eqNullSafe(F.col("payload")), F.col("payload"))
    rows = raw.select("record", "key", "run_id", "at", F.sha2("payload", 256).alias("sha256"), body.alias("body"), kept.alias("text"), "source", "kind", F.to_date("at").alias("day"))
    rows.hint("rebalance", *PARTS).write.mode("append").partitionBy(*PARTS).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """What lies under path, with the payload as it came."""
    return spark.read.schema(SCHEMA).parquet(path).withColumn("payload", F.coalesce("text", F.to_json("body")))


def field(name: str, kind: str) -> Column:
    """A field of a JSON payload; NULL where there is none or it is of another kind."""
    return F.try_variant_get("body", f"$.{name}", kind)


def prune(spark: SparkSession, path: str, kinds: list[str], before: str, needed: DataFrame, refuse: bool = False) -> tuple[int, int]:
    """Removes payloads of the kinds from days before `before`, but for the newest one of each needed key (column key).

    With refuse nothing is removed if such a key would have lost its last payload. Only partitions before that day are
    touched: those that keep rows are rewritten, then the rest is deleted, so that a prune that is killed and run again
    loses nothing. Returns how many partitions were rewritten and deleted."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    own = stored.filter(F.col("kind").isin(kinds))
    old = F.col("day") < F.lit(before).cast("date")
    wanted = own.select("key", "at", "record", "day").join(needed.select("key").distinct(), "key", "left_semi")
    newest = wanted.groupBy("key").agg(F.max(F.struct("at", "record", "day")).alias("n")).select("key", "n.record", "n.day").filter(old)
    if refuse and newest.limit(1).count():
        raise LastCopy(f"payloads before {before} hold the last copy of what is still needed")
    kept = own.filter(old).join(newest, ["key", "record", "day"], "left_semi").select(stored.columns)
    touched = {tuple(r) for r in own.filter(old).select(*PARTS).distinct().collect()}  # one row a folder
    stay = {tuple(r) for r in kept.select(*PARTS).distinct().collect()}
    if stay:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)
    for source, kind, day in touched - stay:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/source={source}/kind={kind}/day={day}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(stay), len(touched - stay)

