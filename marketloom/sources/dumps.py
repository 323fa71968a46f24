"""Gzipped dumps of channels, weekly readings and videos. Such files cannot be split, so their rows are dealt out after the read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.jobs import folder


def written(rows: DataFrame, kind: str) -> str:
    """Writes rows as a gzipped dump (tab-separated or JSON lines) into the shared folder and returns its path."""
    path = folder(rows.sparkSession)
    out = rows.write.option("compression", "gzip")
    out.option("sep", "\t").option("header", True).csv(path) if kind == "csv" else out.json(path)
    return path


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)


def channels(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "channel_id bigint, category string, join_date date")


def weekly(spark: SparkSession, path: str, kept: DataFrame) -> DataFrame:
    """Readings of kept channels; counts are rounded half to even; rows whose week cannot be read go."""
    rows = _tsv(spark, path, "channel_id bigint, week string, videos string, subs string")
    count = lambda c: F.bround(F.col(c).try_cast("double"), 0).cast("long").alias(c)
    rows = rows.select("channel_id", F.col("week").try_cast("date").alias("week"), count("videos"), count("subs")).filter("week is not null")
    return rows.join(kept.select("channel_id").distinct(), "channel_id", "left_semi")


def videos(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("video_id bigint, channel_id bigint, published date, is_short boolean").json(path)
    return rows.repartition(spark.sparkContext.defaultParallelism)


def hits(spark: SparkSession, path: str) -> DataFrame:
    """What a scan of the video dump found: a video may come once for each niche whose lexicon it meets."""
    rows = spark.read.schema("video_id bigint, channel_id bigint, slug string, relevance double, published string").json(path)
    return rows.repartition(spark.sparkContext.defaultParallelism).withColumn("published", F.col("published").try_cast("date"))
