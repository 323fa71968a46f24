"""Domain tables from the star schema: customers are channels, orders are videos, line items are view readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    rows = read(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey", "left")
    return rows.select(
        F.col("c_custkey").alias("channel_id"),
        F.col("c_mktsegment").alias("cluster_id"),
        "country",
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal") + 1).alias("subs"),
        F.make_date((F.col("c_custkey") % 4 + 1995).cast("int"), F.lit(1), F.lit(1)).alias("first_seen"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey")
    known = ~priority.startswith("5")
    return read(spark, sf_dir, "orders").select(
        key.alias("video_id"),
        F.col("o_custkey").alias("channel_id"),
        F.to_date("o_orderdate").alias("published"),
        F.when(known, priority.startswith("1")).alias("is_short"),
        F.when(known, F.floor("o_totalprice") % 1200 >= 480).alias("midroll"),
        F.when(key % 10 != 9, (key % 10).cast("double") / 10).alias("relevance"),
        (F.col("o_orderstatus") != "O").alias("by_date"),
    )


def video_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = F.when(F.col("l_linenumber") != 7, F.floor("l_extendedprice"))
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("video_id"), F.to_date("l_shipdate").alias("observed_date"), F.col("l_linenumber").alias("source"), views.alias("views")
    )


def channel_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per channel and month: videos and subscribers so far."""
    from pyspark.sql.window import Window

    months = videos(spark, sf_dir).groupBy("channel_id", F.last_day("published").alias("observed_date")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("channel_id").orderBy("observed_date").rowsBetween(Window.unboundedPreceding, 0)
    months = months.withColumn("video_count", F.sum("n").over(upto)).drop("n")
    own = channels(spark, sf_dir).select("channel_id", "subs")
    return months.join(own, "channel_id").withColumn("subs", F.col("subs") + F.col("video_count"))


def demand_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("term"), F.to_date("o_orderdate").alias("observed_date")).agg(
        F.count("*").cast("double").alias("value")
    )


def cluster_demand(spark: SparkSession, sf_dir: str, event: bool = False) -> DataFrame:
    """Page views of a cluster's topic (term): orders of its customers a day, or open ones only as those of its events."""
    own = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("term"))
    orders = read(spark, sf_dir, "orders")
    seen = (orders.filter("o_orderstatus = 'O'") if event else orders).select("o_custkey", F.to_date("o_orderdate").alias("observed_date"))
    return seen.join(own, "o_custkey").groupBy("term", "observed_date").agg(F.count("*").cast("double").alias("value"))


#: The clusters that curated keywords belong to, in turn.
CURATED = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def keyword_metrics(spark: SparkSession, sf_dir: str, clusters: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    own = [F.element_at(F.array(*map(F.lit, CURATED)), (k % len(CURATED) + 1).cast("int")).alias("cluster_id")] if clusters else []
    return read(spark, sf_dir, "part").select(
        *own,
        F.col("p_name").alias("keyword"),
        F.substring("p_brand", -1, 1).alias("geo"),
        F.add_months(F.lit("1997-01-31").cast("date"), (k % 12).cast("int")).alias("observed_date"),
        F.pow(F.lit(10.0), F.col("p_size") % 5).alias("volume"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("competition"),
        F.when(k % 5 != 0, F.round(F.col("p_retailprice") / 100, 2)).alias("bid_low"),
        F.when(k % 3 != 0, F.round(F.col("p_retailprice") / 10, 2)).alias("bid_high"),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("started_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"), F.col("value").alias("snapshots"),
    )
