"""Ranks, scorecards, stages and alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .world import Calendar, in_windows


def average_rank(value: str, by: list[str]) -> Column:
    """1-based rank; equal values share the mean of their places; NULL has none."""
    order = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    ties = F.count(value).over(Window.partitionBy(*by, value))
    return F.when(F.col(value).isNotNull(), F.rank().over(order) + (ties - 1) / 2.0)


def percentile_rank(value: str, by: list[str]) -> Column:
    """0 to 1 with average ties; a single value has 0.5."""
    n = F.count(value).over(Window.partitionBy(*by))
    return F.when(F.col(value).isNotNull(), F.when(n == 1, 0.5).otherwise(F.try_divide(average_rank(value, by) - 1, n - 1)))


def scorecards(features: DataFrame, supply: str, demand: str, openness: str, momentum: str, evidence: str) -> DataFrame:
    """A card for every cluster and day with metric rows: ranks of supply and demand among the day's clusters, their gap,
    openness as measured, and the stage. A confidence is that of the weaker side. evidence is carried, never read.

    supply names the metric that is ranked, so that a replay can take another one than a daily build."""
    names = [supply, demand, openness, momentum, evidence]
    wide = features.groupBy("cluster_id", "day").pivot("name", names).agg(F.first("value").alias("value"), F.first("confidence").alias("confidence"))
    wide = wide.withColumns({"supply": percentile_rank(f"{supply}_value", ["day"]), "demand": percentile_rank(f"{demand}_value", ["day"])})
    wide = wide.withColumn("gap", F.col("demand") - F.col("supply")).withColumn("momentum", F.col(f"{momentum}_value"))
    sure = F.least(f"{supply}_confidence", f"{demand}_confidence")
    lacks = F.concat_ws(" and ", F.when(F.col("momentum").isNull(), "no momentum"), F.when(F.col("gap").isNull(), "no gap"))
    return wide.select(
        "cluster_id", "day", F.col(f"{openness}_value").alias("openness"), F.round("supply", 6).alias("supply"), F.round("demand", 6).alias("demand"),
        F.round("gap", 6).alias("gap"), F.when(F.col("gap").isNotNull(), sure).alias("gap_confidence"), "momentum", F.col(f"{evidence}_value").alias("evidence"),
        stage(F.col("momentum"), F.col("gap")).alias("stage"),
        F.when(F.col("momentum").isNotNull() & F.col("gap").isNotNull(), F.least(f"{momentum}_confidence", sure)).alias("stage_confidence"),
        F.nullif(lacks, F.lit("")).alias("reason"),
    )


def stage(momentum: Column, gap: Column) -> Column:
    """The state of a cluster by whether demand rises and whether supply falls short; unknown without either."""
    return (
        F.when(momentum.isNull() | gap.isNull(), "unknown").when((momentum > 0) & (gap > 0), "emerging").when(momentum > 0, "contested")
        .when(gap > 0, "cooling").otherwise("saturated")
    )


def breakouts(series: DataFrame, spine: DataFrame, windows: int = 13, length: int = 28, least: int = 8, z: float = 2.0, lag: int = 2, share: float = 0.8) -> DataFrame:
    """Per cluster (term) and day: the last window's sum against the mean and deviation of the windows before it.

    A window counts if `share` of its days have a value. fires: z is reached, with `least` windows and a spread."""
    own = series.withColumnRenamed("term", "cluster_id").join(spine.select("cluster_id").distinct(), "cluster_id", "left_semi")
    each = {w: (lag + w * length, length) for w in range(windows + 1)}
    sums = in_windows(own, ["cluster_id"], Calendar(spine), each).withColumnsRenamed({"total": "s", "points": "n"})
    base = (F.col("w") > 0) & (F.col("n") >= share * length)
    out = sums.groupBy("cluster_id", "day").agg(
        F.sum(F.when(F.col("w") == 0, F.col("s"))).alias("recent"), F.count_if(base).alias("windows"),
        F.avg(F.when(base, F.col("s"))).alias("mean"), F.stddev_samp(F.when(base, F.col("s"))).alias("sd"),
    )
    score = F.when(F.col("windows") >= least, F.try_divide(F.col("recent") - F.col("mean"), F.nullif("sd", F.lit(0.0))))
    return out.select("cluster_id", "day", "recent", "windows", F.round(score, 6).alias("z"), F.coalesce(score >= z, F.lit(False)).alias("fires"))


def cooled(fires: DataFrame, days: int = 28) -> DataFrame:
    """Of the days on which a rule would fire (cluster_id, day), those that do: one silences the `days` that follow, and
    silenced ones silence nothing. A fold over each cluster's sorted days."""
    per = fires.groupBy("cluster_id").agg(F.array_sort(F.collect_set("day")).alias("days"))
    kept = F.expr(f"aggregate(days, cast(array() as array<date>), (k, d) -> if(size(k) = 0 or datediff(d, element_at(k, -1)) >= {days}, concat(k, array(d)), k))")
    return per.select("cluster_id", F.explode(kept).alias("day"))


def collapses(features: DataFrame) -> DataFrame:
    """Metrics that had a value on the stored day before and have none now, or whose inputs fell by half or more."""
    before = Window.partitionBy("cluster_id", "name").orderBy("day")
    rows = features.withColumns({"was": F.lag("value").over(before), "had": F.lag("inputs_n").over(before)})
    return rows.filter("was is not null and (value is null or 2 * inputs_n <= had)").select("cluster_id", "day", "name", "had", "inputs_n")
