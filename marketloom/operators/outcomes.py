"""Outcomes by as-of joins with tolerance, prospective cohorts, video and feed analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .world import KEY, World


def growth(members: DataFrame, readings: DataFrame, horizon: int, before: int, after: int) -> DataFrame:
    """Per cluster and day: the median over members of ln(end / start), how many contribute, and the mean lag: days of the end
    readings after the first day that they might be of.

    start: the newest reading in [day - before, day]; end: the earliest in [day + horizon, day + horizon + after].
    readings: channel_id, observed_date, subs; of one date the larger counts; zero and NULL don't."""
    r = readings.filter("subs > 0").groupBy("channel_id", "observed_date").agg(F.max("subs").alias("subs"))
    near = members.select(*KEY, "channel_id").join(r, "channel_id")
    gap = F.datediff("observed_date", "day")
    near = near.filter(gap.between(-before, 0) | gap.between(horizon, horizon + after)).withColumn("late", gap > 0)
    ends = near.groupBy(*KEY, "channel_id").agg(
        F.max_by("subs", F.when(~F.col("late"), F.col("observed_date"))).alias("a"), F.min_by("subs", F.when(F.col("late"), F.col("observed_date"))).alias("b"),
        F.min(F.when(F.col("late"), F.datediff("observed_date", "day") - horizon)).alias("lag"),
    )
    ends = ends.filter("a is not null and b is not null").withColumn("g", F.ln(F.col("b") / F.col("a")))
    return ends.groupBy(*KEY).agg(F.round(F.median("g"), 6).alias("growth"), F.count("*").alias("contributing"), F.round(F.avg("lag"), 6).alias("mean_lag"))


def frozen_cohort(world: World) -> DataFrame:
    """Per member of the cohort: ln(max / median views), median views per subscriber, logs, videos."""
    return world.cohort.filter("median_views > 0").select(
        *KEY, "channel_id", F.round(F.ln(F.col("max_views") / F.col("median_views")), 6).alias("spike"), F.round(F.col("median_views") / F.col("subs"), 6).alias("per_sub"),
        F.round(F.ln("median_views"), 6).alias("ln_median"), F.round(F.ln("subs"), 6).alias("ln_subs"), "videos",
    )


def cohort_counts(world: World) -> DataFrame:
    """Per cluster and day: channels of the cohort, and those absent from the frozen one as their median is zero."""
    return world.cohort.groupBy(*KEY).agg(F.count("*").alias("cohort"), F.count_if(F.col("median_views") == 0).alias("zero_median"))


def uploads_after(cohort: DataFrame, video: DataFrame, snapshot: DataFrame, upload_days: int, low: int, high: int) -> DataFrame:
    """next_reach with the uploads that it is of: every channel with an upload in the days after, reach NULL and read 0 where
    none was read in time."""
    made = cohort.select(*KEY, "channel_id").join(video.filter("not is_short"), "channel_id")
    made = made.filter("published > day and published <= date_add(day, {})".format(upload_days)).groupBy(*KEY, "channel_id").agg(F.count("*").alias("uploads"))
    read = next_reach(cohort, video, snapshot, upload_days, low, high)
    return made.join(read, [*KEY, "channel_id"], "left").withColumn("read", F.coalesce("read", F.lit(0)))


def next_reach(cohort: DataFrame, video: DataFrame, snapshot: DataFrame, upload_days: int, low: int, high: int) -> DataFrame:
    """Mean ln(1 + views) of a channel's long-form uploads in the days after: each read at its smallest age in [low, high]."""
    made = cohort.select(*KEY, "channel_id").join(video.filter("not is_short"), "channel_id")
    made = made.filter("published > day and published <= date_add(day, {})".format(upload_days))
    age = F.datediff("observed_date", "published")
    read = made.join(snapshot.filter("views is not null"), "video_id").withColumn("age", age).filter(F.col("age").between(low, high))
    read = read.groupBy(*KEY, "channel_id", "video_id", "age").agg(F.max("views").alias("views"))
    read = read.groupBy(*KEY, "channel_id", "video_id").agg(F.min_by("views", "age").alias("views"))
    return read.groupBy(*KEY, "channel_id").agg(F.round(F.avg(F.log1p("views")), 6).alias("reach"), F.count("*").alias("read"))


def assembled(panel: DataFrame, least: int) -> DataFrame:
    """Rows of (day, cluster) with at least so many outcomes."""
    return panel.filter("y is not null").withColumn("__n", F.count("*").over(Window.partitionBy(*KEY))).filter(F.col("__n") >= least).drop("__n")


def sample(rows: DataFrame, by: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum, in the order of a keyed hash: the same whatever the partitioning."""
    order = Window.partitionBy(by).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key)
    return rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)


def velocity(snapshot: DataFrame, video: DataFrame) -> DataFrame:
    """Per video: first and last reading, their days apart, views a day between them, since publication, over the last day
    (NULL without a reading of the day before the last), and the last day's rate over that between first and last."""
    daily = snapshot.filter("views is not null").groupBy("video_id", "observed_date").agg(F.max("views").alias("views"))
    order = Window.partitionBy("video_id").orderBy("observed_date")
    daily = daily.withColumn("gained", F.when(F.datediff("observed_date", F.lag("observed_date").over(order)) == 1, F.col("views") - F.lag("views").over(order)))
    out = daily.groupBy("video_id").agg(
        F.min_by("views", "observed_date").alias("first_views"), F.max_by("views", "observed_date").alias("last_views"), F.datediff(F.max("observed_date"), F.min("observed_date")).alias("days"),
        F.max("observed_date").alias("__last"), F.max_by(F.struct("gained"), "observed_date").alias("__g"),
    ).join(video.select("video_id", "published"), "video_id", "left")
    rate = F.try_divide(F.col("last_views") - F.col("first_views"), F.nullif("days", F.lit(0)))
    age = F.datediff("__last", "published")
    gained = F.col("__g.gained").cast("double")
    return out.select(
        "video_id", "first_views", "last_views", "days", F.round(rate, 6).alias("per_day"), F.round(F.when(age > 0, F.col("last_views") / F.nullif(age, F.lit(0))), 6).alias("lifetime"),
        gained.alias("last_day"), F.round(F.when((gained != 0) & (rate > 0), gained / F.nullif(rate, F.lit(0.0))), 6).alias("acceleration"),
    )


def channel_baseline(video: DataFrame, views: DataFrame, low: int, high: int) -> DataFrame:
    """Per channel and day over long-form videos aged low to high days: n, median, 90th place, mean days between uploads."""
    own = video.filter("not is_short").join(views, "video_id").filter(F.datediff("day", "published").between(low, high))
    out = own.groupBy("channel_id", "day").agg(
        F.count("*").alias("n"), F.median("views").alias("median_views"), F.expr("element_at(sort_array(collect_list(views)), cast(floor(0.9 * (count(*) - 1)) as int) + 1)").alias("p90"),
        F.datediff(F.max("published"), F.min("published")).alias("span"),
    )
    return out.withColumn("interval", F.round(F.try_divide("span", F.nullif(F.col("n") - 1, F.lit(0))), 6)).drop("span")


def channel_profile(video: DataFrame, views: DataFrame, channel: DataFrame, low: int, high: int, times: int) -> DataFrame:
    """channel_baseline with median views per subscriber and breakthroughs: videos of `times` the channel's median or more."""
    base = channel_baseline(video, views, low, high)
    own = video.filter("not is_short").join(views, "video_id").filter(F.datediff("day", "published").between(low, high)).select("channel_id", "day", "views")
    hits = own.join(base.select("channel_id", "day", "median_views"), ["channel_id", "day"])
    hits = hits.groupBy("channel_id", "day").agg(F.count_if((F.col("median_views") > 0) & (F.col("views") >= times * F.col("median_views"))).alias("breakthroughs"))
    out = base.join(hits, ["channel_id", "day"]).join(channel.select("channel_id", "subs"), "channel_id", "left")
    return out.withColumn("per_sub", F.round(F.try_divide("median_views", F.nullif("subs", F.lit(0))), 6)).drop("subs")


def missing_days(days: DataFrame, *by: str) -> DataFrame:
    """Days between the first and the last of `day`, within `by`, that aren't there."""
    ends = days.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a is not null")
    span = ends.select(*by, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return span.join(days.distinct(), [*by, "day"], "left_anti")


def ok_streaks(days: DataFrame) -> DataFrame:
    """Islands of consecutive days on which all is well: first, last, nights. days: day, ok."""
    good = days.filter("ok").withColumn("island", F.expr("date_sub(day, cast(row_number() over (order by day) as int))"))
    return good.groupBy("island").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count("*").alias("nights")).drop("island")


def frame_draw(rows: DataFrame, by: str, key: str, cap: int, seed: int, least: int, strata: int) -> DataFrame:
    """At most `cap` rows of each stratum in seeded order, with a flag `postponed` if fewer than `least` rows or `strata` strata are drawn."""
    drawn = sample(rows, by, key, cap, seed)
    size = drawn.agg((F.count("*") < least).alias("a"), (F.countDistinct(by) < strata).alias("b")).select((F.col("a") | F.col("b")).alias("postponed"))
    return drawn.crossJoin(F.broadcast(size))  # one row
