"""Populations of every cluster on every day of a spine, built once and shared by all metrics.

A population is swept once, into spans: rows with the days from which (`start`) and before which (`end`, NULL: never) they
hold. No span depends on the spine, so a long replay costs what its own rows cost; a day is looked up in a calendar.
"""

from __future__ import annotations

import datetime
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ON_NICHE, NOISE = 0.55, 0.0
KEY = ["cluster_id", "day"]
#: The group of every metric.
GROUPS = {
    "demand": ["weekly_views", "weekly_views_event", "momentum_28d", "yoy", "volatility_365d", "seasonality", "trends_momentum_13w", "total_monthly_searches"],
    "supply": [
        "uploads_per_week", "median_views", "trimmed_mean_views", "on_niche_share", "geo_concentration", "format_mix", "top10_concentration",
        "median_top_video_age", "views_per_new_video", "pressure_index",
    ],
    "openness": ["breakthrough_rate_cohort", "views_per_sub", "winner_age_years"],
    "money": ["midroll_eligible_share", "priced_share", "competition_index_mean", "vw_cpc", "median_bid_high"],
}
#: Why a value is NULL: nothing was read by the day, or what was read does not suffice.
NOTHING, TOO_LITTLE = "no inputs by the day", "inputs do not suffice"


def on_niche() -> Column:
    return F.col("relevance") >= ON_NICHE


def noise() -> Column:
    return F.col("relevance") <= NOISE


def spine(clusters: DataFrame, days: list[str]) -> DataFrame:
    """(cluster_id, day) for every cluster and the given days."""
    out = clusters.select("cluster_id").distinct().select("cluster_id", F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("day"))
    out._days = [datetime.date.fromisoformat(d) for d in days]
    return out


class Calendar:
    """The days of a spine, in which spans are looked up.

    Each date of the calendar knows how many of its days lie before it, so a span finds its days by two joins with a table of
    one row a date, and a span that meets no day is dropped before it is spread. No row is compared with a day."""

    def __init__(self, days: DataFrame) -> None:
        known = getattr(days, "_days", None)
        self.days = sorted({r.day for r in days.select("day").distinct().collect()} if known is None else set(known))
        self.spark = days.sparkSession

    @cached_property
    def index(self) -> DataFrame:
        """(at, i): a row for each date from the first day to the one after the last."""
        n = (self.days[-1] - self.days[0]).days + 2
        dates = [self.days[0] + datetime.timedelta(k) for k in range(n)]
        return self.spark.createDataFrame([(d, bisect_left(self.days, d)) for d in dates], "at date, i int")

    def met(self, spans: DataFrame) -> DataFrame:
        """spans (start, end) without those that are over by the first day or begin after the last."""
        if not self.days:
            return spans.filter("false")
        return spans.filter((F.col("start") <= F.lit(self.days[-1])) & (F.col("end").isNull() | (F.col("end") > F.lit(self.days[0]))))

    def on(self, spans: DataFrame, start: str | Column = "start", end: str | Column | None = "end") -> DataFrame:
        """A row of spans for each day that is not before start and before end; a span without start holds never."""
        if not self.days:
            return spans.withColumn("day", F.lit(None).cast("date")).filter("false")
        first, last = F.lit(self.days[0]), F.lit(self.days[-1] + datetime.timedelta(1))
        begin, stop = (F.col(c) if isinstance(c, str) else c for c in (start, F.lit(None).cast("date") if end is None else end))
        held = spans.filter(begin.isNotNull() & (begin < last)).withColumns({"__a": F.greatest(begin, first), "__b": F.least(F.coalesce(stop, last), last)}).filter("__a < __b")
        for name, number in (("__a", "__i"), ("__b", "__j")):
            held = held.join(F.broadcast(self.index.select(F.col("at").alias(name), F.col("i").alias(number))), name)
        days = F.array(*map(F.lit, self.days))
        held = held.filter("__i < __j").withColumn("__k", F.explode(F.sequence(F.col("__i") + 1, F.col("__j"))))
        return held.withColumn("day", F.element_at(days, F.col("__k"))).drop("__a", "__b", "__i", "__j", "__k")


def running_max(readings: DataFrame, entity: str, value: str) -> DataFrame:
    """(entity, value, valid_from, valid_to): the largest reading so far as intervals; valid_to is NULL for the last one.

    One pass over the readings serves every day of a spine."""
    daily = readings.filter(F.col(value).isNotNull()).groupBy(entity, "observed_date").agg(F.max(value).alias(value))
    order = Window.partitionBy(entity).orderBy("observed_date")
    risen = daily.withColumn("__before", F.max(value).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    risen = risen.filter(F.col("__before").isNull() | (F.col(value) > F.col("__before")))
    return risen.select(entity, value, F.col("observed_date").alias("valid_from"), F.lead("observed_date").over(order).alias("valid_to"))


def swept(spans: DataFrame, by: list[str], **counts: Column) -> DataFrame:
    """How many spans hold, in all (`total`) and of those where each condition is true, as spans of `by` in which no number
    changes. Two signed rows a span are summed by date before they are ordered, so no group holds more rows than dates."""
    ones = {"total": F.lit(1), **{name: F.coalesce(condition, F.lit(False)).cast("int") for name, condition in counts.items()}}
    marked = spans.withColumns({f"__{name}": one for name, one in ones.items()})
    signed = F.filter(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("sign"))), lambda e: e["at"].isNotNull())
    steps = marked.select(*by, *[f"__{name}" for name in ones], F.inline(signed)).groupBy(*by, "at").agg(*[F.sum(F.col(f"__{name}") * F.col("sign")).alias(name) for name in ones])
    order = Window.partitionBy(*by).orderBy("at")
    sums = steps.select(*by, F.col("at").alias("start"), F.lead("at").over(order).alias("end"), *[F.sum(name).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(name) for name in ones])
    return sums.filter("total > 0")


def upto(series: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Prefix sums of a series as spans of `by`: total and points of all its values up to a date."""
    daily = series.filter(F.col(value).isNotNull()).groupBy(*by, "observed_date").agg(F.sum(value).alias("total"), F.count("*").alias("points"))
    order = Window.partitionBy(*by).orderBy("observed_date")
    sums = [F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in ("total", "points")]
    return daily.select(*by, F.col("observed_date").alias("start"), F.lead("observed_date").over(order).alias("end"), *sums)


def in_windows(series: DataFrame, by: list[str], calendar: Calendar, windows: dict[int, tuple[int, int]]) -> DataFrame:
    """(by, day, w, total, points): the sum of the `length` dates that end `back` dates before the day, for each window w:
    (back, length) that has a point. Two look-ups in prefix sums a window, whatever its length."""
    edges = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(shift).alias("shift"), F.lit(sign).alias("sign")) for w, (back, length) in windows.items() for shift, sign in ((back, 1), (back + length, -1))])
    ends = upto(series, by).select("*", F.inline(edges))
    found = calendar.on(ends, F.date_add("start", F.col("shift")), F.date_add("end", F.col("shift")))
    sums = [F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("total", "points")]
    return found.groupBy(*by, "day", "w").agg(*sums).filter("points > 0")


#: Later than any date: what never comes about.
NEVER = datetime.date(9999, 12, 31)


def overtaken(rows: DataFrame, by: list[str], order: list[Column], since: str, n: int) -> DataFrame:
    """rows with `end`: the date from which n rows before it (in order, within by) hold too, NULL if that never comes.

    It is the n-th smallest `since` of the rows before, found by running minima: what a row's value displaces at one level
    goes on to the next. All levels share one sort, and memory holds n dates."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__v", F.col(since))
    for k in range(n):
        rows = rows.withColumn("end", F.min("__v").over(window))
        if k < n - 1:
            rows = rows.withColumn("__v", F.when(F.col("end").isNull(), F.lit(NEVER)).otherwise(F.greatest("__v", "end")))
    return rows.withColumn("end", F.nullif("end", F.lit(NEVER))).drop("__v")


def _but(spans: DataFrame, out: DataFrame, by: list[str]) -> DataFrame:
    """spans without the days of at most one span of `out` for each key: up to two pieces of each."""
    apart = spans.join(out.select(*by, F.col("start").alias("__s"), F.col("end").alias("__e")), by, "left")
    piece = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    before = piece(F.col("start"), F.least("end", "__s"))
    after = F.when(F.col("__e").isNotNull(), piece(F.greatest("start", "__e"), F.col("end")))
    kept = F.filter(F.array(before, after), lambda p: p["start"].isNotNull() & (p["end"].isNull() | (p["start"] < p["end"])))
    rest = [c for c in spans.columns if c not in ("start", "end")]
    return apart.select(*rest, F.inline(kept))


CHANNEL = ["cluster_id", "channel_id"]


@dataclass
class World:
    """Source tables and a spine, in which every cluster has every day. A frame of it holds all clusters and days; nothing
    sees rows after its day.

    What many metrics read (eligible videos, numbers of members and of their videos) is kept in Spark's cache, so that one pass
    serves them all, whatever columns each takes; builds on the same tables and days share it."""

    spine: DataFrame
    channel: DataFrame
    video: DataFrame
    snapshot: DataFrame
    ballast_decided: int = 10
    cohort_videos: int = 5
    small_subs: int = 10_000
    upload_days: int = 28
    newest: int = 15
    #: The definition of a member that is pinned: "ballast" leaves ballast out, "members" counts it.
    definition: str = "ballast"

    @cached_property
    def calendar(self) -> Calendar:
        return Calendar(self.spine)

    @cached_property
    def days(self) -> DataFrame:
        return F.broadcast(self.spine.select("day").distinct())

    @cached_property
    def member_spans(self) -> DataFrame:
        """Channels, from when they were seen."""
        return self.channel.filter("cluster_id is not null and first_seen is not null").withColumns({"start": F.col("first_seen"), "end": F.lit(None).cast("date")})

    @cached_property
    def video_spans(self) -> DataFrame:
        """Videos of channels, from when they were published and their channel was seen."""
        own = self.video.filter("published is not null").join(self.member_spans.select(*CHANNEL, "subs", "start"), "channel_id")
        return own.withColumns({"start": F.greatest("start", "published"), "end": F.lit(None).cast("date")})

    @cached_property
    def ballast_spans(self) -> DataFrame:
        """Channels of which enough videos are decided, until one is on the niche: neither is undone later."""
        known = self.video_spans.filter(on_niche() | noise()).select(*CHANNEL, "start", on_niche().alias("on"))
        nth = F.row_number().over(Window.partitionBy(*CHANNEL).orderBy("start"))
        enough = known.withColumn("nth", nth).filter(F.col("nth") <= self.ballast_decided).filter(F.col("nth") == self.ballast_decided).select(*CHANNEL, "start")
        first = known.filter("on").groupBy(*CHANNEL).agg(F.min("start").alias("end"))
        return enough.join(first, CHANNEL, "left").filter("end is null or start < end")

    @cached_property
    def channel_spans(self) -> DataFrame:
        """Members without their time as ballast, or whole where the definition says so."""
        if self.definition == "members":
            return self.member_spans
        return _but(self.member_spans, self.ballast_spans, CHANNEL)

    @cached_property
    def view_curves(self) -> DataFrame:
        """(video_id, curve, read): the largest reading so far as an array of spans, no longer than there are dates, and the
        date of the first one."""
        spans = running_max(self.snapshot, "video_id", "views")
        point = F.struct(F.col("valid_from").alias("v_start"), F.col("valid_to").alias("v_end"), "views")
        return spans.groupBy("video_id").agg(F.collect_list(point).alias("curve"), F.min("valid_from").alias("read"))

    @staticmethod
    def _viewed(spans: DataFrame) -> DataFrame:
        """Spans with a curve, cut where their views change."""
        rest = [c for c in spans.columns if c not in ("start", "end", "curve", "read")]
        cut = spans.select(*rest, "start", "end", F.inline("curve")).withColumns({"start": F.greatest("start", "v_start"), "end": F.least("end", "v_end")})
        return cut.filter("end is null or start < end").drop("v_start", "v_end")

    @cached_property
    def eligible_spans(self) -> DataFrame:
        """Long-form videos at least 14 days old with a reading, while fewer than `newest` newer ones of their channel are so."""
        old = self.video_spans.filter("not is_short").join(self.view_curves, "video_id")
        old = old.withColumn("start", F.greatest("start", "read", F.date_add("published", 14)))
        ranked = overtaken(old, CHANNEL, [F.desc("published"), F.col("video_id")], "start", self.newest)
        return self.calendar.met(self._viewed(ranked.filter("end is null or start < end"))).persist()

    @cached_property
    def members(self) -> DataFrame:
        """Channels of a cluster that had been seen by the end of the day."""
        return self.calendar.on(self.member_spans).drop("start", "end")

    @cached_property
    def member_videos(self) -> DataFrame:
        """Videos of members, published by the day."""
        return self.calendar.on(self.video_spans).drop("start", "end")

    @cached_property
    def ballast(self) -> DataFrame:
        """Members of which enough videos are decided and none is on the niche."""
        return self.calendar.on(self.ballast_spans).select(*KEY, "channel_id")

    @cached_property
    def member_channels(self) -> DataFrame:
        return self.calendar.on(self.channel_spans).drop("start", "end")

    def channel_counts(self, **conditions: Column) -> DataFrame:
        """Per cluster and day the number of member channels (total), and of those for which each condition is true."""
        return self.calendar.on(swept(self.channel_spans, ["cluster_id"], **conditions)).drop("start", "end")

    @cached_property
    def universe(self) -> DataFrame:
        """Per cluster and day the number of member channels."""
        return self.channel_counts().withColumnRenamed("total", "universe").persist()

    @cached_property
    def niche_videos(self) -> DataFrame:
        return self.calendar.on(self.video_spans.filter(on_niche())).drop("start", "end")

    def recent_niche(self, days: int) -> DataFrame:
        """On-niche videos published in the `days` that end on the day."""
        return self.calendar.on(self.video_spans.filter(on_niche()), "start", F.date_add("published", days)).drop("start", "end")

    @cached_property
    def coverage(self) -> DataFrame:
        """Per cluster and day, of member channels: on_niche, judgeable (not noise), decided, total videos."""
        own = self.video_spans if self.definition == "members" else _but(self.video_spans, self.ballast_spans, CHANNEL)
        counts = swept(own, ["cluster_id"], on_niche=on_niche(), judgeable=~F.coalesce(noise(), F.lit(False)), decided=on_niche() | noise())
        return self.calendar.on(counts).drop("start", "end").persist()

    @cached_property
    def views(self) -> DataFrame:
        """(video_id, day, views): the largest reading up to the day."""
        return self.calendar.on(running_max(self.snapshot, "video_id", "views"), "valid_from", "valid_to").select("video_id", "day", "views")

    @cached_property
    def eligible(self) -> DataFrame:
        """The newest 15 of each channel among long-form videos at least 14 days old with a reading."""
        return self.calendar.on(self.eligible_spans).drop("start", "end")

    @cached_property
    def eligible_niche(self) -> DataFrame:
        """The on-niche ones among eligible videos: after the cut to 15, not before."""
        return self.calendar.on(self.eligible_spans.filter(on_niche())).drop("start", "end")

    @cached_property
    def date_discovered(self) -> DataFrame:
        """Channels of which a search by date had found a video by the day."""
        found = self.video_spans.filter("by_date").groupBy(*CHANNEL).agg(F.min("start").alias("start"))
        return self.calendar.on(found, end=None).select(*KEY, "channel_id")

    @cached_property
    def cohort(self) -> DataFrame:
        """Small channels found by date that have enough eligible videos."""
        small = self.calendar.on(self.eligible_spans.filter((F.col("subs") > 0) & (F.col("subs") <= self.small_subs)))
        enough = small.groupBy(*KEY, "channel_id", "subs").agg(F.count("*").alias("videos"), F.median("views").alias("median_views"), F.max("views").alias("max_views"), F.median(F.datediff("day", "published")).alias("median_age"))
        found = self.video_spans.filter("by_date").groupBy(*CHANNEL).agg(F.min("start").alias("found"))
        return enough.filter(F.col("videos") >= self.cohort_videos).join(found, CHANNEL).filter("found <= day").select(*KEY, "channel_id", "subs", "videos", "median_views", "max_views", "median_age")

    @cached_property
    def top(self) -> DataFrame:
        """The 100 on-niche videos with the most views."""
        order = Window.partitionBy(*KEY).orderBy(F.desc("views"), "video_id")
        viewed = self._viewed(self.video_spans.filter(on_niche()).join(self.view_curves, "video_id"))
        return self.calendar.on(viewed).drop("start", "end").withColumn("place", F.row_number().over(order)).filter("place <= 100")


def group_of(name: str) -> str | None:
    return next((group for group, names in GROUPS.items() if name in names), None)


def metric_rows(spine: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    """One row per cluster, day and name: group, value, confidence, inputs_n, reason. What cannot be computed is NULL with
    confidence 0 and a reason. values need a column `name` if several names are given."""
    seen = values.withColumn("__seen", F.lit(True))
    if len(names) == 1:
        out = spine.join(seen.drop("name"), KEY, "left").withColumn("name", F.lit(names[0]))
    else:
        out = spine.withColumn("name", F.explode(F.array(*map(F.lit, names)))).join(seen, [*KEY, "name"], "left")
    group = F.lit(None).cast("string")
    for g in GROUPS:
        if own := [n for n in names if group_of(n) == g]:
            group = F.when(F.col("name").isin(own), g).otherwise(group)
    known = F.col("value").isNotNull()
    return out.select(
        *KEY, group.alias("metric_group"), "name", F.round("value", 6).alias("value"),
        F.when(known, F.round(F.coalesce("confidence", F.lit(0.0)), 6)).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(known, F.coalesce("inputs_n", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("inputs_n"),
        F.when(known, F.lit(None)).when(F.col("__seen"), TOO_LITTLE).otherwise(NOTHING).cast("string").alias("reason"),
    )
