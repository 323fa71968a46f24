"""Supply, openness, money and demand metrics: each takes a world or a series and gives a row per cluster and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scoring import percentile_rank
from .world import CHANNEL, KEY, Calendar, World, in_windows, metric_rows, on_niche, swept, upto


def _capped(n: Column, full: float) -> Column:
    return F.least(n / F.lit(full), F.lit(1.0))


def _decided() -> Column:
    return F.when(F.coalesce("total", F.lit(0)) == 0, 0.0).when(F.col("judgeable") == 0, 1.0).otherwise(F.col("on_niche") / F.col("judgeable"))


def _supply(world: World, values: DataFrame, name: str) -> DataFrame:
    """values: cluster, day, value, inputs_n, contributing. Confidence: sample size, share of channels, share decided."""
    joined = values.join(world.universe, KEY, "left").join(world.coverage, KEY, "left")
    share = F.coalesce(F.least(F.try_divide("contributing", "universe"), F.lit(1.0)), F.lit(0.0))
    return metric_rows(world.spine, joined.select(*KEY, "value", "inputs_n", (_capped(F.col("inputs_n"), 30) * share * _decided()).alias("confidence")), name)


def uploads_per_week(world: World) -> DataFrame:
    """Sum over member channels of on-niche long-form uploads in the window over the weeks they were watched in it."""
    since = world.video_spans.groupBy("cluster_id", "channel_id").agg(F.min("published").alias("oldest"))
    per = world.recent_niche(world.upload_days).groupBy(*KEY, "channel_id").agg(F.count_if(~F.col("is_short")).alias("n")).join(since, ["cluster_id", "channel_id"])
    weeks = (F.datediff("day", F.greatest(F.date_sub("day", world.upload_days - 1), F.col("oldest"))) + 1) / 7
    per = per.groupBy(*KEY).agg(F.sum(F.col("n") / weeks).alias("rate"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("some"))
    out = world.universe.select(*KEY).join(per, KEY, "left")
    out = out.select(*KEY, F.coalesce("rate", F.lit(0.0)).alias("value"), F.coalesce("n", F.lit(0)).alias("inputs_n"), F.coalesce("some", F.lit(0)).alias("contributing"))
    return _supply(world, out, "uploads_per_week")


def median_views(world: World) -> DataFrame:
    out = world.eligible_niche.groupBy(*KEY).agg(F.median("views").alias("value"), F.count("*").alias("inputs_n"), F.countDistinct("channel_id").alias("contributing"))
    return _supply(world, out, "median_views")


def trimmed_mean_views(world: World) -> DataFrame:
    """Without a tenth of the videos at either end, from ten videos on."""
    order = Window.partitionBy(*KEY).orderBy("views", "video_id")
    rows = world.eligible_niche.withColumns({"nth": F.row_number().over(order), "n": F.count("*").over(Window.partitionBy(*KEY))})
    cut = F.when(F.col("n") >= 10, F.floor(F.col("n") / 10)).otherwise(0)
    kept = F.when((F.col("nth") > cut) & (F.col("nth") <= F.col("n") - cut), F.col("views"))
    out = rows.groupBy(*KEY).agg(F.avg(kept).alias("value"), F.count("*").alias("inputs_n"), F.countDistinct("channel_id").alias("contributing"))
    return _supply(world, out, "trimmed_mean_views")


def on_niche_share(world: World) -> DataFrame:
    out = world.coverage.select(*KEY, F.try_divide("on_niche", "decided").alias("value"), F.try_divide("decided", "total").alias("confidence"), F.col("decided").alias("inputs_n"))
    return metric_rows(world.spine, out, "on_niche_share")


def format_mix(world: World) -> DataFrame:
    """Shorts among on-niche uploads of the window whose format is known."""
    recent = world.recent_niche(world.upload_days)
    out = recent.groupBy(*KEY).agg(F.count_if("is_short").alias("shorts"), F.count("is_short").alias("inputs_n"), F.countDistinct("channel_id").alias("contributing"))
    return _supply(world, out.withColumn("value", F.try_divide("shorts", "inputs_n")), "format_mix")


def geo_concentration(world: World, country: str) -> DataFrame:
    out = world.channel_counts(own=F.col("country") == country, inputs_n=F.col("country").isNotNull())
    return metric_rows(world.spine, out.select(*KEY, F.try_divide("own", "inputs_n").alias("value"), (F.col("inputs_n") / F.col("total")).alias("confidence"), "inputs_n"), "geo_concentration")


def top10_concentration(world: World) -> DataFrame:
    out = world.top.groupBy(*KEY).agg(
        F.sum(F.when(F.col("place") <= 10, F.col("views"))).alias("ten"), F.sum("views").alias("all"), F.count("*").alias("inputs_n"), F.countDistinct("channel_id").alias("contributing")
    )
    value = F.when(F.col("inputs_n") >= 20, F.try_divide("ten", "all"))
    return _supply(world, out.withColumn("value", value), "top10_concentration")


def median_top_video_age(world: World) -> DataFrame:
    out = world.top.groupBy(*KEY).agg(F.median(F.datediff("day", "published") / 365.25).alias("value"), F.count("*").alias("inputs_n"), F.countDistinct("channel_id").alias("contributing"))
    return _supply(world, out, "median_top_video_age")


def views_per_new_video(world: World, channel_snapshot: DataFrame) -> DataFrame:
    """Median over member channels of the change of subscribers' reach per new video over the last five readings.

    channel_snapshot: channel_id, observed_date, reach, video_count.
    """
    order = Window.partitionBy("channel_id").orderBy("observed_date")
    first = lambda c: F.first(c).over(order.rowsBetween(-4, 0))
    moves = channel_snapshot.select(
        "channel_id", F.col("observed_date").alias("from"), F.lead("observed_date").over(order).alias("to"),
        (F.col("reach") - first("reach")).alias("gained"), (F.col("video_count") - first("video_count")).alias("made"),
    )
    own = world.channel_spans.select("cluster_id", "channel_id", "start", "end").join(moves, "channel_id")
    ends = world.calendar.on(own, F.greatest("start", "from"), F.least("end", "to")).filter("made > 0 and gained >= 0")
    out = ends.groupBy(*KEY).agg(F.median(F.col("gained") / F.col("made")).alias("value"), F.count("*").alias("inputs_n"), F.count("*").alias("contributing"))
    return _supply(world, out, "views_per_new_video")


def breakthrough_rate(world: World) -> DataFrame:
    """Share of the cohort with a video of five times the channel's median or ten times its subscribers."""
    broke = ((F.col("median_views") != 0) & (F.col("max_views") >= 5 * F.col("median_views"))) | (F.col("max_views") >= 10 * F.col("subs"))
    out = world.cohort.groupBy(*KEY).agg(F.avg(broke.cast("double")).alias("value"), F.count("*").alias("inputs_n"))
    return metric_rows(world.spine, out.withColumn("confidence", _capped(F.col("inputs_n"), 30)), "breakthrough_rate_cohort")


def views_per_sub(world: World) -> DataFrame:
    out = world.cohort.groupBy(*KEY).agg(F.median(F.col("median_views") / F.col("subs")).alias("value"), F.count("*").alias("inputs_n"))
    return metric_rows(world.spine, out.withColumn("confidence", _capped(F.col("inputs_n"), 30)), "views_per_sub")


def winner_age_years(world: World) -> DataFrame:
    seen = world.channel.select("channel_id", F.col("first_seen").alias("since"))
    out = world.top.join(seen, "channel_id").groupBy(*KEY).agg(
        F.median(F.datediff("day", "since") / 365.25).alias("value"), F.count("*").alias("inputs_n"), (F.countDistinct("channel_id") / 100).alias("confidence")
    )
    return metric_rows(world.spine, out, "winner_age_years")


def midroll_share(world: World, days: int = 90) -> DataFrame:
    recent = world.recent_niche(days)
    out = recent.groupBy(*KEY).agg(F.count_if("midroll").alias("yes"), F.count("midroll").alias("inputs_n"))
    out = out.join(world.coverage, KEY, "left").withColumn("confidence", _capped(F.col("inputs_n"), 100) * F.coalesce(F.try_divide("decided", "total"), F.lit(0.0)))
    return metric_rows(world.spine, out.select(*KEY, F.try_divide("yes", "inputs_n").alias("value"), "confidence", "inputs_n"), "midroll_eligible_share")


def latest_keywords(readings: DataFrame, days: DataFrame, *by: str) -> DataFrame:
    """Per day, keyword and geo (and columns `by`) the newest reading up to the day; of readings of one date the larger volume."""
    key = [*by, "keyword", "geo"]
    order = Window.partitionBy(*key, "observed_date").orderBy(F.desc("volume"), F.desc_nulls_last("bid_high"), F.desc_nulls_last("bid_low"), F.desc_nulls_last("competition"))
    daily = readings.withColumn("nth", F.row_number().over(order)).filter("nth = 1").drop("nth")
    spans = daily.withColumn("until", F.lead("observed_date").over(Window.partitionBy(*key).orderBy("observed_date")))
    return Calendar(days).on(spans, "observed_date", "until").drop("until")


def _mid() -> Column:
    """A keyword's price: the mean of the bids that it has."""
    return F.when(F.col("bid_low").isNotNull() & F.col("bid_high").isNotNull(), (F.col("bid_low") + F.col("bid_high")) / 2).otherwise(F.coalesce("bid_low", "bid_high"))


def keyword_money(latest: DataFrame, curated: int) -> DataFrame:
    """Per day and geo: total volume, share priced, mean competition, volume-weighted bid, median high bid, confidence."""
    rows = latest.withColumn("mid", _mid())
    age = F.datediff("day", "observed_date")
    out = rows.groupBy("day", "geo").agg(
        F.round(F.sum("volume"), 6).alias("volume"), F.round(F.avg(F.col("mid").isNotNull().cast("int")), 6).alias("priced_share"),
        F.round(F.avg("competition"), 6).alias("competition"),
        F.round(F.try_divide(F.sum(F.when(F.col("mid").isNotNull(), F.col("volume") * F.col("mid"))), F.sum(F.when(F.col("mid").isNotNull(), F.col("volume")))), 6).alias("vw_cpc"),
        F.round(F.median("bid_high"), 6).alias("median_bid_high"), F.count("*").alias("n"), F.min(age).alias("age"),
    )
    sure = F.least(F.col("n") / F.lit(curated), F.lit(1.0)) * _capped(F.col("n"), 30) * (30 / F.greatest("age", F.lit(30)))
    return out.withColumn("confidence", F.round(sure, 6)).drop("age")


KEYWORD_METRICS = ["total_monthly_searches", "priced_share", "competition_index_mean", "vw_cpc", "median_bid_high"]


def keyword_features(latest: DataFrame, curated: DataFrame, spine: DataFrame) -> DataFrame:
    """The five keyword metrics of every cluster and day from its latest readings in one market, in one aggregate.

    curated: cluster_id, curated (its number of keywords). Confidence: share of the curated keywords read, keywords used,
    age of the newest reading. A keyword without price or volume is left out of vw_cpc on both sides."""
    rows = latest.withColumn("mid", _mid()).withColumn("weight", F.when(F.col("mid").isNotNull() & (F.col("volume") != 0), F.col("volume")))
    per = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"), F.min(F.datediff("day", "observed_date")).alias("age"),
        F.sum("volume").alias("searches"), F.count("volume").alias("searched"), F.count("mid").alias("priced"),
        F.avg("competition").alias("competition"), F.count("competition").alias("indexed"),
        F.sum(F.col("weight") * F.col("mid")).alias("spend"), F.sum("weight").alias("weights"), F.count("weight").alias("used"),
        F.median("bid_high").alias("high"), F.count("bid_high").alias("highs"),
    )
    values = [F.col("searches"), F.col("priced") / F.col("n"), F.col("competition"), F.try_divide("spend", "weights"), F.col("high")]
    counts = ["searched", "n", "indexed", "used", "highs"]
    each = F.array(*[F.struct(F.lit(k).alias("name"), v.cast("double").alias("value"), F.col(n).alias("inputs_n")) for k, v, n in zip(KEYWORD_METRICS, values, counts, strict=True)])
    sure = F.least(F.col("n") / F.col("curated"), F.lit(1.0)) * (30 / F.greatest("age", F.lit(30)))
    out = per.join(F.broadcast(curated), "cluster_id").select(*KEY, sure.alias("sure"), F.inline(each))
    return metric_rows(spine, out.withColumn("confidence", F.col("sure") * _capped(F.col("inputs_n"), 30)), *KEYWORD_METRICS)


def pressure_index(rows: DataFrame) -> DataFrame:
    """Of metric rows: the mean of the ranks of median_views and uploads_per_week among the day's clusters, for clusters
    that have both. inputs_n is the number of those clusters."""
    names = ["median_views", "uploads_per_week"]
    own = rows.filter(F.col("name").isin(names)).withColumn("rank", percentile_rank("value", ["day", "name"])).filter("rank is not null")
    both = own.groupBy(*KEY).agg(F.avg("rank").alias("value"), F.min("confidence").alias("confidence"), F.count("*").alias("n")).filter("n = 2")
    return both.select(
        *KEY, F.lit("supply").alias("metric_group"), F.lit("pressure_index").alias("name"), F.round("value", 6).alias("value"), "confidence",
        F.count("*").over(Window.partitionBy("day")).alias("inputs_n"), F.lit(None).cast("string").alias("reason"),
    )


LAG = 2


def _windows(series: DataFrame, spine: DataFrame, *backs: int, length: int = 28) -> DataFrame:
    """Per term, day and window w: sum and points of the `length` days that end LAG + backs[w] days before."""
    return in_windows(series, ["term"], Calendar(spine), {w: (LAG + back, length) for w, back in enumerate(backs)})


def _adequacy(points: str, total: str, length: int = 28) -> Column:
    return _capped(F.col(points), length) * _capped(F.col(total), 10_000)


def weekly_views(series: DataFrame, spine: DataFrame, name: str = "weekly_views") -> DataFrame:
    """spine and rows: cluster_id is the term of the series."""
    now = _windows(series, spine, 0).withColumnRenamed("term", "cluster_id")
    out = now.select(*KEY, (F.col("total") / 4).alias("value"), _adequacy("points", "total").alias("confidence"), F.col("points").alias("inputs_n"))
    return metric_rows(spine, out, name)


def change(series: DataFrame, spine: DataFrame, back: int, name: str) -> DataFrame:
    """The last 28 days over the 28 that end `back` days earlier, less 1: momentum (28), year on year (365)."""
    of = lambda c, w, name: F.sum(F.when(F.col("w") == w, F.col(c))).alias(name)
    both = _windows(series, spine, 0, back).groupBy(F.col("term").alias("cluster_id"), "day")
    both = both.agg(of("total", 0, "total"), of("points", 0, "points"), of("total", 1, "before"), of("points", 1, "n")).filter("points is not null and n is not null")
    value = F.try_divide("total", F.nullif("before", F.lit(0.0))) - 1
    sure = F.least(_adequacy("points", "total"), _adequacy("n", "before"))
    return metric_rows(spine, both.select(*KEY, value.alias("value"), sure.alias("confidence"), (F.col("points") + F.col("n")).alias("inputs_n")), name)


def volatility(series: DataFrame, spine: DataFrame) -> DataFrame:
    """Sample deviation of the log change of seven-point chunks of the days present in the last 365."""
    year = Calendar(spine).on(series.filter("value is not null"), F.date_add("observed_date", LAG), F.date_add("observed_date", LAG + 365))
    chunk = F.floor((F.row_number().over(Window.partitionBy("term", "day").orderBy("observed_date")) - 1) / 7)
    weeks = year.withColumn("chunk", chunk).groupBy("term", "day", "chunk").agg(F.sum("value").alias("total"), F.count("*").alias("n")).filter("n = 7")
    before = F.lag("total").over(Window.partitionBy("term", "day").orderBy("chunk"))
    moves = weeks.withColumn("before", before).filter("before > 0 and total > 0").withColumn("move", F.ln(F.col("total") / F.col("before")))
    out = moves.groupBy(F.col("term").alias("cluster_id"), "day").agg(F.stddev_samp("move").alias("sd"), F.count("*").alias("inputs_n"))
    return metric_rows(spine, out.select(*KEY, F.when(F.col("inputs_n") >= 8, F.col("sd")).alias("value"), _capped(F.col("inputs_n"), 51).alias("confidence"), "inputs_n"), "volatility_365d")


def seasonality(series: DataFrame, spine: DataFrame) -> DataFrame:
    """Sample deviation of the twelve month indices (month mean over overall mean), over all history."""
    sums = upto(series.withColumn("month", F.month("observed_date")), ["term", "month"])
    seen = Calendar(spine).on(sums, F.date_add("start", LAG), F.date_add("end", LAG))
    months = seen.select("term", "day", (F.col("total") / F.col("points")).alias("mean"), F.col("total").alias("s"), F.col("points").alias("c"))
    out = months.groupBy(F.col("term").alias("cluster_id"), "day").agg(
        F.stddev_samp("mean").alias("sd"), F.sum("s").alias("s"), F.sum("c").alias("inputs_n"), F.count("*").alias("months")
    )
    value = F.when(F.col("months") == 12, F.try_divide(F.col("sd"), F.col("s") / F.col("inputs_n")))
    return metric_rows(spine, out.select(*KEY, value.alias("value"), _capped(F.col("inputs_n") / 365.25, 3).alias("confidence"), "inputs_n"), "seasonality")


def total_searches(latest: DataFrame, curated: int) -> DataFrame:
    """Per day and geo: monthly searches, known volumes only, with coverage, adequacy and freshness as confidence."""
    age = F.greatest(F.min(F.datediff("day", "observed_date")), F.lit(30))
    sure = F.least(F.count("*") / F.lit(curated), F.lit(1.0)) * F.least(F.count("volume") / F.lit(30), F.lit(1.0)) * (30 / age)
    return latest.groupBy("day", "geo").agg(F.sum("volume").alias("value"), F.count("volume").alias("inputs_n"), F.round(sure, 6).alias("confidence"))


def curve_momentum(curves: DataFrame, spine: DataFrame, half: int = 13) -> DataFrame:
    """Mean of the last 13 points over that of the 13 before, less 1, on the newest curve up to the day.

    curves: term, observed_date, points (array of at, value, in order); cluster_id is the term."""
    daily = curves.groupBy("term", "observed_date").agg(F.max("points").alias("p"))
    until = F.lead("observed_date").over(Window.partitionBy("term").orderBy("observed_date"))
    newest = Calendar(spine).on(daily.withColumn("until", until), "observed_date", "until").select("term", "day", "p")
    pts = newest.withColumn("p", F.filter("p", lambda x: x["at"] <= F.col("day"))).withColumn("p", F.expr(f"slice(reverse(p), 1, {2 * half})"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x["value"])
    late, early, n = total(F.slice("p", 1, half)), total(F.slice("p", half + 1, half)), F.size("p")
    value = F.when(n == 2 * half, F.try_divide(late, F.nullif(early, F.lit(0.0))) - 1)
    sure = F.size(F.filter("p", lambda x: x["value"] != 0)) / (2.0 * half)
    rows = pts.select(F.col("term").alias("cluster_id"), "day", value.alias("value"), sure.alias("confidence"), n.alias("inputs_n"))
    return metric_rows(spine, rows, "trends_momentum_13w")


def _facts(rows: DataFrame, name: str, **fields: str) -> DataFrame:
    """Columns of rows as facts of a metric: cluster_id, day, name, field, label, value."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(None).cast("string").alias("label"), F.col(c).cast("double").alias("value")) for f, c in fields.items()])
    return rows.select(*KEY, F.lit(name).alias("name"), F.inline(each)).filter("value is not null")


def details(world: World, series: DataFrame, countries: int = 5) -> DataFrame:
    """What stands behind a value, as facts (cluster_id, day, name, field, label, value).

    median_views: the 90th percentile (lower), channels that contribute, channels and videos that ballast takes out.
    uploads_per_week: channels that publish in the window, and those, of all and of the former, whose first video lies in
    it, so that their span is cut. geo_concentration: the countries with most channels. seasonality: an index for each month,
    the highest and lowest month (the earlier of equals). A fact that doesn't exist has no row. series: term is the cluster."""
    whole = Window.partitionBy(*KEY)
    ranked = world.eligible_niche.withColumns({"nth": F.row_number().over(whole.orderBy("views")), "n": F.count("*").over(whole)})
    p90 = F.max(F.when(F.col("nth") == F.floor(0.9 * (F.col("n") - 1)) + 1, F.col("views")))
    views = _facts(ranked.groupBy(*KEY).agg(p90.alias("p"), F.countDistinct("channel_id").alias("c")), "median_views", p90_views="p", contributing_channels="c")
    out_of = world.calendar.on(swept(world.ballast_spans, ["cluster_id"])).drop("start", "end")
    lost = world.ballast_spans.select(*CHANNEL, F.col("start").alias("from"), F.col("end").alias("to"))
    cut = world.video_spans.select(*CHANNEL, "start").join(lost, CHANNEL).select("cluster_id", F.greatest("start", "from").alias("start"), F.col("to").alias("end"))
    rows = world.calendar.on(swept(cut.filter("end is null or start < end"), ["cluster_id"])).drop("start", "end")
    ballast = _facts(out_of, "median_views", ballast_channels="total").unionByName(_facts(rows, "median_views", ballast_rows="total"))

    since = world.video_spans.groupBy(*CHANNEL).agg(F.min("published").alias("oldest"))
    ends = F.date_add("oldest", world.upload_days)
    young = world.channel_spans.join(since, CHANNEL).withColumns({"start": F.greatest("start", "oldest"), "end": F.least("end", ends)})
    young = world.calendar.on(swept(young.filter("start < end"), ["cluster_id"])).drop("start", "end")
    active = world.recent_niche(world.upload_days).filter("not is_short").select(*KEY, "channel_id").distinct().join(since, CHANNEL)
    cut_off = F.col("oldest") >= F.date_sub("day", world.upload_days - 1)
    active = active.groupBy(*KEY).agg(F.count("*").alias("n"), F.count_if(cut_off).alias("cut"))
    uploads = _facts(active, "uploads_per_week", channels_publishing="n", publishing_span_censored="cut").unionByName(_facts(young, "uploads_per_week", channels_span_censored="total"))

    own = world.calendar.on(swept(world.channel_spans.filter("country is not null"), ["cluster_id", "country"]))
    nth = F.row_number().over(whole.orderBy(F.desc("total"), "country"))
    top = own.withColumn("nth", nth).filter(F.col("nth") <= countries)
    geo = top.select(*KEY, F.lit("geo_concentration").alias("name"), F.concat(F.lit("country_"), "nth").alias("field"), F.col("country").alias("label"), F.col("total").cast("double").alias("value"))

    sums = upto(series.withColumn("month", F.month("observed_date")), ["term", "month"])
    months = world.calendar.on(sums, F.date_add("start", LAG), F.date_add("end", LAG)).withColumnRenamed("term", "cluster_id").withColumn("mean", F.col("total") / F.col("points"))
    whole_year = F.sum("total").over(whole) / F.sum("points").over(whole)
    months = months.withColumns({"year": whole_year, "months": F.count("*").over(whole)}).filter("months = 12 and year <> 0")
    index = months.select(*KEY, F.lit("seasonality").alias("name"), F.concat(F.lit("month_"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("field"), F.lit(None).cast("string").alias("label"), F.round(F.col("mean") / F.col("year"), 3).alias("value"))
    ends = months.groupBy(*KEY).agg(F.min(F.struct(-F.col("mean"), "month")).getField("month").alias("high"), F.min(F.struct("mean", "month")).getField("month").alias("low"))
    season = index.unionByName(_facts(ends, "seasonality", peak_month="high", trough_month="low"))
    return views.unionByName(ballast).unionByName(uploads).unionByName(geo).unionByName(season)
