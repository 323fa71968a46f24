"""Watch lists, selections, gates and checks over stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .world import KEY


def retired(channel: DataFrame, video: DataFrame, day: str) -> DataFrame:
    """A cluster is active while any of its videos is on the niche; others retire on the day."""
    per = video.filter("relevance >= 0.55").select("channel_id").distinct().join(channel.select("channel_id", "cluster_id"), "channel_id").select("cluster_id", F.lit(True).alias("live")).distinct()
    active = F.coalesce(F.col("live"), F.lit(False))
    return channel.select("cluster_id").distinct().join(per, "cluster_id", "left").select("cluster_id", active.alias("active"), F.when(~active, F.lit(day).cast("date")).alias("retired_on"))


def due(video: DataFrame, channel: DataFrame, day: str, low: int, high: int, subs: int) -> DataFrame:
    """Long-form videos aged low to high days of channels with 1 to `subs` subscribers."""
    age = F.datediff(F.lit(day).cast("date"), "published")
    small = channel.filter(F.col("subs").between(1, subs)).select("channel_id")
    return video.filter("not is_short").filter(age.between(low, high)).join(small, "channel_id", "left_semi")


def watchlist(video: DataFrame, channel: DataFrame, snapshot: DataFrame, day: str, low: int, high: int, subs: int, cap: int) -> DataFrame:
    """Of the videos due, those not read on the day, oldest first."""
    today = snapshot.filter(F.col("observed_date") == F.lit(day).cast("date")).select("video_id")
    return due(video, channel, day, low, high, subs).join(today, "video_id", "left_anti").select("video_id", "published").orderBy("published", "video_id").limit(cap)


def coverage(rows: DataFrame, least: int, share: float) -> DataFrame:
    """population, held, share and whether to warn: below the share in a population that is large enough."""
    out = rows.agg(F.count("*").alias("population"), F.count_if(F.coalesce("held", F.lit(False))).alias("held"))
    ratio = F.try_divide("held", F.nullif("population", F.lit(0)))
    return out.select("population", "held", F.round(ratio, 6).alias("share"), ((F.col("population") >= least) & (F.col("held") < share * F.col("population"))).alias("warn"))


def selected(hits: DataFrame, videos: int, channels: int) -> DataFrame:
    """Each channel goes to the niche with most of its hits (ties: first slug), if it has enough; niches with enough channels stay."""
    own = hits.groupBy("channel_id", "slug").agg(F.count("*").alias("n")).filter(F.col("n") >= videos)
    by = Window.partitionBy("channel_id")
    best = own.withColumns({"k": F.row_number().over(by.orderBy(F.desc("n"), "slug")), "rivals": F.count("*").over(by)}).filter("k = 1")
    return best.groupBy("slug").agg(F.count("*").alias("channels"), F.count_if(F.col("rivals") > 1).alias("contested"), (F.count("*") >= channels).alias("kept"))


def paired(rows: DataFrame, least: int) -> DataFrame:
    """Rows with a score and an outcome, on dates that have enough of them."""
    both = rows.filter("score is not null and outcome is not null")
    return both.withColumn("n", F.count("*").over(Window.partitionBy("date"))).filter(F.col("n") >= least)


def ranked_channels(eligible: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Per cluster and day, the n channels with most views per subscriber, by the upper middle of their views."""
    middle = F.expr("element_at(sort_array(collect_list(views)), cast(floor(count(*) / 2) as int) + 1)")
    own = eligible.groupBy(*KEY, "channel_id").agg(middle.alias("v"), F.count("*").alias("videos"))
    own = own.join(members.filter("subs > 0").select(*KEY, "channel_id", "subs"), [*KEY, "channel_id"]).withColumn("per_sub", F.col("v") / F.col("subs"))
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("per_sub"), "channel_id"))
    return own.withColumn("place", place).filter(F.col("place") <= n).select(*KEY, "channel_id", "videos", F.round("per_sub", 6).alias("per_sub"), "place")


def agreement(rows: DataFrame) -> DataFrame:
    """n, agreement, Cohen's kappa and disagreements of the boolean columns a and b."""
    share = lambda c: F.avg(c.cast("int"))
    a, b = F.col("a"), F.col("b")
    s = rows.agg(F.count("*").alias("n"), share(a == b).alias("agree"), share(a).alias("pa"), share(b).alias("pb"), F.count_if(a != b).alias("disagreements"))
    chance = F.col("pa") * F.col("pb") + (1 - F.col("pa")) * (1 - F.col("pb"))
    return s.select("n", "disagreements", F.round("agree", 6).alias("agreement"), F.round(F.try_divide(F.col("agree") - chance, F.nullif(1 - chance, F.lit(0.0))), 6).alias("kappa"))


def gated(rows: DataFrame, policy: DataFrame) -> DataFrame:
    """Values that the policy (name, cluster_id) withholds are NULL, with the reason. The policy is a small hand-kept table."""
    held = policy.withColumn("reason", F.lit("axis not validated"))
    out = rows.join(held, ["name", "cluster_id"], "left")
    return out.withColumn("value", F.when(F.col("reason").isNull(), F.col("value")))


def latest_day(rows: DataFrame) -> DataFrame:
    return rows.join(rows.groupBy("cluster_id").agg(F.max("day").alias("day")), ["cluster_id", "day"], "left_semi")


def worst_status(runs: DataFrame, by: list[str]) -> DataFrame:
    """The worst status per source and day: a failure wins."""
    severity = F.when(F.col("status") == "failed", 0).when(F.col("status") == "partial", 1).otherwise(2)
    return runs.groupBy(*by).agg(F.min_by("status", severity).alias("worst"), F.count("*").alias("runs"))


def anchored(rows: DataFrame, anchor: str) -> DataFrame:
    """Every batch rescaled so that the anchor's mean over non-zero values is 100; batches without one go."""
    mean = rows.filter((F.col("term") == anchor) & (F.col("value") != 0)).groupBy("batch").agg(F.avg("value").alias("mean"))
    return rows.join(mean, "batch").withColumn("value", F.col("value") * 100 / F.col("mean"))


def answered(turns: DataFrame) -> DataFrame:
    """Threads with a question, those with an answer, and the share without one."""
    per = turns.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("asked"), F.count_if(F.col("role") == "assistant").alias("answers")).filter("asked > 0")
    return per.agg(F.count("*").alias("threads"), F.count_if(F.col("answers") > 0).alias("answered"), F.round(F.avg((F.col("answers") == 0).cast("int")), 6).alias("unanswered_rate"))


def drilldown(shapes: dict[str, DataFrame], rows: int = 200) -> DataFrame:
    """What a metric was made of: metric, cluster_id, day, input_id, value, place: the largest inputs of each cluster and day.

    shapes: metric -> (cluster_id, day, input_id, value). The cap is the feature: a page shows so many."""
    order = Window.partitionBy("metric", "cluster_id", "day").orderBy(F.desc("value"), "input_id")
    every = [df.select(F.lit(name).alias("metric"), "cluster_id", "day", F.col("input_id").cast("string").alias("input_id"), F.col("value").cast("double").alias("value")) for name, df in shapes.items()]
    out = every[0]
    for df in every[1:]:
        out = out.unionByName(df)
    return out.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows)


def followed(rows: DataFrame, by: list[str], at: str, tie: str, bucket: Column) -> DataFrame:
    """rows with `next`: the `at` of the row that follows in order of at and tie, within by.

    Rows are ordered within buckets (a function of `at` that never falls), so a few keys make many tasks; a bucket's last row
    is followed by the first one of the next bucket that has rows, which is looked up among one row a bucket."""
    marked = rows.withColumn("__b", bucket)
    firsts = marked.groupBy(*by, "__b").agg(F.min(at).alias("__first"))
    after = firsts.select(*by, "__b", F.lead("__first").over(Window.partitionBy(*by).orderBy("__b")).alias("__after"))
    inside = marked.withColumn("next", F.lead(at).over(Window.partitionBy(*by, "__b").orderBy(at, tie)))
    same = reduce(lambda x, y: x & y, [F.col(f"i.{c}").eqNullSafe(F.col(f"a.{c}")) for c in (*by, "__b")])
    ends = inside.alias("i").join(after.alias("a"), same & F.col("i.next").isNull(), "left")
    return ends.select(*[F.col(f"i.{c}") for c in rows.columns], F.coalesce("i.next", "a.__after").alias("next"))


def source_feed(videos: DataFrame, discoveries: DataFrame, lines: int) -> DataFrame:
    """The newest lines of each cluster and day: its videos (KEY, video_id, channel_id, published) with every query that had
    found them by the day, and those that no query found too. place counts lines; ties go by video, query and order.

    Videos are cut before discoveries are joined, as one more video than there are lines can never show."""
    newest = Window.partitionBy(*KEY).orderBy(F.desc("published"), "video_id")
    some = videos.withColumn("__n", F.row_number().over(newest)).filter(F.col("__n") <= lines)
    known = discoveries.select("video_id", "query", "order_by", "found")
    seen = some.join(known, "video_id").filter("found <= day").select(*KEY, "video_id", "query", "order_by")
    joined = some.join(seen, [*KEY, "video_id"], "left")
    order = Window.partitionBy(*KEY).orderBy("__n", F.col("query").asc_nulls_first(), F.col("order_by").asc_nulls_first())
    return joined.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= lines).select(*KEY, "place", "video_id", "channel_id", "published", "query", "order_by")


def steps(history: DataFrame, by: list[str]) -> DataFrame:
    """history (day, definition) with `was`: the definition of the stored day before where that is another one, and `step`."""
    before = Window.partitionBy(*by).orderBy("day")
    rows = history.withColumns({"__was": F.lag("definition").over(before), "__n": F.row_number().over(before)})
    step = (F.col("__n") > 1) & ~F.col("definition").eqNullSafe(F.col("__was"))
    return rows.withColumns({"step": step, "was": F.when(step, F.col("__was"))}).drop("__was", "__n")


def newest_alerts(alerts: DataFrame, lines: int) -> DataFrame:
    """By when, not by how alarming: newest day first, then cluster and rule."""
    return alerts.orderBy(F.desc("day"), "cluster_id", "rule").limit(lines)


def by_sha_prefix(rows: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """The rows whose text's SHA-256 begins with one of the asked prefixes of twelve hex digits (column prefix)."""
    own = rows.withColumn("prefix", F.left(F.sha2(F.coalesce(text, F.lit("")), 256), F.lit(12)))
    return own.join(asked.select("prefix").distinct(), "prefix", "left_semi")


def health(runs: DataFrame) -> DataFrame:
    """(day, source, problem) of runs (day, source, status, snapshots): every source of the registry (all that ever ran) should run
    on every night from the first to the last, finish ok in all its runs, and write something."""
    per = runs.groupBy("day", "source").agg(F.bool_or(F.col("status") != "ok").alias("bad"), F.sum("snapshots").alias("written"))
    ends = runs.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    nights = ends.select(F.explode(F.sequence("a", "b")).alias("day"))
    expected = runs.select("source").distinct().crossJoin(F.broadcast(nights))  # nights are a calendar
    problem = F.when(F.col("bad").isNull(), "did not run").when(F.col("bad"), "finished failed").when(F.coalesce("written", F.lit(0)) == 0, "no snapshots")
    return expected.join(per, ["day", "source"], "left").select("day", "source", problem.alias("problem")).filter("problem is not null")
