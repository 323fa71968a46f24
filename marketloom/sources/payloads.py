"""Raw payloads and what is read out of them: resources and page views in JSON, curves in split frames, feeds in Atom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
SHORT_SECONDS, MIDROLL_SECONDS = 60, 480
SPONSOR = "(?i)sponsored|use code|affiliate|promo code|partner"

VIDEO = """items array<struct<id string, snippet struct<channelId string, title string, description string, publishedAt string>,
  contentDetails struct<duration string>, statistics struct<viewCount string, likeCount string, commentCount string>,
  topicDetails struct<topicCategories array<string>>>>"""
CHANNEL = """items array<struct<id string, snippet struct<title string, country string, publishedAt string>,
  statistics struct<subscriberCount string, viewCount string, videoCount string, hiddenSubscriberCount boolean>>>"""
SEARCH = "items array<struct<id struct<videoId string>, snippet struct<channelId string, title string, publishedAt string>>>"
VIEWS = "items array<struct<article string, timestamp string, views double>>"
CURVE = "columns array<string>, index array<string>, data array<array<double>>"
FEED = "entry array<struct<videoId string, channelId string, title string, published string, group struct<description string, community struct<statistics struct<_views string>, starRating struct<_count string>>>>>"


def land(df: DataFrame, source: str, kind: str, key: Column, payload: Column, run_id: str, at: Column) -> DataFrame:
    """Payloads as they came: source, kind, key, payload, run_id, at. Nothing is interpreted."""
    return df.select(F.lit(source).alias("source"), F.lit(kind).alias("kind"), key.cast("string").alias("key"), payload.alias("payload"), F.lit(run_id).alias("run_id"), at.alias("at"))


def _items(raw: DataFrame, kind: str, schema: str) -> DataFrame:
    """One row per item of the payloads of a kind; a payload that isn't JSON has none."""
    own = raw.filter(F.col("kind") == kind).withColumn("__j", F.from_json("payload", schema))
    return own.select("key", "run_id", "at", F.explode("__j.items").alias("i"))


def whole(text: Column) -> Column:
    """A count in text; what isn't a whole number is NULL."""
    return text.try_cast("bigint")


def seconds(duration: Column) -> Column:
    """Seconds of an ISO 8601 duration of days, hours, minutes and seconds; NULL if absent, malformed or without a part."""
    form = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(duration, form, k), F.lit("")).try_cast("bigint"), F.lit(0))
    total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(duration.rlike(form) & duration.rlike(r"\d"), total)


def videos(raw: DataFrame) -> DataFrame:
    """Video rows. Unknown duration gives unknown formats, but a title that says #shorts settles is_short; no description
    gives no sponsor signal."""
    i = F.col("i")
    title, text = i["snippet"]["title"], i["snippet"]["description"]
    length = seconds(i["contentDetails"]["duration"])
    topics = i["topicDetails"]["topicCategories"]
    return _items(raw, "video", VIDEO).select(
        i["id"].alias("video_id"), i["snippet"]["channelId"].alias("channel_id"), title.alias("title"), text.alias("description"),
        F.try_to_timestamp(i["snippet"]["publishedAt"]).alias("published_at"), length.alias("duration_s"),
        ((length <= SHORT_SECONDS) | F.coalesce(F.contains(F.lower(title), F.lit("#shorts")), F.lit(False))).alias("is_short"), (length >= MIDROLL_SECONDS).alias("midroll_eligible"),
        text.rlike(SPONSOR).alias("sponsor_signal"), F.when(F.size(topics) > 0, F.transform(topics, lambda t: F.element_at(F.split(t, "/"), -1))).alias("topics"),
        F.lit(True).alias("enriched"), "run_id", "at",
    )


def video_readings(raw: DataFrame) -> DataFrame:
    """Readings alone: what a second read of a known video adds."""
    i = F.col("i")
    return _items(raw, "video", VIDEO).select(
        i["id"].alias("video_id"), i["snippet"]["channelId"].alias("channel_id"), F.to_date("at").alias("observed_date"),
        *[whole(i["statistics"][f"{n}Count"]).alias(f"{n}s") for n in ("view", "like", "comment")],
    )


def channels(raw: DataFrame) -> DataFrame:
    """Channel rows with their reading; a hidden subscriber count is NULL."""
    i = F.col("i")
    s = i["statistics"]
    return _items(raw, "channel", CHANNEL).select(
        i["id"].alias("channel_id"), i["snippet"]["title"].alias("title"), i["snippet"]["country"].alias("country"), F.to_date("at").alias("observed_date"),
        F.when(~F.coalesce(s["hiddenSubscriberCount"], F.lit(False)), whole(s["subscriberCount"])).alias("subs"), whole(s["viewCount"]).alias("total_views"), whole(s["videoCount"]).alias("video_count"),
    )


def discoveries(raw: DataFrame) -> DataFrame:
    """Search hits; a payload's key is query|order."""
    i = F.col("i")
    return _items(raw, "search", SEARCH).select(
        i["id"]["videoId"].alias("video_id"), i["snippet"]["channelId"].alias("channel_id"), F.split_part("key", F.lit("|"), F.lit(1)).alias("query"),
        F.split_part("key", F.lit("|"), F.lit(2)).alias("order_by"), F.to_date("at").alias("observed_date"),
    )


def stubs(found: DataFrame) -> DataFrame:
    """One video row, not yet enriched, per video found."""
    return found.groupBy("video_id").agg(F.min("channel_id").alias("channel_id"), F.lit(False).alias("enriched"))


def missing(asked: DataFrame, returned: DataFrame) -> DataFrame:
    """Ids that were asked for and didn't come back: marked as enriched, so that they aren't asked for again."""
    return asked.select("video_id").distinct().join(returned.select("video_id"), "video_id", "left_anti").withColumn("enriched", F.lit(True))


def page_views(raw: DataFrame) -> DataFrame:
    """A demand reading on the day that each item describes."""
    i = F.col("i")
    day = F.to_date(F.substring(i["timestamp"], 1, 8), "yyyyMMdd")
    return _items(raw, "pageviews", VIEWS).select(i["article"].alias("term"), day.alias("observed_date"), i["views"].alias("value"))


def curves(raw: DataFrame) -> DataFrame:
    """term|geo|timeframe keys with the curve of the term's column; a frame without that column has no row."""
    own = raw.filter("kind = 'curve'").withColumn("j", F.from_json("payload", CURVE))
    part = lambda k: F.split_part("key", F.lit("|"), F.lit(k))
    place = F.nullif(F.array_position("j.columns", part(1)).cast("int"), F.lit(0))
    points = F.zip_with("j.index", "j.data", lambda t, r: F.struct(F.to_date(F.substring(t, 1, 10)).alias("day"), F.try_element_at(r, F.col("__p")).alias("value")))
    own = own.withColumn("__p", place).filter("__p is not null")
    return own.select(part(1).alias("term"), part(2).alias("geo"), part(3).alias("timeframe"), F.to_date("at").alias("observed_date"), points.alias("points"))


def feed_entries(raw: DataFrame) -> DataFrame:
    """Entries of Atom feeds: video_id, channel_id, title, description (NULL if absent), views and likes (NULL if absent)."""
    own = raw.filter("kind = 'feed'").withColumn("j", F.from_xml("payload", FEED, {"ignoreNamespace": "true"}))
    e = F.explode("j.entry").alias("e")
    own = own.select("at", e)
    g = F.col("e.group")
    return own.select(
        "e.videoId", "e.channelId", "e.title", F.nullif(g["description"], F.lit("")).alias("description"), whole(g["community"]["statistics"]["_views"]).alias("views"),
        whole(g["community"]["starRating"]["_count"]).alias("likes"), F.to_date("at").alias("observed_date"),
    ).withColumnsRenamed({"videoId": "video_id", "channelId": "channel_id"})


def feed_state(polls: DataFrame) -> DataFrame:
    """Per channel, failures since the last answer of 200 or 304. polls: channel_id, at, status."""
    good = F.max(F.when(F.col("status").isin(200, 304), F.col("at")))
    last = polls.groupBy("channel_id").agg(good.alias("good"), F.max_by("status", "at").alias("last_status"))
    return polls.join(last, "channel_id").groupBy("channel_id", "last_status").agg(F.count_if(F.col("good").isNull() | (F.col("at") > F.col("good"))).alias("fail_count"))
