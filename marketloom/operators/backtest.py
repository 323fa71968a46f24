"""Load of a selected population for a backtest: the tables that a replay reads, from dumps and the scan's hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import versions
from .tables import first_writes, insert_ignore, upsert

#: The conflict key of each table.
KEYS = {
    "niche_seeds": ["slug"], "seed_terms": ["slug", "source", "term", "stratum"], "clusters": ["cluster_id"], "channels": ["channel_id"],
    "channel_snapshots": ["channel_id", "observed_date", "source"], "cluster_members": ["item_type", "item_id"], "videos": ["video_id"],
}
FIRST_WRITE_WINS = {"channel_snapshots"}


def owners(hits: DataFrame, videos: int, channels: int) -> DataFrame:
    """(channel_id, slug): each channel's niche, the one with most of its hits (ties: first slug) and `videos` at least, of
    niches that have `channels` at least."""
    own = hits.groupBy("channel_id", "slug").agg(F.count("*").alias("n")).filter((F.col("n") >= videos) & F.col("channel_id").isNotNull())
    best = own.groupBy("channel_id").agg(F.min_by("slug", F.struct(-F.col("n"), "slug")).alias("slug"))
    kept = best.groupBy("slug").agg(F.count("*").alias("channels")).filter(F.col("channels") >= channels)
    return best.join(kept, "slug", "left_semi")


def population(selected: DataFrame, hits: DataFrame, channels: DataFrame, weekly: DataFrame, catalogue: DataFrame, terms: DataFrame, at: str, crawled: str) -> dict[str, DataFrame]:
    """The tables of a load.

    selected (channel_id, slug); hits (video_id, channel_id, slug, relevance, published): one counts only if its slug owns its
    channel, and a video's best one; channels (channel_id, title, join_date); weekly (channel_id, week, videos, subs);
    catalogue (slug, label) and terms (slug, term) of every committed niche, selected or not. `at` is the day of the load.
    A channel is first seen with its first weekly reading, else on the day of the crawl.
    """
    stamp = [F.lit("dump").alias("source"), F.lit(at).cast("date").alias("at")]
    mine = selected.select("channel_id", "slug")
    snapshots = weekly.join(mine.select("channel_id"), "channel_id", "left_semi")
    snapshots = snapshots.select("channel_id", F.col("week").alias("observed_date"), "subs", F.col("videos").alias("video_count"), *stamp)
    first = snapshots.groupBy("channel_id").agg(F.min("observed_date").alias("first"))
    known = channels.join(mine.select("channel_id"), "channel_id", "left_semi").join(first, "channel_id", "left")
    own = hits.filter("video_id is not null").join(mine, ["channel_id", "slug"])
    best = first_writes(own, ["video_id"], [F.desc("relevance"), F.col("channel_id"), F.col("published")])
    member = lambda rows, kind, item, relevance: rows.select(
        F.col("slug").alias("cluster_id"), F.lit(kind).alias("item_type"), F.col(item).cast("string").alias("item_id"), relevance.alias("relevance"), F.lit(False).alias("is_noise"), *stamp
    )
    counted = mine.groupBy("slug").agg(F.count("*").alias("channels"))
    return {
        "niche_seeds": catalogue.select("slug", "label", F.lit("en").alias("lang"), F.lit(True).alias("active")),
        "seed_terms": terms.select("slug", F.lit("wikipedia").alias("source"), "term", F.lit("topic").alias("stratum"), F.lit(True).alias("active")).distinct(),
        "clusters": counted.join(catalogue, "slug", "left").select(F.col("slug").alias("cluster_id"), "label", F.lit(True).alias("active"), "channels", *stamp),
        "channels": known.select("channel_id", "title", F.col("join_date").alias("created"), F.coalesce("first", F.lit(crawled).cast("date")).alias("first_seen"), *stamp),
        "channel_snapshots": snapshots,
        "cluster_members": member(mine, "channel", "channel_id", F.lit(None).cast("double")).unionByName(member(best, "video", "video_id", F.col("relevance"))),
        "videos": best.select("video_id", "channel_id", "published", F.lit(at).cast("date").alias("first_seen"), *stamp),
    }


def load(spark: SparkSession, path: str, tables: dict[str, DataFrame], live: str | None = None) -> int:
    """Merges a load into the store under path as its next version: snapshots by first write, the rest by upsert. A second
    load of the same tables changes no row. The live location is refused."""
    versions.refuse_live(path, live)
    onto = versions.newest(spark, path)
    stored = versions.read(spark, path, onto) if onto else {}
    merged = {}
    for name, new in tables.items():
        key = KEYS[name]
        if name not in stored:
            merged[name] = first_writes(new, key, sorted(set(new.columns) - set(key))) if name in FIRST_WRITE_WINS else new
        elif name in FIRST_WRITE_WINS:
            merged[name] = stored[name].unionByName(insert_ignore(stored[name], new, key, sorted(set(new.columns) - set(key))))
        else:
            merged[name] = upsert(stored[name], new, key)
    return versions.commit(spark, path, merged, onto)


def report(tables: dict[str, DataFrame], selected: DataFrame) -> DataFrame:
    """(what, rows): rows of every table and selected channels without a row of their own."""
    counts = [df.agg(F.lit(name).alias("what"), F.count("*").alias("rows")) for name, df in sorted(tables.items())]
    bare = selected.join(tables["channels"], "channel_id", "left_anti").agg(F.lit("channels_without_metadata").alias("what"), F.count("*").alias("rows"))
    out = bare
    for part in counts:
        out = out.unionByName(part)
    return out
