"""Registered queries of backtest loads: dumps are written, read, selected from and committed as one version of a store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backtest
from ..sources import dumps, star, versions
from ..streaming.jobs import folder
from .market import BASE, CHANNEL_SNAP, query

NICHES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LOADED, CRAWLED = "1999-01-01", "1998-12-31"
VIDEOS, CHANNELS = 2, 15


def _hits(spark, sf_dir):
    """Orders of high relevance are hits of their own priority and, a little lower, of the next one."""
    own = star.read(spark, sf_dir, "orders").filter("o_orderkey % 10 between 6 and 8").withColumn("r", (F.col("o_orderkey") % 10) / 10)
    following = F.element_at(F.array(*map(F.lit, NICHES)), F.substring("o_orderpriority", 1, 1).cast("int") % len(NICHES) + 1)
    both = F.array(F.struct(F.col("o_orderpriority").alias("slug"), F.col("r").alias("relevance")), F.struct(following.alias("slug"), F.round(F.col("r") - 0.05, 2).alias("relevance")))
    return own.select(F.col("o_orderkey").alias("video_id"), F.col("o_custkey").alias("channel_id"), F.inline(both), F.to_date("o_orderdate").alias("published"))


def _population(spark, sf_dir):
    hits = dumps.hits(spark, dumps.written(_hits(spark, sf_dir), "json"))
    selected = backtest.owners(hits, VIDEOS, CHANNELS)
    known = star.channels(spark, sf_dir).filter("coalesce(country, '') <> 'CHINA'")  # the dump lacks some channels
    channels = dumps.channels(spark, dumps.written(known.select("channel_id", F.col("cluster_id").alias("category"), F.col("first_seen").alias("join_date")), "csv"))
    snap = star.channel_snapshots(spark, sf_dir).select("channel_id", F.col("observed_date").alias("week"), F.concat("video_count", F.lit(".4")).alias("videos"), F.concat("subs", F.lit(".0")).alias("subs"))
    weekly = dumps.weekly(spark, dumps.written(snap, "csv"), selected)
    orders = star.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("slug")).distinct()
    terms = star.read(spark, sf_dir, "part").select(F.col("p_type").alias("term"), F.element_at(F.array(*map(F.lit, NICHES)), (F.col("p_size") % len(NICHES) + 1).cast("int")).alias("slug"))
    catalogue = orders.select("slug", F.lower("slug").alias("label"))
    return selected, backtest.population(selected, hits, channels.withColumnRenamed("category", "title"), weekly, catalogue, terms, LOADED, CRAWLED)


def loaded(spark, sf_dir):
    selected, tables = _population(spark, sf_dir)
    path = f"{folder(spark)}/backtest"
    backtest.load(spark, path, tables, live=sf_dir)
    return selected, versions.read(spark, path)


_LOAD = f"""with {BASE} {CHANNEL_SNAP}
own as (select o_orderkey as video_id, o_custkey as channel_id, o_orderdate::date as published, o_orderpriority as slug, (o_orderkey % 10) / 10.0::double as r from orders where o_orderkey % 10 between 6 and 8),
hit as (select * from own union all select video_id, channel_id, published, ({NICHES})[left(slug, 1)::int % 5 + 1], round(r - 0.05, 2) from own),
c as (select channel_id, slug, count(*) as n from hit group by all having count(*) >= {VIDEOS}),
k as (select *, row_number() over (partition by channel_id order by n desc, slug) as k from c),
sel as (select channel_id, slug from k where k = 1 and slug in (select slug from k where k = 1 group by slug having count(*) >= {CHANNELS})),
wk as (select channel_id, observed_date, subs, video_count from csnap where channel_id in (select channel_id from sel)),
ch as (select s.channel_id, s.slug, coalesce((select min(observed_date) from wk where wk.channel_id = s.channel_id), date '{CRAWLED}') as first_seen
  from sel s join channel using (channel_id) where coalesce(country, '') <> 'CHINA'),
vd as (select h.video_id, h.channel_id, h.slug, max(h.r) as r, any_value(published) as published from hit h join sel using (channel_id, slug) group by all)"""


@query("BTE_02", f"""{_LOAD} select s.slug as cluster_id, 'channel' as item_type, s.channel_id::varchar as item_id, null::double as relevance, ch.first_seen as day from sel s left join ch using (channel_id)
union all select slug, 'video', video_id::varchar, r, published from vd""")  # fmt: skip
def load_members(spark, sf_dir):
    """The members of a load: channels with the day they were first seen, videos with that of their publication."""
    _, tables = loaded(spark, sf_dir)
    days = tables["channels"].select(F.lit("channel").alias("item_type"), F.col("channel_id").cast("string").alias("item_id"), F.col("first_seen").alias("day"))
    days = days.unionByName(tables["videos"].select(F.lit("video").alias("item_type"), F.col("video_id").cast("string").alias("item_id"), F.col("published").alias("day")))
    return tables["cluster_members"].join(days, ["item_type", "item_id"], "left").select("cluster_id", "item_type", "item_id", "relevance", "day")


@query("BTE_02_report", f"""{_LOAD} select 'channel_snapshots' as what, count(*) as rows from wk union all select 'channels', count(*) from ch
union all select 'channels_without_metadata', (select count(*) from sel) - (select count(*) from ch) union all select 'cluster_members', (select count(*) from sel) + (select count(*) from vd)
union all select 'clusters', count(distinct slug) from sel union all select 'niche_seeds', count(distinct o_orderpriority) from orders
union all select 'seed_terms', count(*) from (select distinct p_type, p_size % 5 from part) union all select 'videos', count(*) from vd""")  # fmt: skip
def load_report(spark, sf_dir):
    selected, tables = loaded(spark, sf_dir)
    return backtest.report(tables, selected)
