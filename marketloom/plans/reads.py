"""Registered queries of watch lists, replays, verdicts, reads, monitoring and prototype analytics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import metrics, reads
from ..operators.world import KEY
from ..sources import star
from .market import _PANEL, BASE, DAYS, ORACLES, PRE, panel, query, world

# watch lists and clusters


@query("POP_04", f"""with {BASE} n as (select cluster_id, count(*) filter (relevance >= 0.55) as n from channel left join video using (channel_id) group by 1)
select cluster_id, n > 0 as active, case when n = 0 then date '2000-06-30' end as retired_on from n""")  # fmt: skip
def retired(spark, sf_dir):
    return reads.retired(star.channels(spark, sf_dir), star.videos(spark, sf_dir), DAYS[1])


@query("POP_21", f"""with {BASE} r as (select distinct video_id from snap where observed_date = date '1997-06-30'), s as (select channel_id from channel where subs between 1 and 10000)
select video_id, published from video v where not is_short and date '1997-06-30' - published between 14 and 17 and channel_id in (select channel_id from s)
  and not exists (select 1 from r where r.video_id = v.video_id) order by published, video_id limit 100""")  # fmt: skip
def watchlist(spark, sf_dir):
    """The next hundred videos to read; the cap is the feature."""
    return reads.watchlist(star.videos(spark, sf_dir), star.channels(spark, sf_dir), star.video_snapshots(spark, sf_dir), DAYS[0], 14, 17, 10_000, 100)


@query("MTR_04", f"""with {BASE} p as (select v.video_id, exists (select 1 from snap s where s.video_id = v.video_id and s.observed_date >= date '1997-06-30') as held from video v
  where not is_short and date '1997-06-30' - published between 0 and 90 and channel_id in (select channel_id from channel where subs between 1 and 10000))
select count(*) as population, count(*) filter (held) as held, round(count(*) filter (held) / nullif(count(*), 0)::double, 6) as share,
  count(*) >= 50 and count(*) filter (held) < 0.9 * count(*) as warn from p""")  # fmt: skip
def coverage(spark, sf_dir):
    day = F.lit(DAYS[0]).cast("date")
    due = reads.due(star.videos(spark, sf_dir), star.channels(spark, sf_dir), DAYS[0], 0, 90, 10_000)
    held = star.video_snapshots(spark, sf_dir).filter(F.col("observed_date") >= day).select("video_id", F.lit(True).alias("held")).distinct()
    return reads.coverage(due.join(held, "video_id", "left"), 50, 0.9)


# backtest


@query("BTE_01", """with c as (select o_custkey as channel_id, o_orderpriority as slug, count(*) as n from orders where o_orderkey % 10 between 6 and 8 group by all having count(*) >= 2),
k as (select *, row_number() over (partition by channel_id order by n desc, slug) as k, count(*) over (partition by channel_id) as rivals from c)
select slug, count(*) as channels, count(*) filter (rivals > 1) as contested, count(*) >= 15 as kept from k where k = 1 group by slug""")  # fmt: skip
def selected(spark, sf_dir):
    hits = star.read(spark, sf_dir, "orders").filter("o_orderkey % 10 between 6 and 8").select(F.col("o_custkey").alias("channel_id"), F.col("o_orderpriority").alias("slug"))
    return reads.selected(hits, 2, 15)


@query("BTE_03", f"with {BASE} x as (select 1) select unnest(generate_series(min(published)::timestamp, max(published)::timestamp, interval 7 day))::date as day from video")
def decision_dates(spark, sf_dir):
    ends = star.videos(spark, sf_dir).agg(F.min("published").alias("a"), F.max("published").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("day"))


@query("BTE_06", f"{_PANEL} q as (select date, unit, x as score, y as outcome, count(*) over (partition by date) as n from p where x is not null and y > 0) select * from q where n >= 3")
def paired(spark, sf_dir):
    p = panel(spark, sf_dir).select("date", "unit", F.col("x").alias("score"), F.when(F.col("y") > 0, F.col("y")).alias("outcome"))
    return reads.paired(p, 3)


# cohorts and agreement


@query("PRO_08", f"""{PRE} r as (select cluster_id, day, channel_id, (list_sort(list(views)))[count(*) // 2 + 1] / any_value(subs)::double as per_sub, count(*) as videos from elig where subs > 0 group by all)
select * exclude (per_sub), round(per_sub, 6) as per_sub from (select *, row_number() over (partition by cluster_id, day order by per_sub desc, channel_id) as place from r) where place <= 20""")  # fmt: skip
def ranked_channels(spark, sf_dir):
    return reads.ranked_channels(world(spark, sf_dir).eligible, world(spark, sf_dir).members, 20)


@query("CAL_02", """with p as (select quality = 1 as a, toxic = 0 as b from labels),
s as (select count(*) as n, avg((a = b)::int) as agree, avg(a::int) as pa, avg(b::int) as pb, count(*) filter (a <> b) as disagreements from p)
select n, disagreements, round(agree, 6) as agreement, round((agree - pa * pb - (1 - pa) * (1 - pb)) / nullif(1 - pa * pb - (1 - pa) * (1 - pb), 0), 6) as kappa from s""")  # fmt: skip
def agreement(spark, sf_dir):
    return reads.agreement(star.read(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("a"), (F.col("toxic") == 0).alias("b")))


# reads


@query("QRY_02", f"with {BASE} n as (select observed_date, value from series where term = '1-URGENT' order by observed_date desc limit 400) select * from n")
def newest_demand(spark, sf_dir):
    own = star.demand_snapshots(spark, sf_dir).filter("term = '1-URGENT'").select("observed_date", "value")
    return own.orderBy(F.desc("observed_date")).limit(400).orderBy("observed_date")


@query("QRY_06", f"with {BASE} x as (select 1) select video_id, min(observed_date) as first, max(observed_date) as latest, count(distinct observed_date) as days from snap group by 1")
def spans(spark, sf_dir):
    return star.video_snapshots(spark, sf_dir).groupBy("video_id").agg(F.min("observed_date").alias("first"), F.max("observed_date").alias("latest"), F.countDistinct("observed_date").alias("days"))


@query("QRY_08", "select left(sha256(coalesce(text, '')), 12) as prefix, count(*) as n, min(doc_id) as doc_id from documents group by 1")
def by_prefix(spark, sf_dir):
    return star.read(spark, sf_dir, "documents").groupBy(F.left(F.sha2(F.coalesce("text", F.lit("")), 256), F.lit(12)).alias("prefix")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))


_GATED = f"""select cluster_id, day, name, case when name in ('median_views', 'on_niche_share') and cluster_id in ('BUILDING', 'MACHINERY') then null else value end as value,
  case when name in ('median_views', 'on_niche_share') and cluster_id in ('BUILDING', 'MACHINERY') then 'axis not validated' end as reason from (({ORACLES['SUP_02']}) union all ({ORACLES['SUP_05']}))"""


@query("QRY_09", _GATED)
def gated(spark, sf_dir):
    w = world(spark, sf_dir)
    policy = spark.createDataFrame([(n, c) for n in ("median_views", "on_niche_share") for c in ("BUILDING", "MACHINERY")], "name string, cluster_id string")
    return reads.gated(metrics.median_views(w).unionByName(metrics.format_mix(w)).select(*KEY, "name", "value"), policy)


_KEYWORDS = ORACLES["POP_19"].split(" kw as (", 1)[1].rsplit("select day, keyword", 1)[0].rstrip()


@query("QRY_07", f"""{PRE} kw as ({_KEYWORDS}, i as (
  select 'median_views' as metric, cluster_id, day, video_id::varchar as input_id, views::double as value from en union all
  select 'on_niche_share', cluster_id, day, video_id::varchar, relevance::double from nv union all
  select 'geo_concentration', cluster_id, day, channel_id::varchar, subs::double from mc union all
  select 'top10_concentration', cluster_id, day, video_id::varchar, views::double from top union all
  select 'total_monthly_searches', geo, day, keyword, volume::double from r where k = 1 union all
  select 'weekly_views', term, day, observed_date::varchar, value from series, days where observed_date <= day - 2 and observed_date > day - 30),
p as (select *, row_number() over (partition by metric, cluster_id, day order by value desc nulls last, input_id) as place from i) select * from p where place <= 200""")  # fmt: skip
def drilldown(spark, sf_dir):
    w = world(spark, sf_dir)
    of = lambda df, key, value: df.select(*KEY, F.col(key).alias("input_id"), F.col(value).alias("value"))
    keywords = metrics.latest_keywords(star.keyword_metrics(spark, sf_dir), w.spine.select("day").distinct()).withColumnRenamed("geo", "cluster_id")
    points = star.demand_snapshots(spark, sf_dir).withColumnRenamed("term", "cluster_id").join(w.days, F.datediff("day", "observed_date").between(2, 29))
    return reads.drilldown({
        "median_views": of(w.eligible_niche, "video_id", "views"), "on_niche_share": of(w.niche_videos, "video_id", "relevance"), "geo_concentration": of(w.member_channels, "channel_id", "subs"),
        "top10_concentration": of(w.top, "video_id", "views"), "total_monthly_searches": of(keywords, "keyword", "volume"), "weekly_views": of(points, "observed_date", "value"),
    })


# monitoring


@query("MTR_01", """select ts::date as day, user_id as source, case when bool_or(event_type = 'error') then 'failed' else 'ok' end as worst, count(*) as runs from events group by all""")
def run_health(spark, sf_dir):
    runs = star.read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("user_id").alias("source"), F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"))
    return reads.worst_status(runs, ["day", "source"])


@query("MTR_03", "select ts::date as day, count(distinct user_id) as sources, count(*) - count(distinct user_id) as extra from events group by 1 having count(*) > count(distinct user_id)")
def one_run_a_day(spark, sf_dir):
    out = star.read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("sources"), F.count("*").alias("n"))
    return out.filter("n > sources").select("day", "sources", (F.col("n") - F.col("sources")).alias("extra"))


@query("MTR_06", """with r as (select event_type as phase, "ts", lead("ts") over (partition by event_type order by "ts", event_id) as e from events)
select phase, count(*) as runs, count(*) filter (date_diff('microsecond', "ts", e) > 900000000) as over_budget from r where e is not null group by 1""")  # fmt: skip
def over_budget(spark, sf_dir):
    """A phase lasts until the next one of its kind begins; five kinds are ordered hour by hour."""
    runs = star.read(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    rows = reads.followed(runs, ["event_type"], "ts", "event_id", F.date_trunc("hour", "ts")).filter("next is not null")
    slow = F.col("next").cast("timestamp_ntz") > F.col("ts").cast("timestamp_ntz") + F.expr("interval 900 seconds")
    return rows.groupBy(F.col("event_type").alias("phase")).agg(F.count("*").alias("runs"), F.count_if(slow).alias("over_budget"))


@query("MTR_06_quota", """with u as (select event_type as source, timezone('America/Los_Angeles', "ts" at time zone 'UTC')::date as day, round(sum(value), 4) as units from events group by all)
select source, day, units, round(units / sum(units) over (partition by day), 6) as share from u""")  # fmt: skip
def quota(spark, sf_dir):
    """Units used by each source on a day of the quota, which ends at midnight Pacific time, and its share of that day's."""
    local = F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "America/Los_Angeles"))
    used = star.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source"), local.alias("day")).agg(F.round(F.sum("value"), 4).alias("units"))
    return used.withColumn("share", F.round(F.col("units") / F.sum("units").over(Window.partitionBy("day")), 6))


@query("MTR_06_staleness", f"""{PRE} kw as (select ({star.CURATED})[(p_partkey % {len(star.CURATED)})::int + 1] as cluster_id, (date '1997-01-31' + to_months((p_partkey % 12)::int))::date as observed_date from part)
select cluster_id, day, max(observed_date) as newest, day - max(observed_date) as age, day - max(observed_date) > 70 as stale from kw, days where observed_date <= day group by cluster_id, day""")  # fmt: skip
def stale_keywords(spark, sf_dir):
    dates = star.keyword_metrics(spark, sf_dir, clusters=True).select("cluster_id", "observed_date").distinct()
    spans = dates.withColumn("until", F.lead("observed_date").over(Window.partitionBy("cluster_id").orderBy("observed_date")))
    newest = world(spark, sf_dir).calendar.on(spans, "observed_date", "until")
    age = F.datediff("day", "observed_date")
    return newest.select("cluster_id", "day", F.col("observed_date").alias("newest"), age.alias("age"), (age > 70).alias("stale"))


@query("MTR_09", f"""with {BASE} x as (select 1) select cluster_id, count(*) filter (date '2000-06-30' - published > 365) >= 0.2 * count(*) as old_enough,
  count(is_short) >= 0.8 * count(*) as known_format from video join channel using (channel_id) where relevance >= 0.55 and published <= date '2000-06-30' group by 1""")  # fmt: skip
def triggers(spark, sf_dir):
    day = F.lit(DAYS[1]).cast("date")
    own = star.videos(spark, sf_dir).filter((F.col("relevance") >= 0.55) & (F.col("published") <= day)).join(star.channels(spark, sf_dir).select("channel_id", "cluster_id"), "channel_id")
    share = lambda c: F.avg(c.cast("double"))
    return own.groupBy("cluster_id").agg((share(F.datediff(day, "published") > 365) >= 0.2).alias("old_enough"), (share(F.col("is_short").isNotNull()) >= 0.8).alias("known_format"))


# prototype analytics


@query("LEG_04", f"""with {BASE} a as (select year(observed_date) as batch, avg(value) filter (value <> 0) as mean from series where term = '1-URGENT' group by 1)
select term, observed_date, round(value * 100 / mean, 6) as value from series join a on a.batch = year(observed_date) where mean is not null""")  # fmt: skip
def anchored(spark, sf_dir):
    return reads.anchored(star.demand_snapshots(spark, sf_dir).withColumn("batch", F.year("observed_date")), "1-URGENT").select("term", "observed_date", F.round("value", 6).alias("value"))


@query("LEG_11", """select conv_id, "turn", strlen(text)::bigint as score from conversations where role = 'user' and text ilike 'th%' and strlen(text) >= 3""")
def questions(spark, sf_dir):
    own = star.read(spark, sf_dir, "conversations").filter("role = 'user' and lower(text) like 'th%'")
    return own.select("conv_id", "turn", F.octet_length("text").cast("long").alias("score")).filter("score >= 3")


@query("LEG_12", """with q as (select conv_id, count(*) filter (role = 'user') as asked, count(*) filter (role = 'assistant') as answers from conversations group by 1)
select count(*) as threads, count(*) filter (answers > 0) as answered, round(avg((answers = 0)::int), 6) as unanswered_rate from q where asked > 0""")  # fmt: skip
def supply_signals(spark, sf_dir):
    return reads.answered(star.read(spark, sf_dir, "conversations"))


@query("LEG_14", f"""with {BASE} s as (select cluster_id, case when o_orderkey % 3 <> 0 then o_orderstatus = 'F' end as sponsored from orders join channel on channel_id = o_custkey)
select cluster_id, round(avg(sponsored::int), 6) as rate, count(sponsored) as n from s group by 1""")  # fmt: skip
def sponsor_rate(spark, sf_dir):
    """The signal is unknown for orders whose key three divides: they are read, and a rate leaves them out as NULL."""
    signal = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus") == "F").alias("sponsored")
    own = star.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("channel_id"), signal)
    joined = own.join(star.channels(spark, sf_dir).select("channel_id", "cluster_id"), "channel_id")
    return joined.groupBy("cluster_id").agg(F.round(F.avg(F.col("sponsored").cast("int")), 6).alias("rate"), F.count("sponsored").alias("n"))
