"""Registered queries of the market operators over the star schema, with DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics, scoring, stats
from ..operators.world import KEY, NOTHING, TOO_LITTLE, World, group_of, running_max, spine
from ..sources import star

DAYS = ["1997-06-30", "2000-06-30"]
REPLAY = [f"{y}-{m:02d}-28" for y in (1996, 1997, 1998) for m in range(1, 13)]
QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_DAYS = ", ".join(f"(date '{d}')" for d in DAYS)
BASE = """
channel as (select c_custkey as channel_id, c_mktsegment as cluster_id, n_name as country,
  case when c_acctbal > 0 then floor(c_acctbal)::bigint + 1 end as subs, make_date(1995 + (c_custkey % 4)::int, 1, 1) as first_seen
  from customer left join nation on n_nationkey = c_nationkey),
video as (select o_orderkey as video_id, o_custkey as channel_id, o_orderdate::date as published,
  case when o_orderpriority not like '5%' then o_orderpriority like '1%' end as is_short,
  case when o_orderpriority not like '5%' then floor(o_totalprice)::bigint % 1200 >= 480 end as midroll,
  case when o_orderkey % 10 <> 9 then (o_orderkey % 10)::double / 10 end as relevance, o_orderstatus <> 'O' as by_date from orders),
snap as (select l_orderkey as video_id, l_shipdate::date as observed_date, case when l_linenumber <> 7 then floor(l_extendedprice)::bigint end as views from lineitem),
series as (select o_orderpriority as term, o_orderdate::date as observed_date, count(*)::double as value from orders group by all),
"""
PRE = (
    "with "
    + BASE
    + f"""
days as (select col0 as day from (values {_DAYS}) t(col0)),
spine as (select distinct cluster_id, day from channel, days),
members as (select c.*, s.day from channel c join spine s using (cluster_id) where c.first_seen <= s.day),
mv as (select v.*, m.cluster_id, m.day, m.subs from video v join members m using (channel_id) where v.published <= m.day),
ballast as (select cluster_id, day, channel_id from mv group by all
  having count(*) filter (relevance >= 0.55) = 0 and count(*) filter (relevance >= 0.55 or relevance <= 0) >= 3),
mc as (select * from members m where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id)),
nv as (select * from mv where relevance >= 0.55),
cov as (select cluster_id, day, count(*) filter (relevance >= 0.55) as on_niche, count(*) filter (not coalesce(relevance <= 0, false)) as judgeable,
  count(*) filter (relevance >= 0.55 or relevance <= 0) as decided, count(*) as total from mv m
  where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id) group by all),
va as materialized (select video_id, day, max(views) as views from snap join days on observed_date <= day where views is not null group by all),
elig as (select * from (select mv.*, va.views, row_number() over (partition by cluster_id, mv.day, channel_id order by published desc, mv.video_id) as nth
  from mv join va on va.video_id = mv.video_id and va.day = mv.day where not is_short and published <= mv.day - interval 14 day) where nth <= 15),
en as (select * from elig where relevance >= 0.55),
cohort as (select cluster_id, day, channel_id, subs, count(*) as videos, median(views) as median_views, max(views) as max_views from elig e
  where subs > 0 and subs <= 10000 and exists (select 1 from mv where mv.by_date and mv.channel_id = e.channel_id and mv.cluster_id = e.cluster_id and mv.day = e.day)
  group by all having count(*) >= 3),
top as (select * from (select nv.*, va.views, row_number() over (partition by cluster_id, nv.day order by va.views desc, nv.video_id) as place
  from nv join va on va.video_id = nv.video_id and va.day = nv.day) where place <= 100),
"""
)


def world(spark: SparkSession, sf_dir: str, days: list[str] | None = None, definition: str = "ballast") -> World:
    """The given tables hold few videos a channel, so ballast and cohort need three here."""
    channel = star.channels(spark, sf_dir)
    videos, snapshots = star.videos(spark, sf_dir), star.video_snapshots(spark, sf_dir)
    return World(spine(channel, days or DAYS), channel, videos, snapshots, ballast_decided=3, cohort_videos=3, definition=definition)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _known(group: str, name: str, found: str) -> str:
    return f"""{group} as metric_group, {name} as name, round(value, 6) as value,
  case when value is null then 0.0::double else round(coalesce(confidence, 0), 6) end as confidence,
  case when value is null then 0 else coalesce(inputs_n, 0) end::bigint as inputs_n,
  case when value is null then case when {found} is null then '{NOTHING}' else '{TOO_LITTLE}' end end as reason"""


def _rows(name: str) -> str:
    """A metric's rows from m (cluster_id, day, value, confidence, inputs_n)."""
    known = _known(f"'{group_of(name)}'", f"'{name}'", "m.day")
    return f"""select s.cluster_id, s.day, {known} from spine s left join m on m.cluster_id = s.cluster_id and m.day = s.day"""


def _supply(name: str, body: str) -> str:
    return f"""{PRE} b as ({body}), u as (select cluster_id, day, count(*) as universe from mc group by all),
m as (select b.cluster_id, b.day, b.value, b.inputs_n, least(b.inputs_n / 30.0, 1) * coalesce(least(contributing / universe::double, 1), 0)
  * case when coalesce(total, 0) = 0 then 0.0 when judgeable = 0 then 1.0 else on_niche / judgeable::double end as confidence
  from b left join u using (cluster_id, day) left join cov using (cluster_id, day)) {_rows(name)}"""


def _plain(name: str, body: str) -> str:
    return f"{PRE} m as ({body}) {_rows(name)}"


# populations


def _population(name: str, frame, body: str) -> None:
    query(name, f"{PRE} x as (select 1) {body}")(lambda spark, sf_dir: frame(world(spark, sf_dir)))


_population("POP_05", lambda w: w.members.select(*KEY, "channel_id"), "select cluster_id, day, channel_id from members")
_population("POP_06", lambda w: w.ballast, "select * from ballast")
_population("POP_08", lambda w: w.member_channels.select(*KEY, "channel_id"), "select cluster_id, day, channel_id from mc")
_population("POP_09", lambda w: w.niche_videos.select(*KEY, "video_id", "channel_id"), "select cluster_id, day, video_id, channel_id from nv")
_population("POP_10", lambda w: w.coverage.select(*KEY, "decided", "total"), "select cluster_id, day, decided, total from cov")
_population("POP_11", lambda w: w.coverage.select(*KEY, "on_niche", "judgeable", "total"), "select cluster_id, day, on_niche, judgeable, total from cov")
_population("POP_12", lambda w: w.views, "select * from va")
_population("POP_13", lambda w: w.eligible.select(*KEY, "video_id", "views"), "select cluster_id, day, video_id, views from elig")
_population("POP_14", lambda w: w.eligible_niche.select(*KEY, "video_id", "views"), "select cluster_id, day, video_id, views from en")
_population("POP_16", lambda w: w.date_discovered, "select distinct cluster_id, day, channel_id from mv where by_date")
_population("POP_17", lambda w: w.cohort.drop("median_age"), "select cluster_id, day, channel_id, subs, videos, median_views, max_views from cohort")
_population("POP_20", lambda w: w.top.select(*KEY, "video_id", "views", "place"), "select cluster_id, day, video_id, views, place from top")

CHANNEL_SNAP = """msnap as (select channel_id, last_day(published) as observed_date, count(*) as n from video group by all),
csnap as (select channel_id, observed_date, sum(n) over (partition by channel_id order by observed_date)::bigint as video_count,
  subs + sum(n) over (partition by channel_id order by observed_date)::bigint as subs from msnap join channel using (channel_id)),"""


@query("POP_15", f"{PRE} {CHANNEL_SNAP} x as (select 1) select channel_id, day, max(subs) as subs from csnap, days where observed_date <= day and subs is not null group by all")
def latest_subs(spark, sf_dir):
    spans = running_max(star.channel_snapshots(spark, sf_dir), "channel_id", "subs")
    return world(spark, sf_dir).calendar.on(spans, "valid_from", "valid_to").select("channel_id", "day", "subs")


@query("POP_01", """with v as (select o_custkey as channel_id, o_orderkey as video_id, o_orderpriority as seed, o_orderstatus <> 'O' as by_date from orders),
g as (select channel_id, seed, count(distinct case when by_date then video_id end) as dated, count(distinct video_id) as n from v group by all),
r as (select *, row_number() over (partition by channel_id order by dated desc, n desc, seed) as k, sum(n) over (partition by channel_id) as t from g)
select channel_id, seed, dated, n, round(n / t::double, 6) as confidence from r where k = 1""")  # fmt: skip
def dominant_seed(spark, sf_dir):
    from ..operators.members import dominant_seeds

    found = star.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("channel_id"), F.col("o_orderkey").alias("video_id"), F.col("o_orderpriority").alias("seed"), (F.col("o_orderstatus") != "O").alias("by_date")
    )
    return dominant_seeds(found)


@query("POP_19", f"""{PRE} kw as (select p_name as keyword, right(p_brand, 1) as geo, (date '1997-01-31' + to_months((p_partkey % 12)::int))::date as observed_date,
  pow(10.0, p_size % 5) as volume, case when p_size % 7 <> 0 then p_size end as competition,
  case when p_partkey % 5 <> 0 then round(p_retailprice / 100, 2) end as bid_low, case when p_partkey % 3 <> 0 then round(p_retailprice / 10, 2) end as bid_high from part),
r as (select *, row_number() over (partition by day, keyword, geo order by observed_date desc, volume desc, bid_high desc nulls last, bid_low desc nulls last, competition desc nulls last) as k
  from kw, days where observed_date <= day)
select day, keyword, geo, observed_date, volume, competition, bid_low, bid_high from r where k = 1""")  # fmt: skip
def latest_keywords(spark, sf_dir):
    days = world(spark, sf_dir).spine.select("day").distinct()
    return metrics.latest_keywords(star.keyword_metrics(spark, sf_dir), days).select("day", "keyword", "geo", "observed_date", "volume", "competition", "bid_low", "bid_high")


ORACLES["MON_02_05"] = ORACLES["POP_19"].replace(
    "select day, keyword, geo, observed_date, volume, competition, bid_low, bid_high from r where k = 1",
    """, l as (select *, case when bid_low is not null and bid_high is not null then (bid_low + bid_high) / 2 else coalesce(bid_low, bid_high) end as mid from r where k = 1)
select day, geo, round(sum(volume), 6) as volume, round(avg((mid is not null)::int), 6) as priced_share, round(avg(competition), 6) as competition,
  round(sum(case when mid is not null then volume * mid end) / nullif(sum(case when mid is not null then volume end), 0), 6) as vw_cpc,
  round(median(bid_high), 6) as median_bid_high, count(*) as n,
  round(least(count(*) / 64.0, 1) * least(count(*) / 30.0, 1) * (30.0 / greatest(min(day - observed_date), 30)), 6) as confidence from l group by all""",
)


@query("MON_02_05")
def keyword_money(spark, sf_dir):
    days = world(spark, sf_dir).spine.select("day").distinct()
    return metrics.keyword_money(metrics.latest_keywords(star.keyword_metrics(spark, sf_dir), days), 64)


# supply, openness, money


def _metric(name: str, f, sql: str) -> None:
    query(name, sql)(lambda spark, sf_dir: f(world(spark, sf_dir)))


_COUNTS = "count(*) as inputs_n, count(distinct channel_id) as contributing"
_metric("SUP_01", metrics.uploads_per_week, _supply("uploads_per_week", """select cluster_id, day, sum(rate) as value, sum(n)::bigint as inputs_n, count(*) filter (n > 0) as contributing from (
  select mc.cluster_id, mc.day, mc.channel_id, coalesce(n, 0) as n, coalesce(n / ((date_diff('day', greatest(mc.day - 27, oldest), mc.day) + 1) / 7.0), 0) as rate from mc left join (
    select cluster_id, day, channel_id, count(*) filter (relevance >= 0.55 and not is_short and published >= day - 27) as n, min(published) as oldest from mv group by all) p
  on p.cluster_id = mc.cluster_id and p.day = mc.day and p.channel_id = mc.channel_id) group by all"""))  # fmt: skip
_metric("SUP_02", metrics.median_views, _supply("median_views", f"select cluster_id, day, median(views) as value, {_COUNTS} from en group by all"))
_metric("SUP_03", metrics.trimmed_mean_views, _supply("trimmed_mean_views", """select cluster_id, day, avg(views) filter (k > c and k <= n - c) as value, count(*) as inputs_n, count(distinct channel_id) as contributing
  from (select *, case when n >= 10 then n // 10 else 0 end as c from (select *, row_number() over (partition by cluster_id, day order by views, video_id) as k, count(*) over (partition by cluster_id, day) as n from en)) group by all"""))  # fmt: skip
_metric("SUP_04", metrics.on_niche_share, _plain("on_niche_share", "select cluster_id, day, on_niche / nullif(decided, 0)::double as value, decided / nullif(total, 0)::double as confidence, decided as inputs_n from cov"))
_metric("SUP_05", metrics.format_mix, _supply("format_mix", "select cluster_id, day, count(*) filter (is_short) / nullif(count(is_short), 0)::double as value, count(is_short) as inputs_n, count(distinct channel_id) as contributing from nv where published >= day - 27 group by all"))
_metric("SUP_06", lambda w: metrics.geo_concentration(w, "CHINA"), _plain("geo_concentration", "select cluster_id, day, count(*) filter (country = 'CHINA') / nullif(count(country), 0)::double as value, count(country) / count(*)::double as confidence, count(country) as inputs_n from mc group by all"))
_metric("SUP_07", metrics.top10_concentration, _supply("top10_concentration", f"select cluster_id, day, case when count(*) >= 20 then sum(views) filter (place <= 10) / nullif(sum(views), 0)::double end as value, {_COUNTS} from top group by all"))
_metric("SUP_08", metrics.median_top_video_age, _supply("median_top_video_age", f"select cluster_id, day, median(date_diff('day', published, day) / 365.25::double) as value, {_COUNTS} from top group by all"))
_metric("OPN_01", metrics.breakthrough_rate, _plain("breakthrough_rate_cohort", "select cluster_id, day, avg(((median_views <> 0 and max_views >= 5 * median_views) or max_views >= 10 * subs)::int) as value, count(*) as inputs_n, least(count(*) / 30.0, 1) as confidence from cohort group by all"))
_metric("OPN_02", metrics.views_per_sub, _plain("views_per_sub", "select cluster_id, day, median(median_views / subs) as value, count(*) as inputs_n, least(count(*) / 30.0, 1) as confidence from cohort group by all"))
_metric("OPN_03", metrics.winner_age_years, _plain("winner_age_years", "select t.cluster_id, day, median(date_diff('day', c.first_seen, day) / 365.25::double) as value, count(*) as inputs_n, count(distinct channel_id) / 100.0 as confidence from top t join channel c using (channel_id) group by all"))
_metric("MON_01", metrics.midroll_share, _plain("midroll_eligible_share", "select n.cluster_id, n.day, count(*) filter (midroll) / nullif(count(midroll), 0)::double as value, count(midroll) as inputs_n, least(count(midroll) / 100.0, 1) * coalesce(any_value(decided / nullif(total, 0)::double), 0) as confidence from nv n left join cov on cov.cluster_id = n.cluster_id and cov.day = n.day where published >= n.day - 89 group by 1, 2"))


@query("SUP_09", _supply("views_per_new_video", """select cluster_id, day, median(gained / made) as value, count(*) as inputs_n, count(*) as contributing from (
  select cluster_id, day, channel_id, max_by(subs, observed_date) - min_by(subs, observed_date) as gained, (max_by(video_count, observed_date) - min_by(video_count, observed_date))::double as made
  from (select mc.cluster_id, mc.day, mc.channel_id, c.observed_date, c.subs, c.video_count, row_number() over (partition by mc.cluster_id, mc.day, mc.channel_id order by c.observed_date desc) as k
    from mc join csnap c on c.channel_id = mc.channel_id and c.observed_date <= mc.day) where k <= 5 group by all) where made > 0 and gained >= 0 group by all""").replace(" b as (", f" {CHANNEL_SNAP} b as (", 1))  # fmt: skip
def views_per_new_video(spark, sf_dir):
    readings = star.channel_snapshots(spark, sf_dir).withColumnRenamed("subs", "reach")
    return metrics.views_per_new_video(world(spark, sf_dir), readings)


# demand: the terms of the series are the clusters


_DEMAND = "with " + BASE + f"days as (select col0 as day from (values {_DAYS}) t(col0)), spine as (select distinct term as cluster_id, day from series, days),"


def _series(spark, sf_dir):
    series = star.demand_snapshots(spark, sf_dir)
    return series, spine(series.select(F.col("term").alias("cluster_id")), DAYS)


def _window(name: str, back: int) -> str:
    return f"{name} as (select term as cluster_id, day, sum(value) as total, count(*) as points from series, days where observed_date <= day - {2 + back} and observed_date > day - {30 + back} group by all),"


_ADEQUATE = "least({p} / 28.0, 1) * least({t} / 10000.0, 1)"


@query("DEM_01", f"{_DEMAND} {_window('a', 0)} m as (select cluster_id, day, total / 4 as value, {_ADEQUATE.format(p='points', t='total')} as confidence, points as inputs_n from a) {_rows('weekly_views')}")
def weekly_views(spark, sf_dir):
    return metrics.weekly_views(*_series(spark, sf_dir))


def _change(key: str, name: str, back: int) -> None:
    sure = f"least({_ADEQUATE.format(p='a.points', t='a.total')}, {_ADEQUATE.format(p='b.points', t='b.total')})"
    sql = f"{_DEMAND} {_window('a', 0)} {_window('b', back)} m as (select a.cluster_id, a.day, a.total / nullif(b.total, 0) - 1 as value, {sure} as confidence, a.points + b.points as inputs_n from a join b using (cluster_id, day)) {_rows(name)}"
    query(key, sql)(lambda spark, sf_dir: metrics.change(*_series(spark, sf_dir), back, name))


_change("DEM_03", "momentum_28d", 28)
_change("DEM_04", "yoy", 365)


@query("DEM_05", f"""{_DEMAND} y as (select term, day, observed_date, value, (row_number() over (partition by term, day order by observed_date) - 1) // 7 as c from series, days
  where observed_date <= day - 2 and observed_date > day - 367),
w as (select term, day, c, sum(value) as total from y group by all having count(*) = 7),
v as (select term, day, ln(total / b) as move from (select *, lag(total) over (partition by term, day order by c) as b from w) where b > 0 and total > 0),
m as (select term as cluster_id, day, case when count(*) >= 8 then stddev_samp(move) end as value, least(count(*) / 51.0, 1) as confidence, count(*) as inputs_n from v group by all) {_rows('volatility_365d')}""")  # fmt: skip
def volatility(spark, sf_dir):
    return metrics.volatility(*_series(spark, sf_dir))


@query("DEM_06", f"""{_DEMAND} x as (select term, day, month(observed_date) as mo, avg(value) as mean, sum(value) as s, count(*) as c from series, days where observed_date <= day - 2 group by all),
m as (select term as cluster_id, day, case when count(*) = 12 then stddev_samp(mean) / nullif(sum(s) / sum(c), 0) end as value, least(sum(c) / 365.25 / 3, 1)::double as confidence, sum(c)::bigint as inputs_n from x group by all) {_rows('seasonality')}""")  # fmt: skip
def seasonality(spark, sf_dir):
    return metrics.seasonality(*_series(spark, sf_dir))


# scores


_RANK = "case when {v} is not null then case when count({v}) over (partition by day) = 1 then 0.5 else (rank() over (partition by day order by {v} nulls last) - 1 + (count({v}) over (partition by day, {v}) - 1) / 2.0) / (count({v}) over (partition by day) - 1) end end"


@query("SCO_01", f"select cluster_id, day, value, round({_RANK.format(v='value')}, 6) as percentile from ({ORACLES['SUP_02']})")
def percentile(spark, sf_dir):
    rows = metrics.median_views(world(spark, sf_dir))
    return rows.select(*KEY, "value", F.round(scoring.percentile_rank("value", ["day"]), 6).alias("percentile"))


_REPLAY = ", ".join(f"(date '{d}')" for d in REPLAY)
_BREAK = f"""with {BASE} days as (select col0 as day from (values {_REPLAY}) t(col0)), spine as (select distinct term as cluster_id, day from series, days),
i as (select cluster_id, day, value, (day - 2 - observed_date) as gap from series join spine on term = cluster_id where observed_date <= day - 2),
s as (select cluster_id, day, gap // 28 as w, sum(value) as s, count(*) as n from i where gap < 392 group by all),
a as (select cluster_id, day, sum(s) filter (w = 0) as recent, count(*) filter (w > 0 and n >= 14) as windows, avg(s) filter (w > 0 and n >= 14) as mean, stddev_samp(s) filter (w > 0 and n >= 14) as sd from s group by all),
z as (select cluster_id, day, recent, windows, case when windows >= 8 then (recent - mean) / nullif(sd, 0) end as z from a)
select cluster_id, day, recent, windows, round(z, 6) as z, coalesce(z >= 0.5, false) as fires from z"""


def _breakouts(spark, sf_dir):
    series = star.demand_snapshots(spark, sf_dir)
    return scoring.breakouts(series, spine(series.select(F.col("term").alias("cluster_id")), REPLAY), z=0.5, share=0.5)


@query("RUL_01", _BREAK)
def demand_breakouts(spark, sf_dir):
    return _breakouts(spark, sf_dir)


@query("RUL_01_cooled", f"""with recursive f as (select cluster_id, day from ({_BREAK}) where fires),
c as (select cluster_id, min(day) as day from f group by 1 union all select cluster_id, (select min(day) from f where f.cluster_id = c.cluster_id and f.day >= c.day + 90) from c where day is not null)
select cluster_id, day from c where day is not null""")  # fmt: skip
def cooled_breakouts(spark, sf_dir):
    return scoring.cooled(_breakouts(spark, sf_dir).filter("fires"), 90)


_PANEL = f"""with {BASE} days as (select col0 as day from (values {_REPLAY}) t(col0)),
p as (select day as date, n_name as unit, n_regionkey as block, count(*) filter (o_orderdate::date > day - 90 and o_orderdate::date <= day)::double as x,
  count(*) filter (o_orderdate::date > day and o_orderdate::date <= day + 90)::double as y, sum(case when o_orderdate::date <= day then 1 else 0 end)::double as z
  from days, orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by all),"""


def panel(spark, sf_dir) -> DataFrame:
    """Orders per nation in the 90 days before and after each replay date, and so far."""
    days = spark.createDataFrame([(d,) for d in REPLAY], "d string").select(F.col("d").cast("date").alias("date"))
    nation = star.read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("unit"), F.col("n_regionkey").alias("block"))
    owner = star.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")).join(F.broadcast(nation), "n_nationkey")
    # orders are first summed by nation and day, so the replay dates multiply days, not orders
    daily = star.read(spark, sf_dir, "orders").join(owner, "o_custkey").groupBy("unit", "block", F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("double")
    d, t = F.col("d"), F.col("date")
    return daily.crossJoin(F.broadcast(days)).groupBy("date", "unit", "block").agg(
        n((d > F.date_sub(t, 90)) & (d <= t)).alias("x"), n((d > t) & (d <= F.date_add(t, 90))).alias("y"), n(d <= t).alias("z")
    )


def _ranks(c: str, by: str = "date") -> str:
    return f"(rank() over (partition by {by} order by {c}) + (count(*) over (partition by {by}, {c}) - 1) / 2.0)"


_CORR = "case when count(*) >= 3 and stddev_pop({a}) * stddev_pop({b}) > 1e-12 then covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) end"
query("STA_01", f"{_PANEL} q as (select 1) select date, unit, x, {_ranks('x')}::double as rank from p")(
    lambda spark, sf_dir: panel(spark, sf_dir).select("date", "unit", "x", scoring.average_rank("x", ["date"]).alias("rank"))
)
query("STA_02", f"{_PANEL} q as (select 1) select date, round({_CORR.format(a='x', b='y')}, 6) as r from p group by date")(
    lambda spark, sf_dir: panel(spark, sf_dir).groupBy("date").agg(F.round(stats.pearson("x", "y"), 6).alias("r"))
)
query("STA_03", f"{_PANEL} r as (select date, {_ranks('x')} as a, {_ranks('y')} as b from p) select date, count(*) as n, round({_CORR.format(a='a', b='b')}, 6) as rho from r group by date")(
    lambda spark, sf_dir: stats.spearman(panel(spark, sf_dir), ["date"])
)
query("STA_04", f"""{_PANEL} r as (select date, {_ranks('x')} as a, {_ranks('y')} as b, {_ranks('z')} as c from p),
m as (select date, count(*) as n, {_CORR.format(a='a', b='b')} as xy, {_CORR.format(a='a', b='c')} as xz, {_CORR.format(a='b', b='c')} as yz from r group by date)
select date, n, round(case when (1 - xz * xz) * (1 - yz * yz) > 1e-12 then (xy - xz * yz) / sqrt((1 - xz * xz) * (1 - yz * yz)) end, 6) as rho from m""")(  # fmt: skip
    lambda spark, sf_dir: stats.partial_spearman(panel(spark, sf_dir), ["date"])
)
query("STA_08", f"""{_PANEL} c as (select date, count(*) as n from p where x is not null and y is not null group by 1),
d as (select count(*) as dates, (list_sort(list(n)))[count(*) // 2 + 1] as median_n from c)
select dates, median_n, round(2 / sqrt(nullif(median_n - 1, 0)), 6) as detectable_rho, 1 + (dates - 1) // 26 as independent_windows from d""")(
    lambda spark, sf_dir: stats.power(panel(spark, sf_dir))
)
query("STA_09", f"{_PANEL} q as (select 1) select date, block, unit, round({_ranks('x', 'date, block')} / (count(*) over (partition by date, block) + 1), 6) as rank from p")(
    lambda spark, sf_dir: panel(spark, sf_dir).select("date", "block", "unit", F.expr("1").alias("one"), "x").transform(
        lambda d: d.select("date", "block", "unit", F.round(scoring.average_rank("x", ["date", "block"]) / (F.sum("one").over(stats.Window.partitionBy("date", "block")) + 1), 6).alias("rank"))
    )
)
query("STA_10", f"""{_PANEL} f as (select date, regr_slope(y, z) as s, regr_intercept(y, z) as i from p group by date)
select date, unit, round(y - i - s * z, 4) as residual from p join f using (date) where s is not null""")(
    lambda spark, sf_dir: stats.residuals(panel(spark, sf_dir), ["date"], "y", ["z"]).filter("residual is not null").select("date", "unit", F.round("residual", 4).alias("residual"))
)
query("STA_13", f"""{_PANEL} t as (select *, row_number() over (partition by date, block order by x desc, unit) as k, count(*) over (partition by date, block) as n, y - avg(y) over (partition by date, block) as r from p)
select round(exp(avg(r)), 6) as lift, count(*) as n from t where k <= ceil(n / 10.0)""")(lambda spark, sf_dir: stats.top_decile_lift(panel(spark, sf_dir)))
_SWEEPS = 30
query("STA_13_effects", f"""{_PANEL.replace("with", "with recursive", 1)} l as materialized (select date, unit, block, x, ln(1 + y) as y, ln(1 + z) as z from p),
s as (select 0 as i, * from l union all select i + 1, date, unit, block, x, y - avg(y) over (partition by date), z - avg(z) over (partition by date)
  from (select i, date, unit, block, x, y - avg(y) over (partition by block) as y, z - avg(z) over (partition by block) as z from s where i < {_SWEEPS})),
e as (select *, y - z * (sum(z * y) over () / sum(z * z) over ()) as r, row_number() over (partition by date, block order by x desc, unit) as k, count(*) over (partition by date, block) as c from s where i = {_SWEEPS})
select round(exp(avg(r) filter (k <= ceil(c / 10.0))), 6) as lift, count(*) filter (k <= ceil(c / 10.0)) as n, count(*) as rows from e""")(  # fmt: skip
    lambda spark, sf_dir: stats.lift_with_effects(panel(spark, sf_dir).withColumns({"y": F.ln(1 + F.col("y")), "z": F.ln(1 + F.col("z"))}), ["z"])
)
query("STA_14", f"{_PANEL} q as (select 1) select date, round(avg((y = 0)::int), 6) as tied from p group by date")(
    lambda spark, sf_dir: panel(spark, sf_dir).groupBy("date").agg(F.round(F.avg((F.col("y") == 0).cast("int")), 6).alias("tied"))
)
