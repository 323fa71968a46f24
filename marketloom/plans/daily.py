"""Registered queries of the daily build: all metrics of every cluster and day, cards, stages, collapses, replay and view."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates, metrics, reads, scoring, tables
from ..operators.world import KEY, Calendar
from ..sources import star
from ..streaming.jobs import folder
from . import reads as _reads  # noqa: F401  registers QRY_07
from .further import _EVENT
from .market import _DEMAND, _RANK, DAYS, ORACLES, PRE, QUERIES, REPLAY, _known, query, world

#: The market whose keyword readings the daily build takes.
GEO = "1"
CARD = {"demand": "weekly_views", "openness": "breakthrough_rate_cohort", "momentum": "yoy", "evidence": "momentum_28d"}

#: The metrics of members, videos and channels, by name.
WORLD = {
    "uploads_per_week": metrics.uploads_per_week, "median_views": metrics.median_views, "trimmed_mean_views": metrics.trimmed_mean_views,
    "on_niche_share": metrics.on_niche_share, "geo_concentration": lambda w: metrics.geo_concentration(w, "CHINA"), "format_mix": metrics.format_mix,
    "top10_concentration": metrics.top10_concentration, "breakthrough_rate_cohort": metrics.breakthrough_rate, "views_per_sub": metrics.views_per_sub,
    "winner_age_years": metrics.winner_age_years, "midroll_eligible_share": metrics.midroll_share,
}
PRESSURE = ["median_views", "uploads_per_week"]


def _curves(series: DataFrame, days: DataFrame) -> DataFrame:
    """A cluster's curve on each day: its points so far."""
    seen = Calendar(days).on(series, "observed_date", None)
    return seen.groupBy("term", F.col("day").alias("observed_date")).agg(F.array_sort(F.collect_list(F.struct(F.col("observed_date").alias("at"), "value"))).alias("points"))


def features(spark, sf_dir: str, days: list[str], only: list[str] | None = None, definition: str = "ballast") -> DataFrame:
    """Every metric of every cluster and day, NULL ones too, and those that need all clusters: one plan. `only` names the
    metrics that are wanted; others are not planned."""
    w = world(spark, sf_dir, days, definition)
    at = w.spine
    series, events = star.cluster_demand(spark, sf_dir), star.cluster_demand(spark, sf_dir, event=True)
    words = star.keyword_metrics(spark, sf_dir, clusters=True).filter(F.col("geo") == GEO)
    curated = words.groupBy("cluster_id").agg(F.countDistinct("keyword").alias("curated"))
    every = {name: m(w) for name, m in WORLD.items() if only is None or name in only}
    demand = {
        "weekly_views": lambda: metrics.weekly_views(series, w.spine), "weekly_views_event": lambda: metrics.weekly_views(events, w.spine, "weekly_views_event"),
        "momentum_28d": lambda: metrics.change(series, w.spine, 28, "momentum_28d"), "yoy": lambda: metrics.change(series, w.spine, 365, "yoy"),
        "volatility_365d": lambda: metrics.volatility(series, w.spine), "seasonality": lambda: metrics.seasonality(series, w.spine),
        "trends_momentum_13w": lambda: metrics.curve_momentum(_curves(series, at), w.spine),
    }
    every |= {name: m() for name, m in demand.items() if only is None or name in only}
    if only and "views_per_new_video" in only:
        every["views_per_new_video"] = metrics.views_per_new_video(w, star.channel_snapshots(spark, sf_dir).withColumnRenamed("subs", "reach"))
    if only is None:
        every["keywords"] = metrics.keyword_features(metrics.latest_keywords(words, at, "cluster_id"), curated, w.spine)
        every["pressure_index"] = metrics.pressure_index(every[PRESSURE[0]].unionByName(every[PRESSURE[1]]))
    # Spark may take the union for partitioned by cluster and day, as each metric's rows are, and then miss partners of rows
    # whose metric was planned otherwise at run time; an own exchange of these few rows rules that out.
    return reduce(DataFrame.unionByName, every.values()).repartition("cluster_id")


#: What a replay computes, and what it ranks supply by.
BACKTEST = [
    "weekly_views", "momentum_28d", "yoy", "volatility_365d", "uploads_per_week", "views_per_new_video", "on_niche_share", "top10_concentration", "winner_age_years",
]
SUPPLY_FROM = "views_per_new_video"
#: Decision dates: every seventh day.
WEEKS = [str(datetime.date(1995, 6, 4) + datetime.timedelta(7 * k)) for k in range(161)]


def replay(spark, sf_dir: str, days: list[str], definition: str = "ballast") -> DataFrame:
    """The metrics of a backtest at every decision date, under one pinned definition of a member, which each row names. The
    functions are those of a daily build, on a longer spine, in one job."""
    return features(spark, sf_dir, days, BACKTEST, definition).withColumn("definition", F.lit(definition))


def replay_cards(spark, sf_dir: str, days: list[str], definition: str = "ballast") -> DataFrame:
    """Cards of a replay: supply by SUPPLY_FROM, openness by the age of winners."""
    made = replay(spark, sf_dir, days, definition)
    return scoring.scorecards(made, SUPPLY_FROM, "weekly_views", "winner_age_years", "yoy", "momentum_28d").withColumn("definition", F.lit(definition))


def cards(spark, sf_dir: str, days: list[str]) -> DataFrame:
    return scoring.scorecards(features(spark, sf_dir, days, ["median_views", *CARD.values()]), "median_views", **CARD)


_ORDERED = ("select o_orderpriority as term, o_orderdate::date as observed_date", "from orders")
_SEGMENT = ("select c_mktsegment as term, o_orderdate::date as observed_date", "from orders join customer on c_custkey = o_custkey")


def _by_segment(sql: str) -> str:
    """The SQL of a demand metric, whose terms are the clusters of the world."""
    for start in (_EVENT, _DEMAND):
        if sql.startswith(start):
            begin = start.index("series as (")
            return start[:begin] + start[begin:].replace(_ORDERED[0], _SEGMENT[0]).replace(_ORDERED[1], _SEGMENT[1]) + sql[len(start) :]
    raise ValueError(sql)


_WORDS = ORACLES["POP_19"].split(" kw as (select ", 1)[1].split(" from part)", 1)[0]
_EACH = [
    ("total_monthly_searches", "searches", "searched"), ("priced_share", "priced / n::double", "n"), ("competition_index_mean", "competition", "indexed"),
    ("vw_cpc", "spend / nullif(weights, 0)", "used"), ("median_bid_high", "high", "highs"),
]
_NAMES = "(values " + ", ".join(f"('{'demand' if i == 0 else 'money'}', '{k}')" for i, (k, _, _) in enumerate(_EACH)) + ") t(metric_group, name)"
_KEYWORD_ROWS = f"""{PRE} kw as (select ({star.CURATED})[(p_partkey % {len(star.CURATED)})::int + 1] as cluster_id, {_WORDS} from part where right(p_brand, 1) = '{GEO}'),
cur as (select cluster_id, count(distinct keyword) as curated from kw group by 1),
r as (select *, row_number() over (partition by cluster_id, day, keyword order by observed_date desc, volume desc, bid_high desc nulls last, bid_low desc nulls last, competition desc nulls last) as k
  from kw, days where observed_date <= day),
l as (select *, case when bid_low is not null and bid_high is not null then (bid_low + bid_high) / 2 else coalesce(bid_low, bid_high) end as mid from r where k = 1),
g as (select cluster_id, day, count(*) as n, min(day - observed_date) as age, sum(volume) as searches, count(volume) as searched, count(mid) as priced, avg(competition) as competition, count(competition) as indexed,
  sum(volume * mid) filter (mid is not null and volume <> 0) as spend, sum(volume) filter (mid is not null and volume <> 0) as weights, count(*) filter (mid is not null and volume <> 0) as used,
  median(bid_high) as high, count(bid_high) as highs from l group by all),
f as (select *, least(n / curated::double, 1) * (30.0 / greatest(age, 30)) as sure from g join cur using (cluster_id)),
m as ({' union all '.join(f"select cluster_id, day, '{k}' as name, ({v})::double as value, least({n} / 30.0, 1) * sure as confidence, {n} as inputs_n from f" for k, v, n in _EACH)}),
grid as (select s.cluster_id, s.day, t.metric_group as g, t.name as k from spine s, {_NAMES})
select grid.cluster_id, grid.day, {_known('g', 'k', 'm.day')} from grid left join m on m.cluster_id = grid.cluster_id and m.day = grid.day and m.name = k"""

_DIRECT = ["SUP_01", "SUP_02", "SUP_03", "SUP_04", "SUP_05", "SUP_06", "SUP_07", "OPN_01", "OPN_02", "OPN_03", "MON_01", "SUP_10"]
_FEATURES = " union all ".join(
    f"(select cluster_id, day, metric_group, name, value, confidence, inputs_n, reason from ({sql}))"
    for sql in [*[ORACLES[k] for k in _DIRECT], *[_by_segment(ORACLES[k]) for k in ("DEM_01", "DEM_02", "DEM_03", "DEM_04", "DEM_05", "DEM_06", "DEM_07")], _KEYWORD_ROWS]
)


def _on(sql: str, days: list[str]) -> str:
    """SQL for other days."""
    return sql.replace(", ".join(f"(date '{d}')" for d in DAYS), ", ".join(f"(date '{d}')" for d in days))


def _on_replay(sql: str) -> str:
    return _on(sql, REPLAY)


@query("SCO_02", _FEATURES)
def daily(spark, sf_dir):
    return features(spark, sf_dir, DAYS)


_FIRST = ["median_views", "on_niche_share"]


@query("SCO_02_stored", f"select * from ({_FEATURES}) where day = date '{DAYS[1]}' or name in ('{_FIRST[0]}', '{_FIRST[1]}')")
def stored(spark, sf_dir):
    """A build of two metrics for both days, then the whole build of the second one, are stored by day; the second run merges
    into its own day only."""
    path = folder(spark)
    for days, only in ((DAYS, _FIRST), (DAYS[1:], None)):
        tables.upsert_days(features(spark, sf_dir, days, only), path, [*KEY, "name"], "day")
    return spark.read.parquet(path)


@query("SCO_02_detail", f"""{PRE} oldest as (select cluster_id, day, channel_id, min(published) as oldest from mv group by all),
nw as (select distinct cluster_id, day, channel_id from nv where not is_short and published > day - 28),
sd as (select c_mktsegment as cluster_id, o_orderdate::date as observed_date, count(*)::double as value from orders join customer on c_custkey = o_custkey group by all),
mo as (select cluster_id, day, month(observed_date) as m, avg(value) as a, sum(value) as s, count(*) as c from sd, days where observed_date <= day - 2 group by all),
ix as (select *, a / (sum(s) over w / sum(c) over w) as i, count(*) over w as n from mo window w as (partition by cluster_id, day)),
f as (select cluster_id, day, 'median_views' as name, 'p90_views' as field, null::varchar as label, views::double as value from (
  select *, row_number() over (partition by cluster_id, day order by views) as k, count(*) over (partition by cluster_id, day) as n from en) where k = floor(0.9::double * (n - 1)) + 1
union all select cluster_id, day, 'median_views', 'contributing_channels', null, count(distinct channel_id) from en group by all
union all select cluster_id, day, 'median_views', 'ballast_channels', null, count(*) from ballast group by all
union all select cluster_id, day, 'median_views', 'ballast_rows', null, count(*) from mv join ballast using (cluster_id, day, channel_id) group by all
union all select cluster_id, day, 'uploads_per_week', 'channels_publishing', null, count(*) from nw group by all
union all select cluster_id, day, 'uploads_per_week', 'publishing_span_censored', null, count(*) filter (oldest > day - 28) from nw join oldest using (cluster_id, day, channel_id) group by all
union all select cluster_id, day, 'uploads_per_week', 'channels_span_censored', null, count(*) from mc join oldest using (cluster_id, day, channel_id) where oldest > day - 28 group by all
union all select cluster_id, day, 'geo_concentration', 'country_' || k, country, n from (
  select *, row_number() over (partition by cluster_id, day order by n desc, country) as k from (select cluster_id, day, country, count(*) as n from mc where country is not null group by all)) where k <= 5
union all select cluster_id, day, 'seasonality', 'month_' || lpad(m::varchar, 2, '0'), null, round(i, 3) from ix where n = 12
union all select cluster_id, day, 'seasonality', 'peak_month', null, m from (select *, row_number() over (partition by cluster_id, day order by a desc, m) as k from ix where n = 12) where k = 1
union all select cluster_id, day, 'seasonality', 'trough_month', null, m from (select *, row_number() over (partition by cluster_id, day order by a, m) as k from ix where n = 12) where k = 1)
select * from f""")  # fmt: skip
def details(spark, sf_dir):
    return metrics.details(world(spark, sf_dir), star.cluster_demand(spark, sf_dir))


_ONE = lambda name, column: f"max({column}) filter (name = '{name}')"
_CARDS = f"""with f as ({_FEATURES}),
w as (select cluster_id, day, {_ONE(CARD['openness'], 'value')} as openness, {_ONE('median_views', 'value')} as s, {_ONE(CARD['demand'], 'value')} as d,
  {_ONE(CARD['momentum'], 'value')} as momentum, {_ONE(CARD['evidence'], 'value')} as evidence,
  least({_ONE('median_views', 'confidence')}, {_ONE(CARD['demand'], 'confidence')}) as sure, {_ONE(CARD['momentum'], 'confidence')} as msure from f group by all),
r as (select *, {_RANK.format(v='s')} as supply, {_RANK.format(v='d')} as demand from w), g as (select *, demand - supply as gap from r)
select cluster_id, day, openness, round(supply, 6) as supply, round(demand, 6) as demand, round(gap, 6) as gap, case when gap is not null then sure end as gap_confidence, momentum, evidence,
  case when momentum is null or gap is null then 'unknown' when momentum > 0 and gap > 0 then 'emerging' when momentum > 0 then 'contested' when gap > 0 then 'cooling' else 'saturated' end as stage,
  case when momentum is not null and gap is not null then least(msure, sure) end as stage_confidence,
  nullif(concat_ws(' and ', case when momentum is null then 'no momentum' end, case when gap is null then 'no gap' end), '') as reason from g"""


@query("SCO_03", _CARDS)
def daily_cards(spark, sf_dir):
    return cards(spark, sf_dir, DAYS)


@query("SCO_04", f"select cluster_id, day, momentum, gap, stage, stage_confidence, reason from ({_CARDS})")
def stages(spark, sf_dir):
    return daily_cards(spark, sf_dir).select(*KEY, "momentum", "gap", "stage", "stage_confidence", "reason")


@query("RUL_03", f"""with f as ({_on_replay(_FEATURES)}), l as (select *, lag(value) over o as was, lag(inputs_n) over o as had from f window o as (partition by cluster_id, name order by day))
select cluster_id, day, name, had, inputs_n from l where was is not null and (value is null or 2 * inputs_n <= had)""")  # fmt: skip
def evidence_collapse(spark, sf_dir):
    """Over the replay dates, on which inputs fall as readings end."""
    return scoring.collapses(features(spark, sf_dir, REPLAY))


@query("BTE_04", _on_replay(_FEATURES))
def replayed(spark, sf_dir):
    """The metrics on every replay date: the same functions as in a daily build, on a spine of many days, in one job."""
    return features(spark, sf_dir, REPLAY)


@query("BTE_04_cards", _on_replay(_CARDS))
def replayed_cards(spark, sf_dir):
    return cards(spark, sf_dir, REPLAY)


_BACKTEST = _on(" union all ".join(
    f"(select cluster_id, day, metric_group, name, value, confidence, inputs_n, reason from ({sql}))"
    for sql in [*[ORACLES[k] for k in ("SUP_01", "SUP_09", "SUP_04", "SUP_07", "OPN_03")], *[_by_segment(ORACLES[k]) for k in ("DEM_01", "DEM_03", "DEM_04", "DEM_05")]]
), WEEKS)


@query("BTE_04_weekly", f"select *, 'ballast' as definition from ({_BACKTEST})")
def weekly_replay(spark, sf_dir):
    """Nine metrics on 161 decision dates a week apart."""
    return replay(spark, sf_dir, WEEKS)


_WITHOUT = _BACKTEST.replace("mc as (select * from members m where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id))", "mc as (select * from members)").replace(
    """from mv m
  where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id) group by all""", "from mv group by all")  # fmt: skip


@query("BTE_04_pinned", f"select *, 'members' as definition from ({_WITHOUT})")
def pinned_replay(spark, sf_dir):
    """The same with the older definition pinned, under which ballast counts."""
    return replay(spark, sf_dir, WEEKS, "members")


_WEEKLY_CARDS = _CARDS.replace(_FEATURES, _BACKTEST).replace("'median_views'", "'views_per_new_video'").replace(f"'{CARD['openness']}'", "'winner_age_years'")


@query("BTE_04_weekly_cards", f"select *, 'ballast' as definition from ({_WEEKLY_CARDS})")
def weekly_cards(spark, sf_dir):
    return replay_cards(spark, sf_dir, WEEKS)


@query("QRY_10", f"""with c as ({_CARDS}), f as ({_FEATURES})
select f.cluster_id, f.day, f.metric_group, f.name, f.value, f.confidence, f.inputs_n, f.reason, c.gap, c.stage from f join c using (cluster_id, day) where day = date '{DAYS[1]}'""")  # fmt: skip
def niche_view(spark, sf_dir):
    """The newest metrics of every cluster with its card."""
    newest = DAYS[1:]
    return features(spark, sf_dir, newest).join(cards(spark, sf_dir, newest).select(*KEY, "gap", "stage"), KEY)


#: The axis that each cluster is scored on, and the bar that its rule has to reach against hand labels.
AXES, BAR = {"AUTOMOBILE": "event", "BUILDING": "event", "FURNITURE": "exposition", "HOUSEHOLD": "exposition"}, 0.0
_KAPPA = "(agree - pa * pb - (1 - pa) * (1 - pb)) / nullif(1 - pa * pb - (1 - pa) * (1 - pb), 0)"
_GATE = f"""ax as (select * from (values {", ".join(f"('{c}', '{a}')" for c, a in AXES.items())}) t(cluster_id, axis)),
sides as (select 'event' as axis, quality = 1 as a, toxic = 0 as b from labels union all select 'exposition', quality = 1, toxic = 1 from labels),
kap as (select axis, {_KAPPA} as kappa from (select axis, avg((a = b)::int) as agree, avg(a::int) as pa, avg(b::int) as pb from sides group by axis)),
gate as (select cluster_id, axis, not coalesce(kappa >= {BAR}, false) as withheld from ax left join kap using (axis)),"""
_HELD = "coalesce(withheld, false) and {n} in ('" + "', '".join(gates.SCORER_DEPENDENT) + "')"
_WHY = "'withheld: the ' || axis || ' rule is not validated'"


def gate(spark, sf_dir):
    """Clusters whose axis is withheld, from the agreement of each axis with hand labels."""
    labels = star.read(spark, sf_dir, "labels")
    quality = F.col("quality") == 1
    results = [reads.agreement(labels.select(quality.alias("a"), (F.col("toxic") == t).alias("b"))).select(F.lit(axis).alias("axis"), "kappa") for axis, t in (("event", 0), ("exposition", 1))]
    return gates.axes(spark.createDataFrame(list(AXES.items()), "cluster_id string, axis string"), results[0].unionByName(results[1]), BAR)


@query("QRY_09_metrics", f"""with {_GATE} f as ({_FEATURES}) select f.cluster_id, day, name, case when not ({_HELD.format(n='name')}) then value end as value,
  case when {_HELD.format(n='name')} then {_WHY} else reason end as reason, not ({_HELD.format(n='name')}) as cited from f left join gate using (cluster_id)""")  # fmt: skip
def cited_metrics(spark, sf_dir):
    return gates.metrics(features(spark, sf_dir, DAYS).select(*KEY, "name", "value", "reason"), gate(spark, sf_dir))


@query("QRY_09_cards", f"""select cluster_id, day, momentum, evidence, null::double as gap, null::double as supply, null::double as demand, null::double as openness, null::double as gap_confidence,
  null::varchar as stage, null::double as stage_confidence, '{gates.CARD_REASON}' as reason from ({_CARDS})""")  # fmt: skip
def cited_cards(spark, sf_dir):
    return gates.cards(daily_cards(spark, sf_dir))


@query("QRY_09_drilldown", f"""with {_GATE} i as ({ORACLES['QRY_07']})
select metric, i.cluster_id, day, input_id, case when not ({_HELD.format(n='metric')} and metric = 'on_niche_share') then value end as value,
  case when not ({_HELD.format(n='metric')} and metric = 'on_niche_share') then place end as place, not ({_HELD.format(n='metric')}) as cited from i left join gate using (cluster_id)""")  # fmt: skip
def cited_inputs(spark, sf_dir):
    return gates.inputs(QUERIES["QRY_07"](spark, sf_dir), gate(spark, sf_dir))
