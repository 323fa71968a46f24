"""Registered queries of what is shown: feeds with lineage, histories with their definitions, look-ups, run health, controlled verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates, metrics, outcomes, reads, relevance, rules, stats
from ..operators.world import KEY
from ..sources import star
from .daily import _CARDS, _FEATURES, _GATE, _HELD, _WHY, _on_replay, cited_cards, features, gate
from .further import _ALERTS, _COUNTS, _alerts
from .market import BASE, CHANNEL_SNAP, DAYS, ORACLES, PRE, REPLAY, panel, query, world
from .more import _SCORES, scored_labels

_FOUND = """disc as (select o_orderkey as video_id, o_orderpriority as query, case when o_orderstatus = 'F' then 'date' else 'viewCount' end as order_by, o_orderdate::date + (o_orderkey % 90)::int as found from orders where o_orderkey % 3 = 0
union all select o_orderkey, 'all', 'date', o_orderdate::date + 30 from orders where o_orderkey % 4 = 0),"""


def discoveries(spark, sf_dir):
    """Searches find every third order by its priority, and every fourth by another query a month after its date."""
    o, k = star.read(spark, sf_dir, "orders"), F.col("o_orderkey")
    order = F.when(F.col("o_orderstatus") == "F", "date").otherwise("viewCount")
    day = F.to_date("o_orderdate")
    own = o.filter(k % 3 == 0).select(k.alias("video_id"), F.col("o_orderpriority").alias("query"), order.alias("order_by"), F.date_add(day, (k % 90).cast("int")).alias("found"))
    return own.unionByName(o.filter(k % 4 == 0).select(k.alias("video_id"), F.lit("all").alias("query"), F.lit("date").alias("order_by"), F.date_add(day, 30).alias("found")))


@query("QRY_04_feed", f"""{PRE} {_FOUND} n as (select *, row_number() over (partition by cluster_id, day order by published desc, video_id) as n from mv),
j as (select n.*, d.query, d.order_by from n left join disc d on d.video_id = n.video_id and d.found <= n.day),
p as (select *, row_number() over (partition by cluster_id, day order by n, query nulls first, order_by nulls first) as place from j)
select cluster_id, day, place, video_id, channel_id, published, query, order_by from p where place <= 50""")  # fmt: skip
def source_feed(spark, sf_dir):
    return reads.source_feed(world(spark, sf_dir).member_videos, discoveries(spark, sf_dir), 50)


_SWITCH = "1997-07-01"
_OWN, _ALL = _on_replay(ORACLES["SUP_04"]), _on_replay(ORACLES["SUP_04"]).replace(
    """from mv m
  where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id) group by all""", "from mv group by all")  # fmt: skip


@query("QRY_05_steps", f"""with h as (select cluster_id, day, value, 'members' as definition from ({_ALL}) where day < date '{_SWITCH}' union all select cluster_id, day, value, 'ballast' from ({_OWN}) where day >= date '{_SWITCH}'),
l as (select *, lag(definition) over (partition by cluster_id order by day) as w, row_number() over (partition by cluster_id order by day) as n from h)
select cluster_id, day, value, definition, n > 1 and definition is distinct from w as step, case when n > 1 and definition is distinct from w then w end as was from l""")  # fmt: skip
def history_with_steps(spark, sf_dir):
    """The series as it was stored: each day under the definition that held, which changed once."""
    before, after = ([d for d in REPLAY if (d < _SWITCH) == old] for old in (True, False))
    parts = [metrics.on_niche_share(world(spark, sf_dir, days, definition)).select(*KEY, "value", F.lit(definition).alias("definition")) for days, definition in ((before, "members"), (after, "ballast"))]
    return reads.steps(parts[0].unionByName(parts[1]).repartition("cluster_id"), ["cluster_id"])


@query("RUL_05_feed", f"select * from (select * from ({_ALERTS}) order by day desc, cluster_id, rule limit 200)")
def alerts_feed(spark, sf_dir):
    return reads.newest_alerts(_alerts(spark, sf_dir), 200)


@query("QRY_08_lookup", """with p as (select doc_id, left(sha256(coalesce(text, '')), 12) as prefix from documents) select prefix, doc_id from p where prefix in (select prefix from p where doc_id % 20 = 0)""")
def looked_up(spark, sf_dir):
    """Texts by the prefixes of every twentieth text, copies of those among them."""
    docs = star.read(spark, sf_dir, "documents").select("doc_id", "text")
    asked = docs.filter("doc_id % 20 = 0").select(F.left(F.sha2(F.coalesce("text", F.lit("")), 256), F.lit(12)).alias("prefix"))
    return reads.by_sha_prefix(docs, "text", asked).select("prefix", "doc_id")


@query("MTR_01_health", """with r as (select "ts"::date as day, user_id % 200 as source, event_type = 'error' as bad, (event_type = 'purchase')::int as written from events),
p as (select day, source, bool_or(bad) as bad, sum(written) as written from r group by all),
n as (select unnest(generate_series(min(day)::timestamp, max(day)::timestamp, interval 1 day))::date as day from r), e as (select day, source from n, (select distinct source from r)),
h as (select e.day, e.source, case when bad is null then 'did not run' when bad then 'finished failed' when written = 0 then 'no snapshots' end as problem from e left join p on p.day = e.day and p.source = e.source)
select * from h where problem is not null""")  # fmt: skip
def run_health(spark, sf_dir):
    runs = star.read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), (F.col("user_id") % 200).alias("source"), F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        (F.col("event_type") == "purchase").cast("int").alias("snapshots"),
    )
    return reads.health(runs)


@query("BTE_07_controlled", f"""with a as ({ORACLES['STA_03']}), b as ({ORACLES['STA_04']}),
v as (select count(*) as dates, min(n) as units, round(avg(rho), 6) as mean_rho from a where rho is not null), h as (select round(avg(rho), 6) as held_rho from b where rho is not null)
select *, case when dates = 0 then 'inconclusive' when units < 20 then 'underpowered' when mean_rho < 0.2 then 'fail' when coalesce(held_rho >= 0.2, false) then 'pass' else 'fail: size' end as verdict from v, h""")  # fmt: skip
def controlled_verdict(spark, sf_dir):
    rows = panel(spark, sf_dir)
    return rules.controlled_verdict(stats.spearman(rows, ["date"]), stats.partial_spearman(rows, ["date"]), 20, 0.2)


# counts beside the values of other queries


@query("BTE_05_lag", ORACLES["BTE_05"].replace("min_by(subs, observed_date) filter (late) as b from", "min_by(subs, observed_date) filter (late) as b, min(observed_date) filter (late) as ended from")
       .replace("count(*) as contributing from e", "count(*) as contributing, round(avg(ended - day - 180), 6) as mean_lag from e"))
def growth_with_lag(spark, sf_dir):
    return outcomes.growth(world(spark, sf_dir).members, star.channel_snapshots(spark, sf_dir), 180, 60, 90)


@query("PRO_01_counts", f"{PRE} x as (select 1) select cluster_id, day, count(*) as cohort, count(*) filter (median_views = 0) as zero_median from cohort group by all")
def cohort_counts(spark, sf_dir):
    return outcomes.cohort_counts(world(spark, sf_dir))


@query("PRO_01_age", f"""{PRE} a as (select cluster_id, day, channel_id, median(day - published)::double as median_age from elig group by all)
select cluster_id, day, channel_id, videos, median_age from cohort join a using (cluster_id, day, channel_id)""")  # fmt: skip
def cohort_age(spark, sf_dir):
    return world(spark, sf_dir).cohort.select(*KEY, "channel_id", "videos", "median_age")


@query("PRO_03_counts", f"""with r as ({ORACLES['PRO_03']}), u as ({PRE} x as (select 1) select m.cluster_id, m.day, m.channel_id, count(*) as uploads from members m join video v using (channel_id)
  where not v.is_short and v.published > m.day and v.published <= m.day + 120 group by all)
select u.*, r.reach, coalesce(r.read, 0) as read from u left join r using (cluster_id, day, channel_id)""")  # fmt: skip
def reach_counts(spark, sf_dir):
    w = world(spark, sf_dir)
    return outcomes.uploads_after(w.members, w.video, w.snapshot, 120, 1, 400)


@query("LEG_01_profile", f"""with b as ({ORACLES['LEG_01']}), o as ({PRE} x as (select 1) select v.channel_id, a.day, a.views from video v join va a using (video_id) where not is_short and date_diff('day', v.published, a.day) between 30 and 720),
h as (select o.channel_id, o.day, count(*) filter (b.median_views > 0 and o.views >= 5 * b.median_views) as breakthroughs from o join b using (channel_id, day) group by all),
c as (with {BASE} x as (select 1) select channel_id, subs from channel)
select b.*, breakthroughs, round(median_views / nullif(subs, 0)::double, 6) as per_sub from b join h using (channel_id, day) left join c using (channel_id)""")  # fmt: skip
def profile(spark, sf_dir):
    w = world(spark, sf_dir)
    return outcomes.channel_profile(w.video, w.views, w.channel, 30, 720, 5)


_EDGES = [0.01, 0.3, 0.55]


@query("CAL_01_bands", f"""{_SCORES}, l as (select distinct slug from lex), b as (select l.slug, t.quality as label, r.relevance as value from labels t cross join l left join r on r.item_id = t.doc_id and r.slug = l.slug),
g as (select slug, case when value is not null then {" + ".join(f"(value >= {e})::int" for e in _EDGES)} end as band, count(*) as n, avg(label)::double as p from b group by 1, 2)
select slug, band, n, round(p, 6) as share, round((p + 3.8416::double / (2 * n) - 1.96::double * sqrt(p * (1 - p) / n + 3.8416::double / (4 * n * n))) / (1 + 3.8416::double / n), 6) as wilson_low from g""")  # fmt: skip
def calibration_bands(spark, sf_dir):
    return relevance.bands(scored_labels(spark, sf_dir), _EDGES, "slug")


@query("MTR_04_channels", f"""with {BASE} {CHANNEL_SNAP} p as (select c.channel_id, exists (select 1 from csnap r where r.channel_id = c.channel_id and r.observed_date >= date '{DAYS[0]}') as held from channel c where subs between 1 and 10000 and first_seen <= date '{DAYS[0]}')
select count(*) as population, count(*) filter (held) as held, round(count(*) filter (held) / nullif(count(*), 0)::double, 6) as share, count(*) >= 50 and count(*) filter (held) < 0.9 * count(*) as warn from p""")  # fmt: skip
def channel_coverage(spark, sf_dir):
    """Of small channels that were known by the day, those with a reading since."""
    day = F.lit(DAYS[0]).cast("date")
    due = star.channels(spark, sf_dir).filter(F.col("subs").between(1, 10_000) & (F.col("first_seen") <= day)).select("channel_id")
    held = star.channel_snapshots(spark, sf_dir).filter(F.col("observed_date") >= day).select("channel_id", F.lit(True).alias("held")).distinct()
    return reads.coverage(due.join(held, "channel_id", "left"), 50, 0.9)


@query("POP_04_seeds", f"""with {BASE} s as (select cluster_id, sum(channel_id) % 3 <> 0 as seed_active from channel group by 1), n as (select distinct cluster_id, true as live from video join channel using (channel_id) where relevance >= 0.55)
select cluster_id, seed_active, seed_active and coalesce(live, false) as active, case when not (seed_active and coalesce(live, false)) then date '{DAYS[1]}' end as retired_on from s left join n using (cluster_id)""")  # fmt: skip
def clusters_by_seed(spark, sf_dir):
    channel = star.channels(spark, sf_dir)
    seeds = channel.groupBy("cluster_id").agg((F.sum("channel_id") % 3 != 0).alias("seed_active"))
    on = star.videos(spark, sf_dir).filter("relevance >= 0.55").join(channel.select("channel_id", "cluster_id"), "channel_id")
    return rules.clusters_by_seed(seeds, on, DAYS[1])


# definitions, conditions and the gated view


@query("POP_07_switch", f"""{_on_replay(PRE)} x as (select 1) select cluster_id, day, count(*) as channels, 'members' as definition from members where day < date '{_SWITCH}' group by all
union all select cluster_id, day, count(*), 'ballast' from mc where day >= date '{_SWITCH}' group by all""")  # fmt: skip
def members_by_definition(spark, sf_dir):
    """Members of a cluster as each day defined them."""
    counts = {name: world(spark, sf_dir, REPLAY, name).channel_counts().withColumnRenamed("total", "channels") for name in ("members", "ballast")}
    return rules.by_definition(counts, _SWITCH)


@query("MTR_05_definitions", f"""{_COUNTS}, k as (select cluster_id, day, members, case when month(day) <> 5 then ballast end as ballast, case when day < date '{_SWITCH}' then 'members' else 'ballast' end as definition from c),
l as (select *, lag(ballast) over o as was, first(ballast) over w as first, count(*) over w as held, lag(ballast) over (partition by cluster_id order by day) as prior
  from k window o as (partition by cluster_id, definition order by day), w as (partition by cluster_id, definition order by day rows between 6 preceding and current row))
select cluster_id, day, definition, coalesce(abs(ballast - was) > 0.01 * members, false) as drift, held >= 3 and coalesce(abs(ballast - first) > 0.02 * members, false) as ramp,
  ballast is null and prior is not null as dropped from l""")  # fmt: skip
def drift_by_definition(spark, sf_dir):
    """Counts of May lack their stamp."""
    counts = rules.ballast_counts(world(spark, sf_dir, REPLAY))
    stamped = counts.withColumn("ballast", F.when(F.month("day") != 5, F.col("ballast")))
    named = stamped.withColumn("definition", F.when(F.col("day") < F.lit(_SWITCH).cast("date"), "members").otherwise("ballast"))
    return rules.drift_within(named, 0.01, 0.02, 7, 3)


_TIER = ["1", "2"]


@query("MTR_09_all", f"""with {BASE} o as (select avg((date '{DAYS[1]}' - published > 365)::int) >= 0.2 as f from video where relevance >= 0.55), k as (select avg((is_short is not null)::int) >= 0.8 as f from video),
t as (select bool_or(right(p_brand, 1) in ('1', '2')) and bool_or(right(p_brand, 1) not in ('1', '2')) as f from part), c as (select count(gap) > 0 as f from ({_CARDS}))
select 'older than a year' as condition, coalesce(f, false) as fires from o union all select 'known format', coalesce(f, false) from k union all select 'both tiers', coalesce(f, false) from t union all select 'cited score', coalesce(f, false) from (select f and false as f from c)""")  # fmt: skip
def data_conditions(spark, sf_dir):
    """Four conditions that reopen deferred work; the last holds once a card shows a score, which the gate does not let it."""
    video = star.videos(spark, sf_dir)
    share = lambda df, c, least: df.agg((F.avg(c.cast("int")) >= least).alias("f"))
    first = F.substring("p_brand", -1, 1).isin(_TIER)
    return rules.conditions({
        "older than a year": share(video.filter("relevance >= 0.55"), F.datediff(F.lit(DAYS[1]).cast("date"), "published") > 365, 0.2),
        "known format": share(video, F.col("is_short").isNotNull(), 0.8),
        "both tiers": star.read(spark, sf_dir, "part").agg((F.bool_or(first) & F.bool_or(~first)).alias("f")),
        "cited score": cited_cards(spark, sf_dir).agg((F.count("gap") > 0).alias("f")),
    })


@query("QRY_10_gated", f"""with {_GATE} f as ({_FEATURES}), c as ({_CARDS}) select f.cluster_id, f.day, f.metric_group, f.name, case when not ({_HELD.format(n='f.name')}) then f.value end as value, f.confidence, f.inputs_n,
  case when {_HELD.format(n='f.name')} then {_WHY} else f.reason end as reason, not ({_HELD.format(n='f.name')}) as cited, null::double as gap, null::varchar as stage, c.momentum, '{gates.CARD_REASON}' as card_reason
from f join c using (cluster_id, day) left join gate using (cluster_id) where f.day = date '{DAYS[1]}'""")  # fmt: skip
def gated_view(spark, sf_dir):
    """The newest metrics of every cluster with its card, both behind the gate."""
    shown = gates.metrics(features(spark, sf_dir, DAYS[1:]), gate(spark, sf_dir))
    card = cited_cards(spark, sf_dir).select(*KEY, "gap", "stage", "momentum", F.col("reason").alias("card_reason"))
    return shown.join(card, KEY)

