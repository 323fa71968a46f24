"""Registered queries of rules, watch lists, definitions, gates, exports and prototype analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, outcomes, prototypes, relevance, rules, scoring, stats, tables
from ..operators.world import KEY
from ..sources import star
from .market import _BREAK, _CORR, _DEMAND, _PANEL, _RANK, _REPLAY, BASE, CHANNEL_SNAP, DAYS, ORACLES, PRE, REPLAY, _breakouts, _ranks, _rows, panel, query, world
from .more import _SCORES, _SING, _TOK, LEXICON, _items, _relevance, _weights

# relevance


@query("REL_01", """with t as (select distinct p_brand as slug, 'domain' as axis, lower(p_name || ' ' || p_size) as term from part), k as (select axis, term, count(distinct slug) as k from t group by all)
select slug, axis, term, case when k = (select count(distinct slug) from t) then 0.0::double else 1.0::double / k end as weight from t join k using (axis, term)""")  # fmt: skip
def weights(spark, sf_dir):
    """A brand's lexicon are the names and sizes of its parts."""
    terms = star.read(spark, sf_dir, "part").select(F.col("p_brand").alias("slug"), F.lit("domain").alias("axis"), F.concat_ws(" ", "p_name", "p_size").alias("term"))
    return relevance.lexicon_weights(terms)


@query("REL_02", f"select doc_id, unnest(list_distinct({_TOK.format(c='text')})) as word from documents")
def words(spark, sf_dir):
    return star.read(spark, sf_dir, "documents").select("doc_id", F.explode(prototypes.tokens(F.col("text"))).alias("word"))


TERMS = ["the", "and", "notes", "mit", "les", "and the", "of the", "in der"]
_PLAIN = "trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'))"


@query("REL_03", f"""with d as (select doc_id as item_id, ' ' || {_PLAIN} || ' ' as p, list_distinct({_TOK.format(c="coalesce(text, '')")}) as w from documents),
t as (select unnest({TERMS}) as term) select item_id, term from d, t where case when contains(term, ' ') then contains(p, ' ' || term || ' ') else list_contains(w, {_SING.format(w='term')}) end""")  # fmt: skip
def matched(spark, sf_dir):
    items = star.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return prototypes.term_matches(items, spark.createDataFrame([(t,) for t in TERMS], "term string"))


WORDS = {lang: sorted({w for (s, _), ws in LEXICON.items() if s == lang for w in ws}) for lang in ("en", "de", "fr", "es")}
_OWN = r"list_distinct(string_split_regex(translate(lower(coalesce({c}, '')), '%s', '%s'), '[^\p{{L}}]+'))" % prototypes.FOLD
_N = lambda c, lang: f"len(list_intersect({_OWN.format(c=c)}, {WORDS[lang]}))"
_GREATEST = lambda c: "greatest(" + ", ".join(_N(c, x) for x in ("de", "fr", "es")) + ")"


@query("REL_05", rf"""with i as (select doc_id as item_id, regexp_extract(text, '^[^\n]*') as title, regexp_replace(text, '^[^\n]*', '') as description from documents),
n as (select *, len(regexp_extract_all(title, '\p{{Latin}}')) as l, len(regexp_extract_all(title, '\p{{L}}')) as a, {_N('title', 'en')} as th, {_N('description', 'en')} as dh, {_GREATEST('title')} as tf, {_GREATEST('description')} as df from i)
select item_id, case when trim(coalesce(title, '')) = '' then 'no title' when a = 0 then 'no letters' when l < 0.5 * a then 'script'
  when (tf >= 2 and tf > th) or (df >= 6 and df > 2 * dh and th < 2) then 'foreign' end as reason from n""")  # fmt: skip
def gated_texts(spark, sf_dir):
    return prototypes.gates(_items(spark, sf_dir), WORDS, "en")


@query("REL_08", f"{_SCORES} select item_id, slug from s group by all having count(*) = 2")
def prefiltered(spark, sf_dir):
    return prototypes.prefilter(_items(spark, sf_dir), _weights(spark))


@query("REL_10", f"""{_SCORES}, e as (select distinct item_id, slug, term, weight from w join (select *, {_SING.format(w='term')} as word from lex where weight > 0) using (word)),
k as (select *, row_number() over (partition by item_id, slug order by weight desc, term) as k from e)
select item_id, slug, string_agg(term, ',' order by k) as terms from k where k <= 6 group by all""")  # fmt: skip
def evidence(spark, sf_dir):
    return prototypes.evidence(_items(spark, sf_dir), _weights(spark))


@query("CAL_05", f"""{_SCORES}, k as (select *, relevance >= 0.55 as kept from r), n as (select *, row_number() over (partition by slug, kept order by case when kept then relevance else -relevance end, item_id) as nth from k)
select * from n where nth <= 5""")  # fmt: skip
def inspected(spark, sf_dir):
    return prototypes.inspected(_relevance(spark, sf_dir), 5)


# populations


@query("POP_02", f"""{PRE} x as (select 1) select cluster_id, day, video_id, relevance, case when relevance >= 0.55 then false when relevance <= 0 then true end as is_noise
from mv m where not exists (select 1 from ballast b where b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id)""")  # fmt: skip
def assigned(spark, sf_dir):
    w = world(spark, sf_dir)
    r = F.col("relevance")
    own = w.member_videos.join(w.ballast, [*KEY, "channel_id"], "left_anti")
    return own.select(*KEY, "video_id", "relevance", F.when(r >= 0.55, False).when(r <= 0, True).alias("is_noise"))


@query("POP_03", """with a as (select distinct c_nationkey as slug from customer where c_acctbal < 5000), b as (select distinct s_nationkey as slug from supplier)
(select slug, 'lexicon' as lacks from a anti join b using (slug)) union all (select slug, 'seed' from b anti join a using (slug))""")  # fmt: skip
def lexicon_gaps(spark, sf_dir):
    seeds = star.read(spark, sf_dir, "customer").filter("c_acctbal < 5000").select(F.col("c_nationkey").alias("slug"))
    return rules.gaps(seeds, star.read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("slug")))


@query("POP_07", f"""{PRE} x as (select 1) select cluster_id, day, count(*) as channels, 'v2-on-niche' as definition from members group by all
union all select cluster_id, day, count(*), 'v3-non-ballast-members' from mc group by all""")  # fmt: skip
def definitions(spark, sf_dir):
    w = world(spark, sf_dir)
    return rules.memberships(w, False).unionByName(rules.memberships(w, True))


@query("POP_18", "select distinct p_type as cluster_id, p_name as term from part where p_brand = 'Brand#5' and p_size % 3 = 0 and p_retailprice < 1500")
def demand_terms(spark, sf_dir):
    stratum = F.when(F.col("p_size") % 3 == 0, "event").otherwise("head")
    terms = star.read(spark, sf_dir, "part").select(
        F.col("p_type").alias("cluster_id"), F.col("p_name").alias("term"), F.col("p_brand").alias("source"), stratum.alias("stratum"), (F.col("p_retailprice") < 1500).alias("active")
    )
    return rules.demand_terms(terms, "Brand#5", "event")


@query("POP_22", f"""with {BASE} {CHANNEL_SNAP} x as (select 1) select channel_id, first_seen from channel c where subs between 1 and 9000
  and not exists (select 1 from csnap r where r.channel_id = c.channel_id and r.observed_date >= date '1999-06-30') order by first_seen, channel_id limit 100""")  # fmt: skip
def channel_watchlist(spark, sf_dir):
    return rules.channel_watchlist(star.channels(spark, sf_dir), star.channel_snapshots(spark, sf_dir), "1999-06-30", 9000, 100)


@query("POP_23", f"with {BASE} x as (select 1) select channel_id, first_seen from channel where subs is null order by first_seen, channel_id limit 100")
def backlog(spark, sf_dir):
    return rules.backlog(star.channels(spark, sf_dir), 100)


@query("POP_24", f"""with {BASE} s as (select user_id as channel_id, count(*) filter (event_type = 'error') as f, arg_max(event_type, (ts, event_id)) as last from events group by 1)
select channel_id, coalesce(f, 0) as fail_count, coalesce(f, 0) < 5 as target, coalesce(f, 0) >= 5 and coalesce(last = 'error', false) as dead from channel left join s using (channel_id)""")  # fmt: skip
def poll_targets(spark, sf_dir):
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    state = star.read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("channel_id")).agg(
        F.count_if(F.col("event_type") == "error").alias("fail_count"), F.when(last == "error", 404).otherwise(200).alias("last_status")
    )
    return rules.poll_targets(star.channels(spark, sf_dir), state)


# demand and supply

_EVENT = _DEMAND.replace("from orders group by all),\ndays", "from orders where o_orderstatus = 'O' group by all),\ndays")


def _event_series(spark, sf_dir):
    own = star.read(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    return own.groupBy(F.col("o_orderpriority").alias("term"), F.to_date("o_orderdate").alias("observed_date")).agg(F.count("*").cast("double").alias("value"))


@query("DEM_02", f"""{_EVENT} a as (select term as cluster_id, day, sum(value) as total, count(*) as points from series, days where observed_date <= day - 2 and observed_date > day - 30 group by all),
m as (select cluster_id, day, total / 4 as value, least(points / 28.0, 1) * least(total / 10000.0, 1) as confidence, points as inputs_n from a) {_rows('weekly_views_event')}""")  # fmt: skip
def weekly_event_views(spark, sf_dir):
    from ..operators.world import spine

    every = star.demand_snapshots(spark, sf_dir).select(F.col("term").alias("cluster_id"))
    return metrics.weekly_views(_event_series(spark, sf_dir), spine(every, DAYS), "weekly_views_event")


@query("DEM_08", ORACLES["POP_19"].replace(
    "select day, keyword, geo, observed_date, volume, competition, bid_low, bid_high from r where k = 1",
    """select day, geo, sum(volume) as value, count(volume) as inputs_n,
  round(least(count(*) / 64.0, 1) * least(count(volume) / 30.0, 1) * (30.0 / greatest(min(day - observed_date), 30)), 6) as confidence from r where k = 1 group by all"""))  # fmt: skip
def total_searches(spark, sf_dir):
    days = world(spark, sf_dir).spine.select("day").distinct()
    return metrics.total_searches(metrics.latest_keywords(star.keyword_metrics(spark, sf_dir), days), 64)


@query("DEM_07", f"""{_DEMAND} p as (select term, day, value, row_number() over (partition by term, day order by observed_date desc) as k from series, days where observed_date <= day),
a as (select term, day, avg(value) filter (k <= 13) as late, avg(value) filter (k > 13) as early, count(*) as n, count(*) filter (value <> 0) as nz from p where k <= 26 group by all),
m as (select term as cluster_id, day, case when n = 26 then late / nullif(early, 0) - 1 end as value, nz / 26.0::double as confidence, n as inputs_n from a) {_rows('trends_momentum_13w')}""")  # fmt: skip
def curve_momentum(spark, sf_dir):
    """A curve is a term's points so far, one for each day of the spine."""
    from ..operators.world import spine

    series = star.demand_snapshots(spark, sf_dir)
    grid = spine(series.select(F.col("term").alias("cluster_id")), DAYS)
    seen = series.join(F.broadcast(grid.select("day").distinct()), F.col("observed_date") <= F.col("day"))
    curves = seen.groupBy("term", F.col("day").alias("observed_date")).agg(F.array_sort(F.collect_list(F.struct(F.col("observed_date").alias("at"), "value"))).alias("points"))
    return metrics.curve_momentum(curves, grid)


@query("SUP_10", f"""with a as ({ORACLES['SUP_02']}), b as ({ORACLES['SUP_01']}), x as (select cluster_id, day, {_RANK.format(v='value')} as p, confidence from a),
y as (select cluster_id, day, {_RANK.format(v='value')} as q, confidence as c from b)
select cluster_id, day, 'supply' as metric_group, 'pressure_index' as name, round((p + q) / 2, 6) as value, least(confidence, c) as confidence,
  count(*) over (partition by day) as inputs_n, null::varchar as reason from x join y using (cluster_id, day) where p + q is not null""")  # fmt: skip
def pressure(spark, sf_dir):
    w = world(spark, sf_dir)
    return metrics.pressure_index(metrics.median_views(w).unionByName(metrics.uploads_per_week(w)))


# rules and monitoring

_REPRE = PRE.replace(", ".join(f"(date '{d}')" for d in DAYS), _REPLAY)
_COUNTS = f"""{_REPRE} n as (select cluster_id, day, count(*) as members from members group by all), bb as (select cluster_id, day, count(*) as b from ballast group by all),
c as (select n.cluster_id, n.day, members, coalesce(b, 0) as ballast from n left join bb on bb.cluster_id = n.cluster_id and bb.day = n.day)"""


@query("RUL_02", f"""{_COUNTS}, l as (select *, lag(ballast) over (partition by cluster_id order by day) as was from c)
select cluster_id, day, was, ballast, members from l where abs(ballast - was) > 0.01 * members""")  # fmt: skip
def definition_steps(spark, sf_dir):
    return rules.definition_steps(rules.ballast_counts(world(spark, sf_dir, REPLAY)), 0.01)


@query("MTR_05", f"""{_COUNTS}, l as (select *, lag(ballast) over o as was, first(ballast) over (o rows between 6 preceding and current row) as first, count(*) over (o rows between 6 preceding and current row) as held
  from c window o as (partition by cluster_id order by day))
select cluster_id, day, coalesce(abs(ballast - was) > 0.01 * members, false) as drift, held >= 3 and abs(ballast - first) > 0.02 * members as ramp from l""")  # fmt: skip
def ballast_drift(spark, sf_dir):
    return rules.ballast_drift(rules.ballast_counts(world(spark, sf_dir, REPLAY)), 0.01, 0.02, 7, 3)


_ALERTS = f"select cluster_id, day, 'demand_breakout' as rule, case when z >= 1 then 'high' else 'info' end as severity from ({_BREAK}) where fires"


def _alerts(spark, sf_dir):
    fires = _breakouts(spark, sf_dir).filter("fires")
    return fires.select(*KEY, F.lit("demand_breakout").alias("rule"), F.when(F.col("z") >= 1, "high").otherwise("info").alias("severity"))


@query("RUL_04", f"select * from ({_ALERTS}) where day >= date '1997-06-01'")
def new_alerts(spark, sf_dir):
    """What a run appends when the alerts up to mid-1997 are stored: insert-ignore on cluster, rule and day."""
    every = _alerts(spark, sf_dir)
    return tables.insert_ignore(every.filter("day < date '1997-06-01'"), every, ["cluster_id", "rule", "day"], ["severity"])


@query("RUL_05", f"""with a as ({_ALERTS}), g as (select severity, rule, cluster_id, count(*) as n from a group by all), d as (select *, row_number() over (partition by severity, rule order by cluster_id) as k from g)
select severity, rule, sum(n)::bigint as n, string_agg(cluster_id, ', ' order by k) filter (k <= 3) as clusters from d group by all""")  # fmt: skip
def alert_digest(spark, sf_dir):
    return rules.digest(_alerts(spark, sf_dir))


# cohorts and backtest


@query("PRO_02", f"{PRE} x as (select 1) select cluster_id, day, channel_id, subs, videos from cohort where subs >= 500")
def floored(spark, sf_dir):
    return world(spark, sf_dir).cohort.filter("subs >= 500").select(*KEY, "channel_id", "subs", "videos")


@query("PRO_04", f"""{PRE} {CHANNEL_SNAP} m as (select * from mc where subs > 0), e as (select m.cluster_id, m.day, m.channel_id, arg_min(c.subs, c.observed_date) as e from m join csnap c on c.channel_id = m.channel_id
  and c.observed_date - m.day between 90 and 97 and c.subs > 0 group by all)
select m.cluster_id, m.day, count(*) as members, count(*) filter (e is null) as absent, round(avg(ln(e / m.subs::double)), 6) as growth from m left join e on e.cluster_id = m.cluster_id and e.day = m.day and e.channel_id = m.channel_id group by all""")  # fmt: skip
def subs_growth(spark, sf_dir):
    return rules.subs_growth(world(spark, sf_dir).member_channels, star.channel_snapshots(spark, sf_dir).withColumnRenamed("subs", "reach"), 90, 7)


@query("PRO_05", f"""{PRE} n as (select *, count(*) over (partition by cluster_id, day) as n from cohort)
select day, count(distinct channel_id) as channels, count(distinct cluster_id) as clusters from n where n >= 10 group by 1""")  # fmt: skip
def panel_power(spark, sf_dir):
    rows = outcomes.assembled(world(spark, sf_dir).cohort.withColumn("y", F.col("median_views")), 10)
    return rows.groupBy("day").agg(F.countDistinct("channel_id").alias("channels"), F.countDistinct("cluster_id").alias("clusters"))


@query("BTE_07", f"""{_PANEL} r as (select date, {_ranks('x')} as a, {_ranks('y')} as b from p), c as (select date, count(*) as n, round({_CORR.format(a='a', b='b')}, 6) as rho from r group by date),
v as (select count(*) as dates, min(n) as units, round(avg(rho), 6) as mean_rho from c where rho is not null)
select *, case when dates = 0 then 'inconclusive' when units < 20 then 'underpowered' when mean_rho >= 0.2 then 'pass' else 'fail' end as verdict from v""")  # fmt: skip
def backtest_verdict(spark, sf_dir):
    return rules.verdict(stats.spearman(panel(spark, sf_dir), ["date"]), 20, 0.2)


# reads and prototype analytics

_KW = ORACLES["POP_19"].split(" kw as (", 1)[1].split("\nr as", 1)[0].rstrip().rstrip(",")
_KEYWORDS = f"with kw as ({_KW}"


@query("QRY_12", f"{_KEYWORDS}, m as (select * from kw where lower(keyword) in (select distinct lower(p_name) from part where p_type = 'ECONOMY')) select geo, count(*) as readings, count(distinct keyword) as keywords from m group by 1")
def matched_keywords(spark, sf_dir):
    curated = star.read(spark, sf_dir, "part").filter("p_type = 'ECONOMY'").select(F.lower("p_name").alias("k")).distinct()
    rows = star.keyword_metrics(spark, sf_dir).withColumn("k", F.lower("keyword")).join(curated, "k", "left_semi")
    return rows.groupBy("geo").agg(F.count("*").alias("readings"), F.countDistinct("keyword").alias("keywords"))


@query("LEG_07", f"""with {BASE} v as (select cluster_id, country, count(*)::double as value from video join channel using (channel_id) group by all), w as (select n_name as country, n_regionkey + 1.0::double as weight from nation)
select cluster_id, round(sum(case when country in ('CHINA', 'FRANCE') then value * weight else 0 end) / sum(value * weight), 6) as share from v join w using (country) group by 1""")  # fmt: skip
def tier_share(spark, sf_dir):
    interest = star.videos(spark, sf_dir).join(star.channels(spark, sf_dir).select("channel_id", "cluster_id", "country"), "channel_id").groupBy("cluster_id", "country").agg(F.count("*").cast("double").alias("value"))
    weight = star.read(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), (F.col("n_regionkey") + 1.0).alias("weight"))
    return prototypes.tier_share(interest, weight, ["CHINA", "FRANCE"])


def _niches(spark, sf_dir):
    return star.keyword_metrics(spark, sf_dir).withColumn("niche", F.split_part("keyword", F.lit(" "), F.lit(-1)))


@query("LEG_09", f"""{_KEYWORDS}, n as (select *, split_part(keyword, ' ', -1) as niche from kw), m as (select niche, observed_date, sum(volume) as v from n group by all),
k as (select *, row_number() over (partition by niche order by observed_date) as a, row_number() over (partition by niche order by observed_date desc) as b from m),
t as (select niche, sum(v) as volume, round(sum(v) filter (b <= 3) / sum(v) filter (a <= 3) - 1, 6) as trend, round(stddev_pop(v) / avg(v), 6) as seasonality from k group by 1),
w as (select niche, keyword, row_number() over (partition by niche order by sum(volume) desc, keyword) as k from n group by niche, keyword)
select t.*, b.best from t join (select niche, string_agg(keyword, ',' order by k) as best from w where k <= 10 group by 1) b using (niche)""")  # fmt: skip
def keyword_niches(spark, sf_dir):
    return prototypes.keyword_niches(_niches(spark, sf_dir))


@query("LEG_10", f"""{_KEYWORDS}, n as (select *, split_part(keyword, ' ', -1) as niche from kw)
select niche, round(avg(bid_high) filter (geo in ('1', '2')) / avg(bid_high) filter (geo not in ('1', '2')), 6) as ratio from n group by 1""")  # fmt: skip
def cost_ratio(spark, sf_dir):
    return prototypes.cost_ratio(_niches(spark, sf_dir), ["1", "2"])


@query("LEG_13", r"""with h as (select doc_id as item_id, regexp_extract_all(text, '([0-9]+(?:\.[0-9]+)?)', 1) as v from documents),
e as (select item_id, unnest(v) as hit, generate_subscripts(v, 1) - 1 as nth from h)
select item_id, nth, hit::double as value from e where try_cast(hit as double) between 0.1 and 100""")  # fmt: skip
def disclosures(spark, sf_dir):
    items = star.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return prototypes.disclosures(items, r"([0-9]+(?:\.[0-9]+)?)", 0.1, 100)


# sources


@query("SRC_16", r"""select doc_id as item_id, coalesce(contains(text, '?'), false) as asks, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\b([0-9]{4})\b', 1))), ','), '') as shared from documents""")
def shared_ids(spark, sf_dir):
    items = star.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return prototypes.posts(items, r"\?", r"\b([0-9]{4})\b")


@query("SRC_15", "select doc_id, case when toxic = 1 then 0 else quality end as label from labels where quality is not null or toxic = 1")
def imported_labels(spark, sf_dir):
    """Labels from JSON lines; a null label is not stored; a correction (the toxic ones) overwrites."""
    raw = star.read(spark, sf_dir, "labels")
    line = F.from_json(F.to_json(F.struct("doc_id", F.col("quality").alias("label"))), "doc_id bigint, label int").alias("r")
    first = raw.select(line).select("r.*").filter("label is not null")
    return tables.upsert(first, raw.filter("toxic = 1").select("doc_id", F.lit(0).alias("label")), ["doc_id"])


@query("SRC_10", """select p_partkey // 100 as file, p_name || ' ' || p_partkey as keyword, case when p_size % 7 <> 0 then p_size * 1000.0::double end as volume,
  round(p_size / 100.0, 2)::double as competition, round(p_retailprice, 2) as bid_high from part""")  # fmt: skip
def keyword_exports(spark, sf_dir):
    """Exports of a hundred keywords in the layout of a download: two title lines, a heading, a row of totals, decimal commas."""
    p = star.read(spark, sf_dir, "part")
    volume = F.when(F.col("p_size") % 7 != 0, F.format_string("%d 000", "p_size")).otherwise("–")
    comma = F.replace(F.format_string("%.2f", F.round("p_retailprice", 2)), F.lit("."), F.lit(","))
    line = F.concat_ws("\t", F.concat_ws(" ", "p_name", "p_partkey"), volume, F.concat("p_size", F.lit("%")), comma)
    rows = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    files = p.groupBy(F.floor(F.col("p_partkey") / 100).alias("file")).agg(rows.alias("rows"))
    whole = F.concat(F.lit("Keyword Stats\nJanuary 1 - January 31\nKeyword\tAvg. monthly searches\tCompetition\tTop of page bid (high)\n\t9\t-\t-\n"), "rows")
    content = F.when(F.col("file") % 2 == 0, F.encode(whole, "UTF-16")).otherwise(F.encode(whole, "UTF-8"))
    names = {"keyword": "keyword", "volume": "monthly searches", "competition": "competition", "bid_high": "bid (high)"}
    return prototypes.keyword_export(files.select("file", content.alias("content")), names)


@query("SRC_11", f"with {BASE} x as (select 1) select channel_id, cluster_id as category, first_seen as join_date from channel")
def channel_dump(spark, sf_dir):
    """A gzipped tab-separated dump is written and read back; counts as of the crawl are not in it."""
    from ..sources import dumps

    rows = star.channels(spark, sf_dir).select("channel_id", F.col("cluster_id").alias("category"), F.col("first_seen").alias("join_date"))
    return dumps.channels(spark, dumps.written(rows, "csv"))


@query("SRC_12", f"""with {BASE} {CHANNEL_SNAP} k as (select channel_id from channel where subs > 5000)
select channel_id, observed_date as week, video_count as videos, subs from csnap where channel_id in (select channel_id from k) and subs is not null and video_count <> 3""")  # fmt: skip
def weekly_dump(spark, sf_dir):
    """Weekly readings of kept channels; counts come as decimals; a week that cannot be read (here where three videos were counted) drops its row."""
    from ..sources import dumps

    snap = star.channel_snapshots(spark, sf_dir).filter("subs is not null")
    week = F.when(F.col("video_count") == 3, "?").otherwise(F.col("observed_date").cast("string"))
    rows = snap.select("channel_id", week.alias("week"), F.concat("video_count", F.lit(".4")).alias("videos"), F.concat("subs", F.lit(".0")).alias("subs"))
    return dumps.weekly(spark, dumps.written(rows, "csv"), star.channels(spark, sf_dir).filter("subs > 5000").select("channel_id"))


@query("SRC_13", f"with {BASE} x as (select 1) select video_id, channel_id, published, is_short from video")
def video_dump(spark, sf_dir):
    from ..sources import dumps

    return dumps.videos(spark, dumps.written(star.videos(spark, sf_dir).select("video_id", "channel_id", "published", "is_short"), "json"))


@query("SAM_02", f"""with {BASE} n as (select cluster_id, video_id from video join channel using (channel_id) where relevance >= 0.55),
k as (select *, row_number() over (partition by cluster_id order by md5('7:' || video_id), video_id) as nth from n), d as (select * from k where nth <= 15)
select d.*, (select count(*) < 60 or count(distinct cluster_id) < 5 from d) as postponed from d""")  # fmt: skip
def frame_draw(spark, sf_dir):
    own = star.videos(spark, sf_dir).filter("relevance >= 0.55").join(star.channels(spark, sf_dir).select("channel_id", "cluster_id"), "channel_id")
    return outcomes.frame_draw(own.select("cluster_id", "video_id"), "cluster_id", "video_id", 15, 7, 60, 5)


@query("SAM_04", "select p_type, p_partkey, nth from (select p_type, p_partkey, row_number() over (partition by p_type order by md5('11:' || p_partkey), p_partkey) as nth from part) where nth <= 3")
def pool_sample(spark, sf_dir):
    return outcomes.sample(star.read(spark, sf_dir, "part").select("p_type", "p_partkey"), "p_type", "p_partkey", 3, 11)


@query("LEG_08", f"""with a as (select distinct p_name as title, unnest({_TOK.format(c='p_name')}) as word from part where p_size >= 15),
b as (select distinct p_type as niche, unnest({_TOK.format(c='p_name')}) as word from part where p_size < 15) select niche, title, count(distinct word) as shared from a join b using (word) group by all""")  # fmt: skip
def trending(spark, sf_dir):
    part = star.read(spark, sf_dir, "part")
    titles = part.filter("p_size >= 15").select(F.col("p_name").alias("title")).distinct()
    return prototypes.trending_matches(titles, part.filter("p_size < 15").select(F.col("p_type").alias("niche"), F.col("p_name").alias("term")).distinct())


def _stream(spark, sf_dir, name):
    """A table as a stream, be it one file or a folder of files. A source that starts at a file takes it for a folder of
    partitions, which a pattern, though it matches one name only, avoids."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query("STR_01", """select l_orderkey, l_linenumber, l_partkey, l_quantity from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_quantity) as k
from (select distinct l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem)) where k = 1""")  # fmt: skip
def first_writes(spark, sf_dir):
    from ..streaming import jobs

    rows = _stream(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.struct("l_partkey", "l_quantity").alias("at"))
    return jobs.run(spark, jobs.first_write_wins, rows, ["l_orderkey", "l_linenumber"], "at").drop("at")


@query("STR_02", """select date_trunc('day', ts)::date as event_day, count(*) filter (hour(ts) < 22) as on_time, count(*) filter (hour(ts) >= 22) as late from events group by 1""")
def late_readings(spark, sf_dir):
    """Readings arrive two hours after their event: those of the last two hours of a day are late."""
    from ..streaming import jobs

    ts = F.col("ts").cast("timestamp_ntz")
    rows = _stream(spark, sf_dir, "events").select("event_id", F.to_date(ts).alias("event_day"), (ts + F.expr("interval 2 hours")).alias("at"))
    return jobs.run(spark, jobs.on_time, rows, "event_day", "at").groupBy("event_day").agg(F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))
