"""Registered queries of tests by draws, verdicts, thresholds, draws, curves and rising queries. Draws go by md5, so that SQL can replay them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relevance, stats, trends
from ..sources import star
from .market import _CORR, _PANEL, _ranks, DAYS, ORACLES, PRE, panel, query, world
from .more import _SCORES, _items, _weights

DRAWS = 1000


def _relabelled(seed: int, block: bool = False) -> str:
    by = ", block" if block else ""
    part = "partition by block " if block else ""
    return f"""units as (select distinct unit{by} from p), pl as (select *, row_number() over ({part}order by unit) as k from units),
dr as (select draw{by}, unit as partner, row_number() over (partition by draw{by} order by md5('{seed}:' || draw || ':' || unit), unit) as k from units, (select range as draw from range({DRAWS})) t),
moved as (select draw, a.date, a.unit, a.block, a.x, a.z, b.y from p a join pl on pl.unit = a.unit join dr on dr.k = pl.k {'and dr.block = pl.block' if block else ''} join p b on b.date = a.date and b.unit = dr.partner),"""


_TEST = """m as (select round(avg(rho), 6) as rho, avg(rho) as exact, count(*) as dates from real where rho is not null),
nl as (select draw, avg(rho) as rho from nulls where rho is not null group by draw)
select dates, m.rho as rho, count(*) as draws, round((count(*) filter (abs(nl.rho) >= abs(exact) - 1e-9) + 1) / (count(*) + 1.0::double), 6) as p from nl, m group by all"""


def _spearman(source: str, keys: str) -> str:
    return f"(select {keys}, round({_CORR.format(a='a', b='b')}, 6) as rho from (select {keys}, {_ranks('x', keys)} as a, {_ranks('y', keys)} as b from {source}) group by all)"


def _partial(source: str, keys: str, block: bool = False) -> str:
    by = f"{keys}, block" if block else keys
    rank = lambda c: _ranks(c, by) + (f" / (count(*) over (partition by {by}) + 1)" if block else "")
    c = lambda a, b: _CORR.format(a=a, b=b)
    return f"""(select {keys}, n, round(case when {'n >= 5 and ' if block else ''}(1 - xz * xz) * (1 - yz * yz) > 1e-12 then (xy - xz * yz) / sqrt((1 - xz * xz) * (1 - yz * yz)) end, 6) as rho from (
  select {keys}, count(*) as n, {c('a', 'b')} as xy, {c('a', 'c')} as xz, {c('b', 'c')} as yz from (select {keys}, {rank('x')} as a, {rank('y')} as b, {rank('z')} as c from {source}) group by all))"""


query("STA_05", f"{_PANEL} {_relabelled(1)} real as {_spearman('p', 'date')}, nulls as {_spearman('moved', 'draw, date')}, {_TEST}")(
    lambda spark, sf_dir: stats.permutation_test(panel(spark, sf_dir), DRAWS)
)
query("STA_06", f"{_PANEL} {_relabelled(1)} real as {_partial('p', 'date')}, nulls as {_partial('moved', 'draw, date')}, {_TEST}")(
    lambda spark, sf_dir: stats.partial_test(panel(spark, sf_dir), DRAWS)
)
query("STA_07", f"""{_PANEL} units as (select unit, row_number() over (order by unit) - 1 as place from (select distinct unit from p)),
picks as (select draw, u.unit from units s, (select range as draw from range({DRAWS})) t, units u where u.place = ('0x' || left(md5('2:' || draw || ':' || s.place), 8))::bigint % (select count(*) from units)),
drawn as (select draw, date, x, y from picks join p using (unit)), c as {_spearman('drawn', 'draw, date')}, m as (select draw, avg(rho) as rho from c group by draw having avg(rho) is not null),
o as (select rho, row_number() over (order by rho) - 1 as nth, count(*) over () as n from m)
select round(max(rho) filter (nth = floor(n * 0.025)), 6) as low, round(max(rho) filter (nth = least(floor(n * 0.975), n - 1)), 6) as high, count(*) as draws from o""")(  # fmt: skip
    lambda spark, sf_dir: stats.bootstrap(panel(spark, sf_dir), DRAWS)
)
query("STA_11", f"{_PANEL} r as {_partial('p', 'date', True)} select date, n, rho from r")(lambda spark, sf_dir: stats.stratified_partial(panel(spark, sf_dir), ["z"]))
query("STA_12", f"{_PANEL} {_relabelled(1, True)} real as {_partial('p', 'date', True)}, nulls as {_partial('moved', 'draw, date', True)}, {_TEST}")(
    lambda spark, sf_dir: stats.stratified_test(panel(spark, sf_dir), ["z"], DRAWS)
)


_BY_Z = _PANEL.replace("\np as (select day", "\np0 as (select day") + " p as (select * replace (z as y) from p0),"
_INSTRUMENT = f"{_BY_Z} {_relabelled(1)} real as {_spearman('p', 'date')}, nulls as {_spearman('moved', 'draw, date')}, {_TEST}"


@query("PRO_06", f"""with a as (select median_n from ({ORACLES['STA_08']})), b as ({_PANEL} q as (select 1) select round(avg((y = 0)::int), 6) as tied from p), c as (select lift from ({ORACLES['STA_13']})),
d as (select p as instrument_p from ({_INSTRUMENT})), e as (select rho, p from ({ORACLES['STA_12']}))
select *, case when median_n < 20 then 'underpowered' when tied > 0.5 then 'tied' when instrument_p >= 0.05 then 'instrument' when p >= 0.05 or rho <= 0 then 'fail: no association'
  when lift < 1.2 then 'fail: no lift' else 'pass' end as verdict from a, b, c, d, e""")  # fmt: skip
def verdict(spark, sf_dir):
    """The instrument is known to work if past orders go with all orders so far."""
    rows = panel(spark, sf_dir)
    instrument = stats.permutation_test(rows.withColumn("y", F.col("z")), DRAWS)
    return stats.ladder(rows, instrument, stats.stratified_test(rows, ["z"], DRAWS), 20, 0.5, 0.05, 1.2)


_RULES = {"alone": "dom", "second": "case when exp then dom else 0 end", "unmarked": "case when neg then 0 else dom end", "both": "case when exp and not neg then dom else 0 end"}


@query("CAL_03", f"""{_SCORES}, e as (select item_id, max(score) filter (axis = 'domain') as dom, max(score) filter (axis = 'second') as exp from s where slug = 'en' group by 1),
d as (select l.doc_id as id, max(l.quality) = 1 as y, coalesce(max(dom), 0) as dom, coalesce(max(exp) > 0, false) as exp, coalesce(bool_or(contains(lower(text), 'error')), false) as neg
  from labels l left join e on e.item_id = l.doc_id left join documents t using (doc_id) where l.quality is not null group by 1),
n as (select split, d.*, row_number() over (partition by split order by md5('1:' || split || ':' || id), id) <= count(*) over (partition by split) // 2 as fit from d, (select range as split from range(200)) t),
ru as ({' union all '.join(f"select '{k}' as rule, split, fit, y, greatest(0, least(20, ceil(round(({v}) * 20, 6)))) as step from n" for k, v in _RULES.items())}),
c as (select rule, split, fit, step, count(*) filter (y) as pos, count(*) filter (not y) as neg from ru group by all),
tt as (select rule, split, fit, i, coalesce(sum(pos) filter (step > i), 0) as tp, coalesce(sum(neg) filter (step > i), 0) as fp, sum(pos) as whole from c, (select range as i from range(20)) g group by all),
f as (select *, coalesce(tp / nullif(tp + fp, 0)::double, 0) as precision, coalesce(tp / nullif(whole, 0)::double, 0) as recall, coalesce(2 * tp / nullif(tp + fp + whole, 0)::double, 0) as f1 from tt),
b as (select rule, split, i from (select *, row_number() over (partition by rule, split order by f1 desc, i) as k from f where fit) where k = 1)
select f.rule, count(*) as splits, round(avg(f.precision), 6) as precision, round(avg(f.recall), 6) as recall, round(avg(f.f1), 6) as f1 from f join b using (rule, split, i) where not fit group by 1""")  # fmt: skip
def thresholds(spark, sf_dir):
    score = lambda axis: F.max(F.when(F.col("axis") == axis, F.col("score")))
    own = relevance.axis_scores(_items(spark, sf_dir), _weights(spark)).filter("slug = 'en'").groupBy(F.col("item_id").alias("doc_id")).agg(score("domain").alias("dom"), score("second").alias("second"))
    text = star.read(spark, sf_dir, "documents").select("doc_id", F.contains(F.lower("text"), F.lit("error")).alias("neg"))
    rows = star.read(spark, sf_dir, "labels").filter("quality is not null").join(own, "doc_id", "left").join(text, "doc_id", "left").groupBy(F.col("doc_id").alias("id")).agg(
        (F.max("quality") == 1).alias("y"), F.coalesce(F.max("dom"), F.lit(0.0)).alias("dom"), F.coalesce(F.max("second") > 0, F.lit(False)).alias("exp"), F.coalesce(F.bool_or("neg"), F.lit(False)).alias("neg")
    )
    return trends.chosen_thresholds(rows, {name: F.expr(rule) for name, rule in _RULES.items()})


@query("SAM_03", f"""{PRE.replace('relevance <= 0) >= 3)', 'relevance <= 0) >= 1)')} f as (select m.cluster_id, m.channel_id, m.video_id from mv m join ballast b on b.cluster_id = m.cluster_id and b.day = m.day and b.channel_id = m.channel_id
  where m.day = date '{DAYS[1]}' and m.relevance <= 0),
c as (select *, row_number() over (partition by cluster_id, channel_id order by md5('3:' || video_id), video_id) as c from f),
r as (select *, row_number() over (partition by cluster_id order by md5('3:' || video_id), video_id) as round from c where c <= 2),
t as (select *, row_number() over (order by round, cluster_id) as t from r where round <= 15)
select cluster_id, channel_id, video_id, round from t where t <= 60""")  # fmt: skip
def capped(spark, sf_dir):
    """Noise of ballast channels; one decided video makes ballast here, as the given tables have few a channel."""
    w = world(spark, sf_dir, [DAYS[1]])
    w.ballast_decided = 1
    noise = w.member_videos.filter("relevance <= 0").join(w.ballast, ["cluster_id", "day", "channel_id"], "left_semi").select("cluster_id", "channel_id", "video_id")
    return trends.capped_draw(noise, "cluster_id", "channel_id", "video_id", 60, 2, 15, 3)


_TERMS = "select n_name as term, date_trunc('week', o_orderdate)::date as observed_date, count(*)::double as value from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by all"


@query("LEG_05", f"""with w as ({_TERMS}), g as (select term, week::date as observed_date from (select distinct term from w), (select unnest(generate_series(min(observed_date)::timestamp, max(observed_date)::timestamp, interval 7 day)) as week from w)),
s as (select term, observed_date, nullif(value, 0) as v, row_number() over o - 1 as t, count(*) over (partition by term) as n from g left join w using (term, observed_date) window o as (partition by term order by observed_date)),
i as (select *, last_value(v ignore nulls) over (o rows between unbounded preceding and current row) as a, last_value(case when v is not null then t end ignore nulls) over (o rows between unbounded preceding and current row) as ta,
  first_value(v ignore nulls) over (o rows between current row and unbounded following) as b, first_value(case when v is not null then t end ignore nulls) over (o rows between current row and unbounded following) as tb
  from s window o as (partition by term order by t)),
x as (select term, observed_date, t, n - t as k, n, coalesce(v, a + (b - a) * (t - ta) / nullif(tb - ta, 0), a, b, 0) as v from i),
y as (select *, v / nullif(lag(v) over (partition by term order by t), 0) - 1 as move from x),
f as (select term, count(*) as n, sum(v) as total, avg(v) filter (k <= 13) as level, regr_slope(ln(1 + v), t) as slope, avg(v) filter (k > 13 and k <= 26) as before,
  avg(v) filter (case when n >= 104 then k <= 52 else k <= n - n // 2 end) as year, avg(v) filter (case when n >= 104 then k > 52 and k <= 104 else k > n - n // 2 end) as year_before, avg(v) filter (k <= 4) as newest,
  median(v) filter (k > 4 and (k <= 56 or n < 56)) as middle, stddev_samp(v) filter (k > 4 and (k <= 56 or n < 56)) as spread, stddev_samp(move) as volatility from y group by term),
m as (select term, month(observed_date) as month, avg(v) as mean from x group by all), q as (select *, row_number() over (partition by term order by round(mean, 9) desc, month) as k from m),
e as (select term, stddev_samp(mean) / nullif(avg(mean), 0) as season, max(month) filter (k = 1) as peak from q group by 1)
select term, n, case when ok then 'ok' else 'insufficient' end as status, case when ok then round(level, 6) end as level, case when ok then round(slope, 6) end as slope,
  case when ok and n >= 26 and before > 0 then round(level / before - 1, 6) end as momentum, case when ok then round(year / greatest(year_before, 1e-6) - 1, 6) end as yoy, case when ok then round(season, 6) end as season_strength,
  case when ok then peak end as peak_month, case when ok then round((newest - middle) / greatest(spread, 1e-6), 6) end as breakout_z, case when ok then (newest - middle) / greatest(spread, 1e-6) > 2.5 end as breakout,
  case when ok then round(volatility, 6) end as volatility from (select *, n >= 20 and total > 0 as ok from f) join e using (term)""")  # fmt: skip
def trend_features(spark, sf_dir):
    """Weekly orders per nation; weeks without any are points of zero."""
    nation = star.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("term"))
    owner = star.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(F.broadcast(nation), "c_nationkey")
    weekly = star.read(spark, sf_dir, "orders").join(owner, "o_custkey").groupBy("term", F.to_date(F.date_trunc("week", "o_orderdate")).alias("observed_date")).agg(F.count("*").cast("double").alias("value"))
    weeks = weekly.agg(F.min("observed_date").alias("a"), F.max("observed_date").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("observed_date"))
    grid = weekly.select("term").distinct().crossJoin(F.broadcast(weeks))  # weeks are bounded by the calendar
    return trends.trend_features(grid.join(weekly, ["term", "observed_date"], "left"))


@query("LEG_06", """with r as (select p_partkey // 20 as parent, 'query' as kind, p_name || ' ' || p_partkey as value, case when p_size % 5 = 0 then 'Breakout' when p_size % 7 = 0 then null else '+' || (p_size * 150)::bigint || '%' end as growth, p_size from part)
select parent, kind, value, coalesce(growth, '') as growth, coalesce(growth = 'Breakout' or (growth is not null and p_size * 150 >= 5000), false) as breakout from r""")  # fmt: skip
def rising(spark, sf_dir):
    """Lists of twenty entries each, written as JSON and read back."""
    size = F.col("p_size")
    growth = F.when(size % 5 == 0, "Breakout").when(size % 7 != 0, F.concat(F.lit("+"), (size * 150).cast("bigint"), F.lit("%")))
    entry = F.struct(F.concat_ws(" ", "p_name", "p_partkey").alias("query"), growth.alias("value"))
    lists = star.read(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 20).alias("parent"), F.lit("query").alias("kind")).agg(F.to_json(F.collect_list(entry)).alias("body"))
    return trends.rising(lists)
