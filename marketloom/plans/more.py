"""Registered queries of relevance, table maintenance, outcomes, monitoring, reads and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import outcomes, relevance, tables
from ..operators.world import KEY
from ..sources import star
from ..streaming import jobs
from .market import BASE, CHANNEL_SNAP, DAYS, PRE, query, world

# relevance: lexicons of the languages' frequent words, two axes

LEXICON = {
    ("en", "domain"): ["the", "and", "that", "this", "for"],
    ("en", "second"): ["with", "was", "of", "are", "in"],
    ("de", "domain"): ["der", "die", "das", "und", "von"],
    ("de", "second"): ["den", "zu", "mit", "in", "ist"],
    ("fr", "domain"): ["les", "des", "une", "pour", "que"],
    ("fr", "second"): ["le", "la", "de", "et", "en"],
    ("es", "domain"): ["los", "las", "una", "por", "que"],
    ("es", "second"): ["el", "la", "de", "y", "en"],
}
_ROWS = [(slug, axis, term) for (slug, axis), words in LEXICON.items() for term in words]
_VALUES = ", ".join(f"('{s}', '{a}', '{t}')" for s, a, t in _ROWS)
_SING = "case when {w} like '%es' and length({w}) > 4 then left({w}, length({w}) - 2) when {w} like '%s' and {w} not like '%ss' and length({w}) > 3 then left({w}, length({w}) - 1) else {w} end"
_TOK = "[{s} for w in string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' ') if w <> '']".format(s=_SING.format(w="w"), c="{c}")
_LEX = f"""lex as (select slug, axis, term, case when k = 4 then 0.0 else 1.0::double / k end as weight from (select *, count(*) over (partition by axis, term) as k
  from (values {_VALUES}) t(slug, axis, term)))"""
_SCORES = f"""with {_LEX}, items as (select doc_id as item_id, regexp_extract(text, '^[^\\n]*') as title, regexp_replace(text, '^[^\\n]*', '') as description from documents),
t as (select item_id, list_distinct({_TOK.format(c='title')}) as t, list_distinct({_TOK.format(c='description')}) as d from items),
w as (select item_id, unnest(t) as word, true as titled from t union all select item_id, unnest([x for x in d if not list_contains(t, x)]), false from t),
h as (select item_id, slug, axis, sum(case when titled then weight else 0 end) as t, sum(case when titled then 0 else weight end) as d
  from w join (select *, {_SING.format(w='term')} as word from lex where weight > 0) using (word) group by all),
s as (select item_id, slug, axis, round((2 * least(t, 3) + least(d, 3)) / (2 * least(t, 3) + least(d, 3) + 2), 4) as score from h),
r as (select item_id, slug, round(sqrt(max(score) filter (axis = 'domain') * max(score) filter (axis = 'second')), 4) as relevance from s group by all having count(*) = 2)"""


def _weights(spark):
    return relevance.lexicon_weights(spark.createDataFrame(_ROWS, "slug string, axis string, term string"))


def _items(spark, sf_dir):
    text = F.col("text")
    return star.read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item_id"), F.regexp_extract(text, r"^[^\n]*", 0).alias("title"), F.regexp_replace(text, r"\A[^\n]*", "").alias("description"), "lang"
    )


def _relevance(spark, sf_dir):
    return relevance.relevance(relevance.axis_scores(_items(spark, sf_dir), _weights(spark)), ("domain", "second"))


@query("REL_04", f"{_SCORES} select * from s")
def axis_scores(spark, sf_dir):
    return relevance.axis_scores(_items(spark, sf_dir), _weights(spark))


@query("REL_06", f"{_SCORES} select * from r")
def two_axes(spark, sf_dir):
    return _relevance(spark, sf_dir)


@query("REL_07", f"{_SCORES} select slug, case when relevance >= 0.55 then 'on_niche' when relevance <= 0 then 'noise' else 'undecided' end as band, count(*) as n from r group by all")
def bands(spark, sf_dir):
    return _relevance(spark, sf_dir).groupBy("slug", relevance.band(F.col("relevance")).alias("band")).agg(F.count("*").alias("n"))


@query("REL_09", f"""{_SCORES} select source, lex.slug, count(*) as videos, count(relevance) as scorable, count(*) filter (relevance >= 0.55) as on_niche
from documents d cross join (select distinct slug from lex) left join r on r.item_id = d.doc_id and r.slug = lex.slug group by all""".replace("(select distinct slug from lex)", "(select distinct slug from lex) lex"))  # fmt: skip
def corpus_scan(spark, sf_dir):
    """Per source and lexicon: texts, scorable ones, those on the niche. Counts of texts are taken per source and crossed with the lexicons."""
    own = star.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "source")
    hits = _relevance(spark, sf_dir).join(own, "item_id").groupBy("source", "slug").agg(F.count("*").alias("scorable"), F.count_if(F.col("relevance") >= 0.55).alias("on_niche"))
    slugs = spark.createDataFrame([(s,) for s in sorted({s for s, _ in LEXICON})], "slug string")
    base = own.groupBy("source").agg(F.count("*").alias("videos")).crossJoin(F.broadcast(slugs))
    return base.join(hits, ["source", "slug"], "left").na.fill(0, ["scorable", "on_niche"])


def scored_labels(spark, sf_dir):
    """Every label beside the score of its text by each lexicon, NULL where it has none."""
    mine = _relevance(spark, sf_dir).select("slug", F.col("item_id").alias("doc_id"), F.col("relevance").alias("value"))
    slugs = _weights(spark).select("slug").distinct()  # a few lexicons
    labels = star.read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).crossJoin(F.broadcast(slugs))
    return labels.join(mine, ["slug", "doc_id"], "left")


@query("CAL_01", f"""{_SCORES}, g as (select distinct slug from lex), b as (select g.slug, l.doc_id, l.quality as label, r.relevance as value from labels l cross join g left join r on r.item_id = l.doc_id and r.slug = g.slug),
c as (select slug, ((instr('0123456789abcdef', right(sha256(doc_id::varchar), 1)) - 1) % 2)::int as half, count(*) as n, count(*) filter (value >= 0.55 and label = 1) as tp,
  count(*) filter (value >= 0.55 and label <> 1) as fp, count(*) filter (label = 1 and not coalesce(value >= 0.55, false)) as fn, count(*) filter (value is null) as unscorable, round(avg(label), 6) as base_rate from b group by 1, 2)
select *, round(tp / nullif(tp + fp, 0)::double, 6) as precision, round(tp / nullif(tp + fn, 0)::double, 6) as recall from c""")  # fmt: skip
def calibration(spark, sf_dir):
    return relevance.calibration(scored_labels(spark, sf_dir).withColumnRenamed("doc_id", "id"), "slug")


@query("SAM_01", """select doc_id, source, nth from (select doc_id, source, row_number() over (partition by source order by md5('5:' || doc_id), doc_id) as nth from documents) where nth <= 5""")
def stratified_sample(spark, sf_dir):
    return outcomes.sample(star.read(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 5, 5)


# table maintenance


@query("SNK_01", """select o_orderkey, o_custkey, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice from orders
union all select -o_orderkey, null, 'X', null from orders where o_orderkey % 7 = 0 and o_orderkey > 0""")  # fmt: skip
def upserted(spark, sf_dir):
    orders = star.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = orders.filter("o_orderkey % 3 = 0").select("o_orderkey").union(orders.filter("o_orderkey % 7 = 0 and o_orderkey > 0").select(-F.col("o_orderkey")))
    return tables.upsert(orders, new.withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("SNK_02", """select l_orderkey, l_linenumber, l_shipdate, l_partkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey) as k
from lineitem) where k = 1 and l_orderkey % 2 = 1""")  # fmt: skip
def inserted(spark, sf_dir):
    """Readings of odd orders; those of even orders are stored already."""
    rows = star.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    out = tables.insert_ignore(rows.filter("l_orderkey % 2 = 0"), rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return out.drop("l_suppkey")


@query("SNK_06", "select doc_id, coalesce(case when doc_id % 2 = 0 then lang end, source) as lang from documents")
def filled(spark, sf_dir):
    docs = star.read(spark, sf_dir, "documents")
    stored = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"))
    return tables.fill_nulls(stored, docs.select("doc_id", F.col("source").alias("lang"), F.lit(1).alias("at")), "doc_id", "lang", "at")


@query("SNK_08", "select lang, source, count(*) as n, sum(strlen(text))::bigint as bytes from documents group by all")
def storage(spark, sf_dir):
    return star.read(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))


@query("SNK_03", "select o_orderkey, o_orderdate from orders union all select o_orderkey, o_orderdate from orders where o_orderkey % 2 = 0")
def appended(spark, sf_dir):
    """Two batches that overlap: both are appended as they are."""
    path, orders = jobs.folder(spark), star.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    tables.append(orders, path, "raw_records")
    tables.append(orders.filter("o_orderkey % 2 = 0"), path, "raw_records")
    return spark.read.schema(orders.schema).parquet(path)


@query("SNK_05", "select count(*) as n, sum(o_orderkey)::bigint as total, true as refused from orders")
def guarded(spark, sf_dir):
    """An overwrite of an append-only table is refused and leaves what is stored."""
    path, orders = jobs.folder(spark), star.read(spark, sf_dir, "orders").select("o_orderkey")
    tables.append(orders, path, "discoveries")
    try:
        tables.append(orders.filter("o_orderkey < 0"), path, "discoveries", mode="overwrite")
        refused = False
    except ValueError:
        refused = True
    return spark.read.schema(orders.schema).parquet(path).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"), F.lit(refused).alias("refused"))


query("SNK_10")(lambda spark, sf_dir: tables.write_artefact(star.read(spark, sf_dir, "orders"), jobs.folder(spark)))

# outcomes, cohorts


@query("BTE_05", f"""{PRE} {CHANNEL_SNAP} r as (select channel_id, observed_date, max(subs) as subs from csnap where subs > 0 group by all),
n as (select m.cluster_id, m.day, m.channel_id, r.observed_date, r.subs, r.observed_date > m.day as late from members m join r using (channel_id)
  where r.observed_date between m.day - 60 and m.day or r.observed_date between m.day + 180 and m.day + 270),
e as (select cluster_id, day, channel_id, max_by(subs, observed_date) filter (not late) as a, min_by(subs, observed_date) filter (late) as b from n group by all)
select cluster_id, day, round(median(ln(b / a::double)), 6) as growth, count(*) as contributing from e where a is not null and b is not null group by all""")  # fmt: skip
def growth(spark, sf_dir):
    return outcomes.growth(world(spark, sf_dir).members, star.channel_snapshots(spark, sf_dir), 180, 60, 90).drop("mean_lag")


@query("PRO_01", f"{PRE} x as (select 1) select cluster_id, day, channel_id, round(ln(max_views / median_views), 6) as spike, round(median_views / subs, 6) as per_sub, round(ln(median_views), 6) as ln_median, round(ln(subs), 6) as ln_subs, videos from cohort where median_views > 0")
def cohort(spark, sf_dir):
    return outcomes.frozen_cohort(world(spark, sf_dir))


@query("PRO_03", f"""{PRE} r as (select m.cluster_id, m.day, m.channel_id, v.video_id, date_diff('day', v.published, s.observed_date) as age, max(s.views) as views
  from members m join video v using (channel_id) join snap s on s.video_id = v.video_id where not v.is_short and v.published > m.day and v.published <= m.day + 120 and s.views is not null
  and date_diff('day', v.published, s.observed_date) between 1 and 400 group by all),
q as (select cluster_id, day, channel_id, video_id, min_by(views, age) as views from r group by all)
select cluster_id, day, channel_id, round(avg(ln(1 + views)), 6) as reach, count(*) as read from q group by all""")  # fmt: skip
def next_reach(spark, sf_dir):
    w = world(spark, sf_dir)
    return outcomes.next_reach(w.members, w.video, w.snapshot, 120, 1, 400)


@query("LEG_01", f"""{PRE} o as (select v.channel_id, a.day, a.views, v.published from video v join va a using (video_id) where not is_short and date_diff('day', v.published, a.day) between 30 and 720)
select channel_id, day, count(*) as n, median(views) as median_views, (list_sort(list(views)))[floor(0.9 * (count(*) - 1))::int + 1] as p90,
round(date_diff('day', min(published), max(published)) / nullif(count(*) - 1, 0)::double, 6) as interval from o group by all""")  # fmt: skip
def baseline(spark, sf_dir):
    w = world(spark, sf_dir)
    return outcomes.channel_baseline(w.video, w.views, 30, 720)


@query("LEG_02", f"""with {BASE} d as (select video_id, observed_date, max(views) as views from snap where views is not null group by all),
v as (select video_id, arg_min(views, observed_date) as first_views, arg_max(views, observed_date) as last_views, date_diff('day', min(observed_date), max(observed_date)) as days, max(observed_date) as last from d group by all),
g as (select v.*, (last_views - first_views) / nullif(days, 0)::double as rate, date_diff('day', published, last) as age, (last_views - d.views)::double as last_day
  from v left join video using (video_id) left join d on d.video_id = v.video_id and d.observed_date = v.last - 1)
select video_id, first_views, last_views, days, round(rate, 6) as per_day, case when age > 0 then round(last_views / age::double, 6) end as lifetime, last_day,
  case when last_day <> 0 and rate > 0 then round(last_day / rate, 6) end as acceleration from g""")  # fmt: skip
def velocity(spark, sf_dir):
    return outcomes.velocity(star.video_snapshots(spark, sf_dir), star.videos(spark, sf_dir))


@query("LEG_03", f"""{PRE} e as (select channel_id, day, video_id, views, median(views) over (partition by channel_id, day) as md, count(*) over (partition by channel_id, day) as n from elig)
select channel_id, day, video_id, views, md as median_views from e where n >= 5 and views >= 5 * md""")  # fmt: skip
def feed_breakthroughs(spark, sf_dir):
    e = world(spark, sf_dir).eligible
    per = e.groupBy("channel_id", "day").agg(F.median("views").alias("median_views"), F.count("*").alias("n"))
    return e.join(per, ["channel_id", "day"]).filter("n >= 5 and views >= 5 * median_views").select("channel_id", "day", "video_id", "views", "median_views")


# monitoring and reads


@query("MTR_02", f"with {BASE} d as (select distinct term, observed_date as day from series) select term, unnest(generate_series(min(day)::timestamp, max(day)::timestamp, interval 1 day))::date as day from d group by term except select term, day from d")
def missing(spark, sf_dir):
    return outcomes.missing_days(star.demand_snapshots(spark, sf_dir).select("term", F.col("observed_date").alias("day")), "term")


@query("MTR_07", f"""with {BASE} d as (select observed_date as day, min(value) >= 1 and count(*) = 5 as ok from series group by 1),
g as (select day, day - (row_number() over (order by day))::int as island from d where ok)
select min(day) as first, max(day) as last, count(*) as nights from g group by island""")  # fmt: skip
def streaks(spark, sf_dir):
    days = star.demand_snapshots(spark, sf_dir).groupBy(F.col("observed_date").alias("day")).agg(((F.min("value") >= 1) & (F.count("*") == 5)).alias("ok"))
    return outcomes.ok_streaks(days)


@query("MTR_08", "select ts::date as day, event_type as source, count(*) as runs, round(sum(value), 4) as snapshots from events group by all")
def runs_by_day(spark, sf_dir):
    return star.job_runs(spark, sf_dir).groupBy(F.to_date("started_at").alias("day"), "source").agg(F.count("*").alias("runs"), F.round(F.sum("snapshots"), 4).alias("snapshots"))


@query("QRY_01", f"""{PRE} a as (select cluster_id, count(*) as members from channel group by 1), b as (select cluster_id, count(*) as videos from video join channel using (channel_id) group by 1),
c as (select cluster_id, max(published) as latest from video join channel using (channel_id) where relevance >= 0.55 group by 1) select * from a left join b using (cluster_id) left join c using (cluster_id)""")  # fmt: skip
def niche_list(spark, sf_dir):
    channel, video = star.channels(spark, sf_dir), star.videos(spark, sf_dir)
    per = video.join(channel.select("channel_id", "cluster_id"), "channel_id").groupBy("cluster_id").agg(F.count("*").alias("videos"), F.max(F.when(F.col("relevance") >= 0.55, F.col("published"))).alias("latest"))
    return channel.groupBy("cluster_id").agg(F.count("*").alias("members")).join(per, "cluster_id", "left")


@query("QRY_03", f"with {BASE} x as (select 1) select channel_id, cluster_id, subs, count(video_id) as videos, count(*) filter (relevance >= 0.55) as on_niche from channel left join video using (channel_id) group by all")
def channel_table(spark, sf_dir):
    joined = star.channels(spark, sf_dir).join(star.videos(spark, sf_dir), "channel_id", "left")
    return joined.groupBy("channel_id", "cluster_id", "subs").agg(F.count("video_id").alias("videos"), F.count_if(F.col("relevance") >= 0.55).alias("on_niche"))


@query("QRY_04", f"with {BASE} x as (select 1) select video_id, channel_id, published, by_date from video order by published desc, video_id limit 50")
def source_feed(spark, sf_dir):
    return star.videos(spark, sf_dir).select("video_id", "channel_id", "published", "by_date").orderBy(F.desc("published"), "video_id").limit(50)


@query("QRY_05", f"with {BASE} x as (select 1) select term, observed_date, value, lag(value) over (partition by term order by observed_date) as before from series")
def history(spark, sf_dir):
    return star.demand_snapshots(spark, sf_dir).withColumn("before", F.lag("value").over(Window.partitionBy("term").orderBy("observed_date")))


# streams


@query("STR_03", """select event_type, w as start, count(*) as n, round(sum(value), 4) as total from (select event_type, value, unnest(generate_series(
  date_trunc('day', ts) - interval 6 day, date_trunc('day', ts), interval 1 day)) as w from events) group by all""")  # fmt: skip
def windowed(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    out = jobs.run_windowed_sums(spark, stream, at="ts", key="event_type", value="value", length="7 days", slide="1 day", late="2 days")
    return out.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


__all__ = ["DAYS", "KEY"]
