"""Registered queries of ingestion. The payloads are made by Spark from the orders, customers and pages of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import tables
from ..sources import payloads, raw_store, star
from ..streaming.jobs import folder
from .market import query

AT = "2000-06-30 03:00:00"
_O = "o_orderkey::varchar as video_id, o_custkey::varchar as channel_id"


def _batches(rows: DataFrame, by: Column, item: Column, kind: str, key: Column | None = None) -> DataFrame:
    """Payloads of items; `by` keeps batches to at most some hundred items."""
    made = rows.groupBy(by.alias("__b")).agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("__p"))
    return payloads.land(made, "api", kind, F.col("__b") if key is None else key, F.col("__p"), "run-1", F.lit(AT).cast("timestamp"))


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _video_payloads(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    length = F.when(k % 5 != 0, F.concat(F.lit("PT"), (k % 20).cast("string"), F.lit("M"), (k % 60).cast("string"), F.lit("S")))
    item = F.struct(
        _s("o_orderkey").alias("id"),
        F.struct(
            _s("o_custkey").alias("channelId"), F.concat(F.col("o_orderpriority"), F.when(k % 11 == 0, " #Shorts").otherwise("")).alias("title"),
            F.when(k % 3 != 0, F.when(k % 4 == 0, "Use code A").otherwise("plain")).alias("description"), F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T00:00:00Z")).alias("publishedAt"),
        ).alias("snippet"),
        F.struct(length.alias("duration")).alias("contentDetails"),
        F.struct(F.when(k % 13 != 0, F.floor("o_totalprice").cast("string")).otherwise("n/a").alias("viewCount"), F.when(k % 2 == 0, (k % 100).cast("string")).alias("likeCount")).alias("statistics"),
        F.struct(F.array(F.concat(F.lit("https://topics.example/wiki/"), F.col("o_orderstatus"))).alias("topicCategories")).alias("topicDetails"),
    )
    return _batches(star.read(spark, sf_dir, "orders"), F.floor(k / 200), item, "video")


@query("SRC_01", "select 'video' as kind, count(distinct o_orderkey // 200) as payloads from orders")
def landed(spark, sf_dir):
    return _video_payloads(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("payloads"))


@query("SRC_02", f"""with v as (select *, case when o_orderkey % 5 <> 0 then (o_orderkey % 20) * 60 + o_orderkey % 60 end::bigint as d from orders)
select {_O}, d as duration_s, case when o_orderkey % 11 = 0 then true else d <= 60 end as is_short, d >= 480 as midroll_eligible,
  case when o_orderkey % 3 <> 0 then o_orderkey % 4 = 0 end as sponsor_signal, o_orderstatus as topic, o_orderdate::date as published from v""")  # fmt: skip
def video_rows(spark, sf_dir):
    v = payloads.videos(_video_payloads(spark, sf_dir))
    return v.select("video_id", "channel_id", "duration_s", "is_short", "midroll_eligible", "sponsor_signal", F.col("topics")[0].alias("topic"), F.to_date("published_at").alias("published"))


@query("SRC_05", f"""select {_O}, date '2000-06-30' as observed_date, case when o_orderkey % 13 <> 0 then floor(o_totalprice)::bigint end as views,
  case when o_orderkey % 2 = 0 then o_orderkey % 100 end::bigint as likes, null::bigint as comments from orders""")  # fmt: skip
def reread(spark, sf_dir):
    return payloads.video_readings(_video_payloads(spark, sf_dir))


def _search_payloads(spark, sf_dir, shown: str = "true") -> DataFrame:
    """Search replies over all orders, or those that are shown."""
    k = F.col("o_orderkey")
    rows = star.read(spark, sf_dir, "orders").filter(shown)
    order = F.when(F.col("o_orderstatus") != "O", "date").otherwise("viewCount")
    item = F.struct(F.struct(_s("o_orderkey").alias("videoId")).alias("id"), F.struct(_s("o_custkey").alias("channelId")).alias("snippet"))
    return _batches(rows, F.concat_ws("|", "o_orderpriority", order, F.floor(k / 1000).cast("string")), item, "search")


@query("SRC_03", f"select {_O}, o_orderpriority as query, case when o_orderstatus <> 'O' then 'date' else 'viewCount' end as order_by, date '2000-06-30' as observed_date from orders")
def found(spark, sf_dir):
    return payloads.discoveries(_search_payloads(spark, sf_dir))


@query("SRC_03_stubs", "select o_orderkey::varchar as video_id, min(o_custkey::varchar) as channel_id, false as enriched from orders group by 1")
def found_stubs(spark, sf_dir):
    return payloads.stubs(payloads.discoveries(_search_payloads(spark, sf_dir)))


@query("SRC_06", "select distinct o_orderkey::varchar as video_id, true as enriched from orders where o_orderstatus = 'O'")
def gone(spark, sf_dir):
    """All orders are asked for; replies hold none that is still open."""
    asked = star.read(spark, sf_dir, "orders").select(_s("o_orderkey").alias("video_id"))
    return payloads.missing(asked, payloads.discoveries(_search_payloads(spark, sf_dir, "o_orderstatus <> 'O'")))


@query("SRC_04", """select c_custkey::varchar as channel_id, c_name as title, n_name as country, date '2000-06-30' as observed_date, case when c_acctbal > 0 then floor(c_acctbal)::bigint end as subs,
  c_custkey::bigint * 3 as total_views, null::bigint as video_count from customer left join nation on n_nationkey = c_nationkey""")  # fmt: skip
def channel_rows(spark, sf_dir):
    nation = star.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    item = F.struct(
        _s("c_custkey").alias("id"), F.struct(F.col("c_name").alias("title"), F.col("n_name").alias("country")).alias("snippet"),
        F.struct(
            F.abs(F.floor("c_acctbal")).cast("string").alias("subscriberCount"), (F.col("c_custkey").cast("long") * 3).cast("string").alias("viewCount"), F.lit("many").alias("videoCount"),
            (F.col("c_acctbal") <= 0).alias("hiddenSubscriberCount"),
        ).alias("statistics"),
    )
    rows = star.read(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey", "left")
    return payloads.channels(_batches(rows, F.floor(F.col("c_custkey") / 50), item, "channel"))


@query("SRC_07", """select o_orderkey::varchar as video_id, o_custkey::varchar as channel_id, o_orderpriority as title, case when o_orderkey % 2 = 0 then o_orderstatus end as description,
  case when o_orderkey % 7 <> 0 then floor(o_totalprice)::bigint end as views, null::bigint as likes, date '2000-06-30' as observed_date from orders""")  # fmt: skip
def feeds(spark, sf_dir):
    k = F.col("o_orderkey")
    stats = F.when(k % 7 != 0, F.concat(F.lit('<media:community><media:statistics views="'), F.floor("o_totalprice").cast("string"), F.lit('"/></media:community>'))).otherwise("")
    text = F.when(k % 2 == 0, F.concat(F.lit("<media:description>"), F.col("o_orderstatus"), F.lit("</media:description>"))).otherwise("")
    entry = F.concat(
        F.lit("<entry><yt:videoId>"), _s("o_orderkey"), F.lit("</yt:videoId><yt:channelId>"), _s("o_custkey"), F.lit("</yt:channelId><title>"), F.col("o_orderpriority"),
        F.lit("</title><media:group>"), text, stats, F.lit("</media:group></entry>"),
    )
    space = 'xmlns="http://www.w3.org/2005/Atom" xmlns:yt="urn:yt" xmlns:media="urn:media"'
    made = star.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("__b")).agg(F.concat(F.lit(f"<feed {space}>"), F.array_join(F.collect_list(entry), ""), F.lit("</feed>")).alias("__p"))
    return payloads.feed_entries(payloads.land(made, "feed", "feed", F.col("__b"), F.col("__p"), "run-1", F.lit(AT).cast("timestamp")))


@query("SRC_07_state", """with p as (select user_id as channel_id, ts as "at", case when event_type = 'error' then 500 else 200 end as status from events),
l as (select channel_id, max(case when status = 200 then "at" end) as good, max_by(status, "at") as last_status from p group by 1)
select channel_id, last_status::int as last_status, count(*) filter (good is null or "at" > good) as fail_count from p join l using (channel_id) group by all""")  # fmt: skip
def poll_state(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    return payloads.feed_state(star.read(spark, sf_dir, "events").select(F.col("user_id").alias("channel_id"), F.col("ts").alias("at"), status.alias("status")))


@query("SRC_08", "select o_orderpriority as term, o_orderdate::date as observed_date, count(*)::double as value from orders group by all")
def page_views(spark, sf_dir):
    day = F.concat(F.date_format("observed_date", "yyyyMMdd"), F.lit("00"))
    item = F.struct(F.col("term").alias("article"), day.alias("timestamp"), F.col("value").alias("views"))
    rows = star.demand_snapshots(spark, sf_dir)
    return payloads.page_views(_batches(rows, F.concat_ws("|", "term", F.year("observed_date").cast("string")), item, "pageviews"))


@query("SRC_09", """select o_orderpriority as term, 'US' as geo, o_orderdate::date as day, count(*)::double as value from orders where o_orderpriority <> '5-LOW' group by all""")
def curve_points(spark, sf_dir):
    rows = star.demand_snapshots(spark, sf_dir)
    point = F.struct(F.col("observed_date").cast("string").alias("t"), F.array(F.lit(-1.0), F.col("value")).alias("r"))
    made = rows.groupBy("term").agg(F.array_sort(F.collect_list(point)).alias("p"))
    # the frame of one term doesn't name its column, so it gives no row
    names = F.array(F.lit("other"), F.when(~F.col("term").startswith("5"), F.col("term")).otherwise("unknown"))
    made = made.select(F.concat_ws("|", "term", F.lit("US"), F.lit("all")).alias("__b"), F.to_json(F.struct(names.alias("columns"), F.col("p.t").alias("index"), F.col("p.r").alias("data"))).alias("__p"))
    out = payloads.curves(payloads.land(made, "api", "curve", F.col("__b"), F.col("__p"), "run-1", F.lit(AT).cast("timestamp")))
    return out.select("term", "geo", F.inline("points"))


@query("SRC_14", "select doc_id, case when doc_id % 2 = 0 then 'new' else lang end as label, source from documents")
def curated(spark, sf_dir):
    """Re-applied rows change the label; what was set by hand (here the source) survives."""
    docs = star.read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), "source")
    new = docs.filter("doc_id % 2 = 0").select("doc_id", F.lit("new").alias("label"), F.lit("reset").alias("source"))
    return tables.upsert(docs, new, ["doc_id"], ["label"])


@query("SRC_17", "select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_orderstatus end, 'api') as source, 'run-1' as run_id from orders")
def stamped(spark, sf_dir):
    rows = star.read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("source"))
    return tables.stamp(rows, source="api", run_id="run-1")


@query("SNK_04", """select o_orderkey, o_orderstatus as status, case when o_orderkey % 2 = 0 then o_orderpriority end as priority from orders""")
def mixed_shapes(spark, sf_dir):
    """A sparse row never blanks what a rich one of the same run supplied; an explicit NULL does count."""
    orders = star.read(spark, sf_dir, "orders")
    rich = orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.lit(1).alias("seq"), F.array(F.lit("status"), F.lit("priority")).alias("supplied"))
    null = F.lit(None).cast("string")
    sparse = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", null.alias("status"), null.alias("priority"), F.lit(2).alias("seq"), F.array(F.lit("priority")).alias("supplied"))
    return tables.combine_supplied(rich.unionByName(sparse), ["o_orderkey"], "seq", "supplied")


def _raw_events(spark, sf_dir) -> DataFrame:
    """Events as raw payloads: JSON of what they hold; views come in another layout than VARIANT gives back."""
    body = F.to_json(F.struct("event_id", "user_id", "value"))
    payload = F.when(F.col("event_type") == "view", F.concat(F.lit(" "), body)).otherwise(body)
    return star.read(spark, sf_dir, "events").select(
        F.col("event_id").alias("record"), F.col("event_type").alias("source"), F.lit("event").alias("kind"), F.col("user_id").cast("string").alias("key"), payload.alias("payload"),
        F.lit("run-1").alias("run_id"), F.col("ts").cast("timestamp").alias("at"),
    )


@query("SRC_01_landed", """select event_type as source, ts::date as day, count(*) as records, sum(event_id)::bigint as ids, round(sum(value), 4) as value, true as verbatim from events group by all""")
def landed_events(spark, sf_dir):
    """Payloads are landed by source, kind and day and read from there: fields from the VARIANT, and the text as it came."""
    path, raw = folder(spark), _raw_events(spark, sf_dir)
    raw_store.land(raw, path)
    rows = raw_store.read(spark, path)
    verbatim = F.bool_and(F.sha2("payload", 256) == F.col("sha256"))
    value = F.round(F.sum(raw_store.field("value", "double")), 4)
    return rows.groupBy("source", "day").agg(F.count("*").alias("records"), F.sum(raw_store.field("event_id", "bigint")).alias("ids"), value.alias("value"), verbatim.alias("verbatim"))


@query("SNK_07_store", """select event_id, event_type as source, ts::date as day from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events)
where ts >= timestamp '2024-01-15' or (k = 1 and user_id % 2 = 0)""")  # fmt: skip
def pruned_store(spark, sf_dir):
    path, raw = folder(spark), _raw_events(spark, sf_dir)
    raw_store.land(raw, path)
    raw_store.prune(spark, path, ["event"], "2024-01-15", raw.filter(F.col("key").cast("bigint") % 2 == 0))
    return raw_store.read(spark, path).select(F.col("record").alias("event_id"), "source", "day")


@query("SNK_07", """select event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k, max(ts) over () as m from events)
where ts >= timestamp '2024-01-15' or (k = 1 and user_id % 2 = 0)""")  # fmt: skip
def retained(spark, sf_dir):
    events = star.read(spark, sf_dir, "events").select("event_id", "user_id", F.struct(F.col("ts").cast("timestamp").alias("ts"), "event_id").alias("at"))
    needed = events.filter("user_id % 2 = 0").select("user_id")
    flat = events.withColumn("ts", F.col("at.ts"))
    return tables.retained(flat, needed, "user_id", "at", "2024-01-15", on="ts").select("event_id")
