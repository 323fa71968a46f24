"""Registered queries of stateful streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import jobs
from .further import _stream
from .market import BASE, ORACLES, _breakouts, query
from .more import _weights


@query("STR_04", """with p as (select user_id as channel_id, event_id as poll_id, ts, event_type <> 'error' as ok from events),
g as (select *, sum(ok::int) over (partition by channel_id order by ts, poll_id) as run from p)
select channel_id, poll_id, fail_count, fail_count >= 5 as open from (select channel_id, poll_id, (sum((not ok)::int) over (partition by channel_id, run order by ts, poll_id))::int as fail_count from g)""")  # fmt: skip
def circuit_breaker(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    polls = _stream(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("channel_id"), F.col("event_id").cast("long").alias("poll_id"), at.alias("at"), (F.col("event_type") != "error").alias("ok"))
    return jobs.run(spark, jobs.circuit_breaker, polls, 5).drop("batch")


@query("STR_05", ORACLES["RUL_01_cooled"].replace("select cluster_id, day from c where", "select cluster_id, 'demand_breakout' as rule, day from c where"))
def cooled_alerts(spark, sf_dir):
    """The days on which the rule fires are written as a table and followed as a stream."""
    place = jobs.folder(spark)
    fires = _breakouts(spark, sf_dir).filter("fires").select("cluster_id", F.lit("demand_breakout").alias("rule"), "day")
    fires.write.parquet(place)
    return jobs.run(spark, jobs.cooled_alerts, spark.readStream.schema(fires.schema).parquet(place), 90).drop("batch")


@query("STR_06", f"""with {BASE} d as (select video_id, observed_date, max(views) as views from snap where views is not null group by all),
e as (select video_id, max(observed_date) as observed_date, arg_max(views, observed_date) as v, (arg_max(views, observed_date) - arg_min(views, observed_date)) / nullif(date_diff('day', min(observed_date), max(observed_date)), 0)::double as per_day from d group by 1),
l as (select e.*, (e.v - d.views)::double as last_day from e left join d on d.video_id = e.video_id and d.observed_date = e.observed_date - 1)
select video_id, observed_date, round(per_day, 6) as per_day, last_day, case when last_day <> 0 and per_day > 0 then round(last_day / per_day, 6) end as acceleration from l""")  # fmt: skip
def velocities(spark, sf_dir):
    views = F.when(F.col("l_linenumber") != 7, F.floor("l_extendedprice")).alias("views")
    readings = _stream(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("video_id"), F.to_date("l_shipdate").alias("observed_date"), views).filter("views is not null")
    rows = jobs.run(spark, jobs.velocities, readings)
    newest = rows.groupBy("video_id").agg(F.max_by(F.struct("observed_date", "per_day", "last_day", "acceleration"), "batch").alias("r")).select("video_id", "r.*")
    return newest.withColumns({c: F.round(c, 6) for c in ("per_day", "acceleration")})


@query("STR_01_daily", """with r as (select l_orderkey as video_id, l_shipdate::date as observed_date, l_linenumber as source, l_shipdate::timestamp + to_hours((l_partkey % 24)::int) as t, floor(l_extendedprice)::bigint as views from lineitem),
b as (select * from r union all select video_id, observed_date, source, t + interval 1 hour, views + 1 from r)
select video_id, observed_date, source, arg_min(views, {'t': t, 'views': views}) as views from b group by all""")  # fmt: skip
def daily_first_writes(spark, sf_dir):
    """Every reading comes, and comes again an hour later with another number. The store is cut by month, as a day has few rows."""
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("l_partkey") % 24).cast("int"))
    first = _stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("video_id"), F.to_date("l_shipdate").alias("observed_date"), F.col("l_linenumber").alias("source"), at.alias("at"), F.floor("l_extendedprice").alias("views"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"),
    )
    again = first.withColumns({"at": F.col("at") + F.expr("interval 1 hour"), "views": F.col("views") + 1})
    key = ["video_id", "observed_date", "source"]
    return jobs.run(spark, jobs.daily_first_writes, first.unionByName(again), [*key, "month"], "month", "at", "3650 days").select(*key, "views")


@query("STR_07", ORACLES["REL_06"])
def scored_titles(spark, sf_dir):
    text = F.col("text")
    items = _stream(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item_id"), F.regexp_extract(text, r"^[^\n]*", 0).alias("title"), F.regexp_replace(text, r"\A[^\n]*", "").alias("description")
    )
    return jobs.run(spark, jobs.scored_titles, items, _weights(spark), ("domain", "second")).drop("batch")


