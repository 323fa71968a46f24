"""Feeds, histories, look-ups, run health and verdicts on a few rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from marketloom.operators import reads, rules


def test_feed_keeps_what_no_query_found(spark):
    videos = spark.sql("select 'a' as cluster_id, date'2024-01-10' as day, v as video_id, v * 10 as channel_id, date_add(date'2024-01-01', v) as published from values (1), (2), (3), (4) t(v)")
    found = spark.sql("select * from values (3, 'q', 'date', date'2024-01-05'), (3, 'p', 'date', date'2024-01-10'), (3, 'z', 'date', date'2024-01-11'), (2, null, null, date'2024-01-01') t(video_id, query, order_by, found)")
    got = [(r.place, r.video_id, r.query) for r in reads.source_feed(videos, found, 4).orderBy("place").collect()]
    assert got == [(1, 4, None), (2, 3, "p"), (3, 3, "q"), (4, 2, None)]


def test_steps_compare_null_definitions(spark):
    rows = spark.sql("select 'a' as c, date_add(date'2024-01-01', d) as day, k as definition from values (0, null), (1, null), (2, 'x'), (3, 'x'), (4, 'y'), (9, null) t(d, k)")
    got = [(r.step, r.was) for r in reads.steps(rows, ["c"]).orderBy("day").collect()]
    assert got == [(False, None), (False, None), (True, None), (False, None), (True, "x"), (True, "y")]


def test_health_names_what_is_wrong(spark):
    runs = spark.sql("""select date(d) as day, s as source, t as status, n as snapshots from values ('2024-01-01', 'a', 'ok', 3), ('2024-01-01', 'b', 'ok', 0), ('2024-01-01', 'b', 'failed', 9),
      ('2024-01-03', 'a', 'ok', 0), ('2024-01-03', 'b', 'ok', null) t(d, s, t, n)""")
    got = {(r.day.day, r.source): r.problem for r in reads.health(runs).collect()}
    assert got == {(1, "b"): "finished failed", (2, "a"): "did not run", (2, "b"): "did not run", (3, "a"): "no snapshots", (3, "b"): "no snapshots"}
    assert reads.health(runs.filter("false")).count() == 0


def test_look_up_by_prefix(spark):
    texts = ["one", "two", None, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    asked = spark.createDataFrame([(hashlib.sha256(t.encode()).hexdigest()[:12],) for t in ("one", "", "none")], "prefix string")
    assert sorted(r.doc_id for r in reads.by_sha_prefix(docs, "t", asked).collect()) == [0, 2, 3]


@pytest.mark.parametrize("plain,held,verdict", [([], [], "inconclusive"), ([(9, 0.5)], [(9, 0.5)], "underpowered"), ([(30, 0.1)], [(30, 0.5)], "fail"), ([(30, 0.5)], [(30, 0.1)], "fail: size"), ([(30, 0.5)], [], "fail: size"), ([(30, 0.5)], [(30, 0.4)], "pass")])
def test_verdict_controls_for_size(spark, plain, held, verdict):
    frame = lambda rows: spark.createDataFrame(rows, "n int, rho double").withColumn("date", F.current_date())
    assert rules.controlled_verdict(frame(plain), frame(held), 20, 0.2).first().verdict == verdict
