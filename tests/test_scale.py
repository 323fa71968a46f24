"""What has to hold so that queries stand larger tables: no texts in shuffles, tables of one or many files, small states."""

import datetime
import os
import random

import pytest

from marketloom.operators import metrics, prototypes, relevance
from marketloom.plans.further import _stream
from marketloom.plans.market import world
from marketloom.streaming import jobs


def test_terms_go_to_the_texts(spark):
    items = spark.createDataFrame([(1, "The notes and the notes of thes"), (2, "and then the"), (3, None), (4, "AND--the")], "item_id int, text string")
    terms = spark.createDataFrame([("notes",), ("and the",), ("the notes",), ("nothing at all",)], "term string")
    found = prototypes.term_matches(items, terms)
    assert sorted(map(tuple, found.collect())) == [(1, "and the"), (1, "notes"), (1, "the notes"), (4, "and the")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    weights = spark.createDataFrame([("a", "domain", "note", 1.0), ("a", "second", "the", 1.0)], "slug string, axis string, term string, weight double")
    titled = items.selectExpr("item_id", "text as title", "'' as description")
    for scored in (relevance.axis_scores(titled, weights), prototypes.prefilter(titled, weights), prototypes.evidence(titled, weights)):
        assert "SortMergeJoin" not in scored._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", [1, 3])
def test_tables_of_one_file_or_many_are_streams(spark, tmp_path, files):
    rows = spark.range(6).withColumnRenamed("id", "doc_id")
    if files == 1:
        rows.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    else:
        rows.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(9).write.parquet(f"{tmp_path}/other.parquet")
    job = _stream(spark, str(tmp_path), "documents").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
    job.start(f"{tmp_path}/out").awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(6))


def test_daily_store_needs_no_state_for_copies(spark, tmp_path):
    schema = "video_id int, day date, at timestamp, views int"
    at = lambda day, hour: datetime.datetime(2024, 1, 1) + datetime.timedelta(day, hours=hour)
    batches = [[(1, 0, 5, 10), (1, 0, 5, 10), (2, 20, 0, 20)], [(1, 0, 5, 10), (3, 9, 0, 30), (3, 11, 0, 31)], [(4, 1, 0, 40), (4, 15, 0, 41)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame([(v, at(d, 0).date(), at(d, h), x) for v, d, h, x in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        jobs.daily_first_writes(source, ["video_id", "day"], "day", "at", "10 days", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    held = {(r.video_id, r.day.day): r.views for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()}
    assert held == {(1, 1): 10, (2, 21): 20, (3, 12): 31, (4, 16): 41}  # days 1, 10 and 2 were closed by day 21
    assert not os.path.exists(f"{tmp_path}/ck/state")


def test_videos_share_a_state(spark, tmp_path):
    """Against a fold of each video's readings; the state holds groups of videos, and goes when all are silent."""
    draw = random.Random(3)
    schema = "video_id long, observed_date date, views long"
    day = lambda k: datetime.date(2024, 1, 1) + datetime.timedelta(k)
    seen, expected = {}, {}
    for n in range(3):
        rows = [(draw.choice([None, *range(1, 40)]), 4 * n + draw.randrange(6), draw.randrange(50)) for _ in range(200)]
        for v, d, x in rows:
            seen.setdefault(v, {})[d] = max(x, seen.get(v, {}).get(d, x))
        for v in {r[0] for r in rows}:
            days = seen[v]
            first, last = min(days), max(days)
            rate = (days[last] - days[first]) / (last - first) if last > first else None
            newest = float(days[last] - days[last - 1]) if last - 1 in days else None
            expected[v, n] = (day(last), rate, newest, newest / rate if newest and rate and rate > 0 else None)
        spark.createDataFrame([(v, day(d), x) for v, d, x in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        jobs.velocities(source, f"{tmp_path}/out", f"{tmp_path}/ck", groups=4).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("batch").collect()
    number = {b: n for n, b in enumerate(sorted({r.batch for r in out if r.video_id is not None}))}
    assert len(out) == len(expected) and {(r.video_id, number[r.batch]): tuple(r)[1:5] for r in out} == expected
    assert spark.read.format("statestore").load(f"{tmp_path}/ck").count() <= 5


def test_populations_of_many_metrics_are_computed_once(spark):
    w = world(spark, "/root/testdata/sf0.001")
    assert all(frame.is_cached for frame in (w.eligible_spans, w.coverage, w.universe))
    for made in (metrics.median_views(w), metrics.midroll_share(w)):
        assert "InMemoryTableScan" in made._jdf.queryExecution().executedPlan().toString()
