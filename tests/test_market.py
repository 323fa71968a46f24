"""Hand values and leakage checks of the market operators."""

import datetime as dt
import math

import pytest

from pyspark.sql import functions as F

from marketloom.operators import metrics, outcomes, prototypes, scoring, stats, tables
from marketloom.operators.relevance import axis_scores, lexicon_weights
from marketloom.operators.world import World, running_max, spine
from marketloom.streaming import jobs

DAY = dt.date(2026, 8, 27)


def _series(spark, days, value=100.0, term="a", end=DAY - dt.timedelta(days=2)):
    rows = [(term, end - dt.timedelta(days=i), value) for i in range(days)]
    return spark.createDataFrame(rows, "term string, observed_date date, value double")


def _spine(spark, term="a", day=DAY):
    return spark.createDataFrame([(term, day)], "cluster_id string, day date")


def test_flat_demand(spark):
    row = metrics.weekly_views(_series(spark, 400), _spine(spark)).first()
    assert row.value == 700.0 and row.inputs_n == 28
    assert metrics.change(_series(spark, 400), _spine(spark), 28, "m").first().value == 0.0


def test_half_the_days_halve_confidence(spark):
    row = metrics.weekly_views(_series(spark, 14, 1000.0), _spine(spark)).first()
    assert row.confidence == 0.5


def test_nothing_seen_is_null_not_zero(spark):
    row = metrics.weekly_views(_series(spark, 400), _spine(spark, day=DAY - dt.timedelta(days=3650))).first()
    assert row.value is None and row.confidence == 0.0 and row.inputs_n == 0


def test_average_ranks_and_percentiles(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "i int, v int").withColumn("g", F.lit(1))
    got = {r.i: (r.a, r.p) for r in df.select("i", scoring.average_rank("v", ["g"]).alias("a"), scoring.percentile_rank("v", ["g"]).alias("p")).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4)] == [1.0, 2.5, 2.5, 4.0] and got[2][1] == 0.5


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1, 1.0, float(i)) for i in range(5)], "g int, x double, y double")
    assert df.groupBy("g").agg(stats.pearson("x", "y").alias("r")).first().r is None


def test_permutations_are_permutations(spark):
    units = spark.createDataFrame([(f"u{i}",) for i in range(7)], "unit string")
    got = stats.relabelled(spark, units, 5, 1).collect()
    for d in range(5):
        assert {r.unit for r in got if r.draw == d} == {r.partner for r in got if r.draw == d} == {f"u{i}" for i in range(7)}


def test_growth_of_doubling(spark):
    members = spark.createDataFrame([("a", DAY, 1), ("a", DAY, 2)], "cluster_id string, day date, channel_id int")
    later = DAY + dt.timedelta(days=180)
    readings = spark.createDataFrame([(c, d, s) for c in (1, 2) for d, s in ((DAY, 100), (later, 200))], "channel_id int, observed_date date, subs long")
    row = outcomes.growth(members, readings, 180, 14, 14).first()
    assert math.isclose(row.growth, math.log(2), abs_tol=1e-6) and row.contributing == 2


def test_running_max_intervals(spark):
    d = lambda i: DAY + dt.timedelta(days=i)
    rows = [(1, d(0), 5), (1, d(1), 3), (1, d(2), 9), (1, d(3), None)]
    got = sorted(map(tuple, running_max(spark.createDataFrame(rows, "e int, observed_date date, v int"), "e", "v").collect()))
    assert got == [(1, 5, d(0), d(2)), (1, 9, d(2), None)]


def test_cooldown_is_sequential(spark):
    rows = [("a", DAY + dt.timedelta(days=i)) for i in (0, 10, 30, 40, 60)]
    got = sorted(r.day for r in scoring.cooled(spark.createDataFrame(rows, "cluster_id string, day date"), 28).collect())
    assert got == [DAY, DAY + dt.timedelta(days=30), DAY + dt.timedelta(days=60)]


def test_upsert_and_insert_ignore(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, p string")
    assert sorted(map(tuple, tables.upsert(stored, new, ["k"]).collect()), key=str) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]
    twice = spark.createDataFrame([(2, "n", "1"), (4, "m", "2"), (4, "n", "1")], "k int, p string, q string")
    assert [tuple(r) for r in tables.insert_ignore(stored, twice, ["k"], ["q"]).collect()] == [(4, "n", "1")]


def test_combine_supplied_keeps_explicit_null(spark):
    rows = [(1, 1, "a", "b", ["p", "q"]), (1, 2, None, "z", ["p"])]
    got = tables.combine_supplied(spark.createDataFrame(rows, "k int, seq int, p string, q string, s array<string>"), ["k"], "seq", "s").first()
    assert (got.p, got.q) == (None, "b")


def test_lexicon_weights(spark):
    rows = [("a", "d", "one"), ("a", "d", "two"), ("b", "d", "two"), ("c", "d", "x"), ("a", "d", "all"), ("b", "d", "all"), ("c", "d", "all")]
    got = {(r.slug, r.term): r.weight for r in lexicon_weights(spark.createDataFrame(rows, "slug string, axis string, term string")).collect()}
    assert got["a", "one"] == 1.0 and got["a", "two"] == 0.5 and got["b", "all"] == 0.0
    weights = lexicon_weights(spark.createDataFrame(rows, "slug string, axis string, term string"))
    items = spark.createDataFrame([(1, "Ones two", "one one")], "item_id int, title string, description string")
    assert {r.slug: r.score for r in axis_scores(items, weights).collect()}["a"] == 0.6


def _world(spark, future):
    channel = spark.createDataFrame([(c, "a", "X", 100, DAY - dt.timedelta(days=99)) for c in range(4)], "channel_id long, cluster_id string, country string, subs long, first_seen date")
    video, snap = [], []
    for c in range(4):
        for i in range(6):
            v = c * 10 + i
            video.append((v, c, DAY - dt.timedelta(days=20 + i), False, True, 0.8, True))
            snap.append((v, DAY - dt.timedelta(days=1), 1, 100 * i + 1))
            if future:
                snap.append((v, DAY + dt.timedelta(days=1), 1, 10**6))
                video.append((100 + v, c, DAY + dt.timedelta(days=1 + i), False, True, 0.8, True))
    video = spark.createDataFrame(video, "video_id long, channel_id long, published date, is_short boolean, midroll boolean, relevance double, by_date boolean")
    snap = spark.createDataFrame(snap, "video_id long, observed_date date, source int, views long")
    return World(spine(channel, [DAY.isoformat()]), channel, video, snap, ballast_decided=3, cohort_videos=3)


def test_no_metric_sees_the_future(spark):
    every = [metrics.uploads_per_week, metrics.median_views, metrics.trimmed_mean_views, metrics.on_niche_share, metrics.format_mix, metrics.top10_concentration, metrics.breakthrough_rate, metrics.views_per_sub, metrics.winner_age_years, metrics.midroll_share]
    for m in every:
        assert m(_world(spark, False)).collect() == m(_world(spark, True)).collect(), m.__name__


def test_windowed_sums_leave_out_late_readings(spark, tmp_path):
    for i, rows in enumerate([[("2024-01-10 12:00:00", 1.0)], [("2024-02-20 12:00:00", 2.0)], [("2024-02-20 12:30:00", 16.0)], [("2024-01-11 12:00:00", 4.0), ("2024-02-20 13:00:00", 8.0)]]):
        made = spark.createDataFrame([(t, "k", v) for t, v in rows], "ts string, key string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
        made.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/batch={i}")
    stream = spark.readStream.schema("ts timestamp, key string, value double, batch int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = jobs.run_windowed_sums(spark, stream, at="ts", key="key", value="value", length="1 day", slide="1 day", late="2 days").collect()
    assert {(r.w.start.day, r.total, r.n) for r in out} == {(10, 1.0, 1), (20, 26.0, 3)}


def test_artefacts_are_not_overwritten(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    first = tables.write_artefact(df, f"{tmp_path}/a").first()
    assert first == tables.fingerprint(df.repartition(5)).first() and first != tables.fingerprint(df.filter("id > 0")).first()
    with pytest.raises(Exception, match="exist"):
        tables.write_artefact(df.filter("id > 0"), f"{tmp_path}/a")


def _batches(spark, path, schema, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in/part={i}")
    return spark.readStream.schema(f"{schema}, part int").option("maxFilesPerTrigger", 1).parquet(f"{path}/in").drop("part")


def test_breaker_counts_across_batches(spark, tmp_path):
    at = lambda i: dt.datetime(2026, 1, 1) + dt.timedelta(hours=i)
    polls = [[(1, 10, at(0), False), (1, 11, at(1), False)], [(1, 12, at(2), False), (2, 13, at(2), False), (1, 14, at(3), True)], [(1, 15, at(4), False)]]
    stream = _batches(spark, tmp_path, "channel_id long, poll_id long, at timestamp, ok boolean", polls)
    got = {r.poll_id: (r.fail_count, r.open) for r in jobs.run(spark, jobs.circuit_breaker, stream, 3).collect()}
    assert got == {10: (1, False), 11: (2, False), 12: (3, True), 13: (1, False), 14: (0, False), 15: (1, False)}


def test_cooldown_holds_across_batches(spark, tmp_path):
    day = lambda i: DAY + dt.timedelta(days=i)
    stream = _batches(spark, tmp_path, "cluster_id string, rule string, day date", [[("a", "r", day(10)), ("a", "r", day(0))], [("a", "r", day(27)), ("b", "r", day(27)), ("a", "r", day(28))], [("a", "r", day(5))]])
    got = sorted((r.cluster_id, r.day) for r in jobs.run(spark, jobs.cooled_alerts, stream, 28).collect())
    assert got == [("a", day(0)), ("a", day(28)), ("b", day(27))]


def test_velocity_across_batches(spark, tmp_path):
    day = lambda i: DAY + dt.timedelta(days=i)
    stream = _batches(spark, tmp_path, "video_id long, observed_date date, views long", [[(1, day(0), 100), (1, day(9), 190)], [(1, day(10), 220), (1, day(10), 210), (2, day(3), 5)]])
    rows = jobs.run(spark, jobs.velocities, stream)
    got = {r.video_id: r for r in rows.groupBy("video_id").agg(F.max_by(F.struct("per_day", "last_day", "acceleration"), "batch").alias("r")).select("video_id", "r.*").collect()}
    assert (got[1].per_day, got[1].last_day, got[1].acceleration) == (12.0, 30.0, 2.5) and got[2].per_day is None and got[2].last_day is None


def test_zeros_are_interpolated(spark):
    from marketloom.operators import trends

    rows = [("a", DAY + dt.timedelta(days=7 * i), v) for i, v in enumerate([0.0, 4.0, 0.0, None, 10.0, 0.0])]
    got = trends.interpolated(spark.createDataFrame(rows, "term string, observed_date date, value double")).orderBy("t").collect()
    assert [r.v for r in got] == [4.0, 4.0, 6.0, 8.0, 10.0, 10.0]


def test_capped_draw_gives_shortage_to_others(spark):
    from marketloom.operators import trends

    rows = [("a", 1, i) for i in range(9)] + [("b", 10 + i, 100 + i) for i in range(9)] + [("c", 30 + i, 200 + i) for i in range(9)]
    got = trends.capped_draw(spark.createDataFrame(rows, "d string, channel long, id long"), "d", "channel", "id", 11, 2, 15, 1).groupBy("d").count().collect()
    assert {r.d: r["count"] for r in got} == {"a": 2, "b": 5, "c": 4}


def _features(spark, rows):
    return spark.createDataFrame([(c, DAY, n, v, s) for c, n, v, s in rows], "cluster_id string, day date, name string, value double, confidence double")


def test_cards_and_stages(spark):
    rows = [("a", "s", 10.0, 0.5), ("a", "d", 9.0, 0.9), ("a", "m", 0.1, 0.2), ("b", "s", 20.0, 0.5), ("b", "d", 3.0, 0.4), ("b", "m", -0.1, 1.0), ("c", "s", 30.0, 1.0), ("c", "d", None, 0.0), ("c", "m", 0.5, 1.0)]
    got = {r.cluster_id: r for r in scoring.scorecards(_features(spark, rows), "s", "d", "o", "m", "e").collect()}
    assert (got["a"].supply, got["a"].demand, got["a"].gap, got["a"].gap_confidence, got["a"].stage, got["a"].stage_confidence) == (0.0, 1.0, 1.0, 0.5, "emerging", 0.2)
    assert (got["b"].gap, got["b"].stage, got["b"].reason, got["b"].openness) == (-0.5, "saturated", None, None)
    assert (got["c"].gap, got["c"].gap_confidence, got["c"].stage, got["c"].stage_confidence, got["c"].reason) == (None, None, "unknown", None, "no gap")


def test_pressure_needs_both_metrics(spark):
    rows = [("a", "median_views", 1.0, 0.5), ("a", "uploads_per_week", 5.0, 0.3), ("b", "median_views", 2.0, 0.5), ("b", "uploads_per_week", 7.0, 0.9), ("c", "median_views", 3.0, 1.0), ("c", "uploads_per_week", None, 0.0)]
    got = {r.cluster_id: (r.value, r.confidence, r.inputs_n) for r in metrics.pressure_index(_features(spark, rows)).collect()}
    assert got == {"a": (0.0, 0.3, 2), "b": (0.75, 0.5, 2)}


def test_keyword_metrics_of_a_cluster(spark):
    day = DAY - dt.timedelta(days=60)
    rows = [("a", DAY, "x", day, 100.0, 10, 1.0, 3.0), ("a", DAY, "y", DAY - dt.timedelta(days=90), 10.0, None, None, 9.0), ("a", DAY, "z", day, 0.0, 30, 50.0, None), ("a", DAY, "w", day, 1000.0, 20, None, None)]
    latest = spark.createDataFrame(rows, "cluster_id string, day date, keyword string, observed_date date, volume double, competition int, bid_low double, bid_high double")
    curated = spark.createDataFrame([("a", 8), ("b", 1)], "cluster_id string, curated long")
    grid = spark.createDataFrame([("a", DAY), ("b", DAY)], "cluster_id string, day date")
    got = {(r.cluster_id, r.name): r for r in metrics.keyword_features(latest, curated, grid).collect()}
    values = {n: got["a", n].value for n in metrics.KEYWORD_METRICS}
    assert values == {"total_monthly_searches": 1110.0, "priced_share": 0.75, "competition_index_mean": 20.0, "vw_cpc": round((100 * 2 + 10 * 9) / 110, 6), "median_bid_high": 6.0}
    assert got["a", "vw_cpc"].inputs_n == 2 and got["a", "vw_cpc"].confidence == round(0.5 * 0.5 * 2 / 30, 6)  # the newest reading is 60 days old
    assert got["b", "vw_cpc"].value is None and got["b", "vw_cpc"].reason == "no inputs by the day" and got["b", "vw_cpc"].metric_group == "money"


def test_accents_are_folded_before_words_are_looked_up(spark):
    rows = [(1, "La guérra ESTÁ por là", ""), (2, "u\u0308ber und fu\u0308r", ""), (3, "über and the", ""), (4, "", ""), (5, "123", "")]
    items = spark.createDataFrame(rows, "item_id long, title string, description string")
    got = {r.item_id: r.reason for r in prototypes.gates(items, {"en": ["the", "and"], "es": ["esta", "por"], "de": ["uber", "und", "fur"]}, "en").collect()}
    assert got == {1: "foreign", 2: "foreign", 3: None, 4: "no title", 5: "no letters"}
