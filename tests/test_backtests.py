"""Versions of a store, and loads into it."""

import pytest
from pyspark.sql import functions as F

from marketloom.operators import backtest
from marketloom.plans import backtests
from marketloom.sources import versions

DIR = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = f"{tmp_path}/backtest"
    a, b = spark.range(5).toDF("x"), spark.range(3).toDF("y")
    assert versions.newest(spark, path) == 0 and versions.read(spark, path) == {}
    assert versions.commit(spark, path, {"a": a, "b": b}) == 1
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("y"))
    with pytest.raises(Exception, match="lost"):  # killed after the first table
        versions.commit(spark, path, {"a": a.filter("x > 2"), "b": broken})
    assert versions.newest(spark, path) == 1 and versions.read(spark, path)["a"].count() == 5
    assert versions.commit(spark, path, {"b": b.filter("y = 0")}) == 2
    now = versions.read(spark, path)
    assert now["a"].count() == 5 and now["b"].count() == 1  # a stays, from version 1
    with pytest.raises(versions.Taken):  # begun from version 1, committed too late
        versions.commit(spark, path, {"a": a}, onto=1)
    assert versions.read(spark, path)["b"].count() == 1 and versions.read(spark, path, 1)["b"].count() == 3


def test_the_live_location_is_refused(spark):
    for path, live in (("/data/live", None), ("/data/live/backtest", "/data/live"), ("/data/backtest", "/data/backtest/live")):
        with pytest.raises(ValueError, match="refusing"):
            versions.refuse_live(path, live)
    versions.refuse_live("/data/backtest-2", "/data/live")


def test_load_twice_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/backtest"
    selected, tables = backtests._population(spark, DIR)
    assert backtest.load(spark, path, tables) == 1
    first = {name: _rows(df) for name, df in versions.read(spark, path).items()}
    assert backtest.load(spark, path, tables) == 2
    assert {name: _rows(df) for name, df in versions.read(spark, path).items()} == first
    for name, key in backtest.KEYS.items():
        df = versions.read(spark, path)[name]
        assert df.count() == df.select(*key).distinct().count() > 0, name


def test_population_of_a_few_rows(spark):
    hits = [(1, 10, "a", 0.9), (2, 10, "a", 0.7), (2, 10, "b", 0.8), (3, 10, "b", 0.6), (4, 11, "a", 0.6), (5, 11, "a", 0.6), (5, 11, "a", 0.95), (None, 11, "a", 1.0), (6, 12, "b", 0.9), (7, None, "a", 0.9), (8, None, "a", 0.9)]
    hits = spark.createDataFrame([(*h, None) for h in hits], "video_id int, channel_id int, slug string, relevance double, published date")
    selected = backtest.owners(hits, 2, 2)
    assert _rows(selected) == [(10, "a"), (11, "a")]  # 10: two hits each, first slug; 12: too few; b: too few channels
    channels = spark.createDataFrame([(10, "ten", None), (12, "twelve", None)], "channel_id int, title string, join_date date")
    weekly = spark.sql("select * from values (10, date'2018-02-04', 3, 100), (10, date'2018-01-28', 2, null), (10, date'2018-01-28', 2, 90), (12, date'2018-01-28', 2, 5) t(channel_id, week, videos, subs)")
    catalogue = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "slug string, label string")
    terms = spark.createDataFrame([("a", "t"), ("c", "u")], "slug string, term string")
    t = backtest.population(selected, hits, channels, weekly, catalogue, terms, "2020-01-01", "2019-09-09")
    assert [r.slug for r in t["niche_seeds"].orderBy("slug").collect()] == ["a", "b", "c"] and t["seed_terms"].count() == 2
    assert [(r.channel_id, str(r.first_seen)) for r in t["channels"].collect()] == [(10, "2018-01-28")]
    assert sorted((r.video_id, r.channel_id) for r in t["videos"].collect()) == [(1, 10), (2, 10), (4, 11), (5, 11)]
    members = {(r.item_type, r.item_id): (r.cluster_id, r.relevance) for r in t["cluster_members"].collect()}
    assert members["video", "5"] == ("a", 0.95) and members["channel", "11"] == ("a", None) and len(members) == 6
    assert {r.what: r.rows for r in backtest.report(t, selected).collect()}["channels_without_metadata"] == 1
