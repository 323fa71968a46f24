"""Streams across batches and restarts: stored days, state that goes, batches that are run again."""

import datetime

import pytest
from pyspark.sql import functions as F

from marketloom.streaming import jobs

READING = "video_id int, day date, at timestamp, views int"
stamp = lambda day, hour=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(day, hours=hour)


@pytest.fixture
def feed(spark, tmp_path):
    """Rows that are added become one more file of a stream."""

    class Feed:
        def __init__(self, schema):
            self.schema, self.n = schema, 0

        def add(self, *rows):
            spark.createDataFrame(list(rows), self.schema).coalesce(1).write.parquet(f"{tmp_path}/in/{self.schema[:5]}-{self.n}")
            self.n += 1

        def stream(self):
            return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/{self.schema[:5]}-*")

    return Feed


def test_daily_store_across_restarts(spark, feed, tmp_path):
    reading = lambda v, day, hour, views: (v, stamp(day).date(), stamp(day, hour), views)
    f, out = feed(READING), f"{tmp_path}/out"
    go = lambda state: jobs.daily_first_writes(f.stream(), ["video_id", "day"], "day", "at", "10 days", out, f"{tmp_path}/{state}").awaitTermination()
    held = lambda: {(r.video_id, r.day.day): r.views for r in spark.read.schema(READING).parquet(out).collect()}
    f.add(reading(1, 0, 5, 10), reading(1, 0, 2, 9), reading(2, 0, 1, 20), reading(2, 0, 1, 20), reading(1, 1, 0, 11))
    go("a")
    assert held() == {(1, 1): 9, (2, 1): 20, (1, 2): 11}
    f.add(reading(1, 0, 1, 8), reading(1, 0, 5, 10), reading(3, 1, 1, 30))  # late copies of a stored day, a new video
    f.add(reading(2, 3, 0, 21))
    go("a")  # restart with its state
    now = {(1, 1): 9, (2, 1): 20, (1, 2): 11, (3, 2): 30, (2, 4): 21}
    assert held() == now
    go("b")  # restart without state: all files again
    assert held() == now and spark.read.parquet(out).count() == len(now)
    batch = spark.createDataFrame([reading(9, 3, 0, 1)], READING)
    open_days = jobs.open_days(spark, out, batch.schema, "day", batch)
    plan = open_days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-04" in plan.split("PartitionFilters")[1]
    assert {r.day.day for r in open_days.collect()} == {4} and all("day=2024-01-04" in p for p in open_days.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


POLL = "channel_id long, poll_id long, at timestamp, ok boolean"


def test_state_of_a_silent_channel_goes(spark, feed, tmp_path):
    f = feed(POLL)

    def go():
        jobs.circuit_breaker(f.stream(), 3, f"{tmp_path}/out", f"{tmp_path}/state", keep=20, late="1 day").awaitTermination()
        return {r.poll_id: (r.fail_count, r.open) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    f.add((1, 1, stamp(0), False), (1, 2, stamp(0, 1), False), (2, 3, stamp(0), False))
    f.add((1, 4, stamp(5), False), (2, 5, stamp(9), True))
    assert go() == {1: (1, False), 2: (2, False), 3: (1, False), 4: (3, True), 5: (0, False)}
    f.add((2, 6, stamp(24), False))  # channel 1 is silent since day 5; its state ends with day 25
    f.add((2, 7, stamp(40), False))
    go()
    f.add((2, 10, stamp(40, 1), False))
    go()
    state = spark.read.format("statestore").option("stateVarName", "value").load(f"{tmp_path}/state")
    assert {r.key.channel_id for r in state.collect()} == {2}
    f.add((1, 8, stamp(41), False), (2, 9, stamp(41), False))
    got = go()
    assert got[7] == (2, False) and got[9] == (4, True)
    assert got[8] == (1, False)  # not the fourth


def test_cooldown_ends_and_its_state_goes(spark, feed, tmp_path):
    f = feed("cluster_id string, rule string, day date")
    day = lambda k: stamp(k).date()
    f.add(*[("a", "r", day(k)) for k in (0, 5, 27)], ("b", "r", day(3)))
    f.add(("a", "r", day(28)), ("b", "r", day(30)))
    f.add(("a", "r", day(60)), ("b", "r", day(100)))
    f.add(("a", "r", day(99)), ("a", "r", day(126)), ("b", "r", day(127)))
    jobs.cooled_alerts(f.stream(), 28, f"{tmp_path}/out", f"{tmp_path}/state", late="2 days").awaitTermination()
    got = sorted((r.cluster_id, (r.day - day(0)).days) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", 0), ("a", 28), ("a", 60), ("a", 99), ("b", 3), ("b", 100)]


def test_velocities_forget_silent_videos(spark, feed, tmp_path):
    f = feed("video_id long, observed_date date, views long")
    day = lambda k: stamp(k).date()
    f.add((1, day(0), 100), (1, day(2), 140), (2, day(2), 5))
    f.add((1, day(3), 200), (2, day(40), 50))
    f.add((2, day(90), 80))
    f.add((1, day(91), 900), (2, day(91), 90))
    jobs.velocities(f.stream(), f"{tmp_path}/out", f"{tmp_path}/state", keep=60, late="5 days").awaitTermination()
    rows = {(r.video_id, (r.observed_date - day(0)).days): (r.per_day, r.last_day) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert rows[1, 3][1] == 60.0 and abs(rows[1, 3][0] - 100 / 3) < 1e-9
    assert rows[1, 91] == (None, None)  # its first reading is forgotten
    assert rows[2, 91] == ((90 - 5) / 89, 10.0)


def test_late_readings_are_written_once(spark, feed, tmp_path):
    f = feed("event_id int, event_day date, at timestamp")
    f.add((1, stamp(0).date(), stamp(0, 5)), (2, stamp(0).date(), stamp(1, 1)))
    for state in ("a", "b"):  # the second run is the first batch once more
        jobs.on_time(f.stream(), "event_day", "at", f"{tmp_path}/out", f"{tmp_path}/{state}").awaitTermination()
    assert sorted((r.event_id, r.late) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, False), (2, True)]
