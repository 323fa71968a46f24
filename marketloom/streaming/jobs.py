"""Structured Streaming jobs over append-only readings."""

from __future__ import annotations

import datetime
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..operators import relevance
from ..operators.tables import first_writes


def folder(spark: SparkSession) -> str:
    """A new place in the shared folder; a local one only where none is set and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="stream-")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def first_write_wins(readings: DataFrame, key: list[str], at: str, path: str, checkpoint: str):
    """Appends readings whose key is new; durable across restarts, because each batch is held against what is stored."""
    spark = readings.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        new = first_writes(batch, key, [at])
        try:
            stored = spark.read.schema(batch.schema).parquet(path)
            new = new.join(stored.select(*key), key, "left_anti").select(batch.columns)
        except Exception as missing:  # nothing is stored yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
        new.write.mode("append").parquet(path)

    return readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_days(spark: SparkSession, path: str, schema, day: str, batch: DataFrame) -> DataFrame | None:
    """What a store partitioned by day holds of the days that a batch has; other partitions aren't listed for reading. None
    if nothing is stored yet."""
    days = [r[0] for r in batch.select(day).distinct().collect()]  # the days still open to writes
    try:
        return spark.read.schema(schema).parquet(path).filter(F.col(day).isin(days))
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def newest_before(spark: SparkSession, checkpoint: str, number: int) -> datetime.datetime | None:
    """The newest time that the batches before a batch had, as its forerunner left it in the checkpoint."""
    try:
        return spark.read.schema("newest timestamp").parquet(f"{checkpoint}/newest/{number - 1}").first()[0]
    except Exception as missing:  # the first batch
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def daily_first_writes(readings: DataFrame, key: list[str], day: str, at: str, late: str, path: str, checkpoint: str):
    """Appends readings whose key, day included, is new to a store partitioned by day.

    Of the readings of a key in one batch the first by `at` is taken; across batches, restarts and lost checkpoints the stored
    one stays, and for that only the days that the batch holds are read. So copies need no state of their own. A batch that is
    run again adds nothing. Readings `late` or more behind the newest one of the batches before are refused, as their day is
    closed; all that is kept for that is one time a batch, in the checkpoint."""
    spark, columns = readings.sparkSession, readings.columns

    def write(batch: DataFrame, number: int) -> None:
        before = newest_before(spark, checkpoint, number)
        if before is not None:
            batch = batch.filter(F.col(at).isNull() | (F.col(at) > F.lit(before) - F.expr(f"interval {late}")))
        newest = batch.agg(F.greatest(F.max(F.col(at).cast("timestamp")), F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{checkpoint}/newest/{number}")
        new = first_writes(batch, key, [at, *[c for c in columns if c not in (*key, at)]])
        stored = open_days(spark, path, batch.schema, day, batch)
        if stored is not None:
            new = new.join(stored.select(*key), key, "left_anti").select(columns)
        new.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)

    return readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_sums(readings: DataFrame, at: str, key: str, value: str, length: str, slide: str, late: str) -> DataFrame:
    """Sums over sliding windows; a reading is left out if its window had ended by the watermark with which
    the batch before began (Spark lets one batch pass before a new watermark counts for late rows)."""
    return readings.withWatermark(at, late).groupBy(F.window(at, length, slide).alias("w"), key).agg(F.sum(value).alias("total"), F.count("*").alias("n"))


def run_windowed_sums(spark: SparkSession, source: DataFrame, **how: str) -> DataFrame:
    """Runs the job over what is there and returns its windows as last updated. State ends with the watermark."""
    place, key = folder(spark), how["key"]
    job = windowed_sums(source, **how).writeStream.outputMode("update").foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{place}/out"))
    job.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    updates = spark.read.parquet(f"{place}/out").groupBy("w", key)
    return updates.agg(F.max_by("total", "batch").alias("total"), F.max_by("n", "batch").alias("n"))


def on_time(readings: DataFrame, event_day: str, at: str, path: str, checkpoint: str):
    """Splits readings as they come: one whose event day was over when it was taken is late. Both kinds are kept, told apart
    by `late`; a batch that is run again replaces itself."""
    return stored(readings, path, checkpoint, lambda batch: batch.withColumn("late", F.to_date(at) > F.col(event_day)))


def run(spark: SparkSession, job, source: DataFrame, *how) -> DataFrame:
    """Runs a job of this module over what is there and returns what it stored."""
    place = folder(spark)
    job(source, *how, f"{place}/out", f"{place}/state").awaitTermination()
    return spark.read.parquet(f"{place}/out")


def stored(stream: DataFrame, path: str, checkpoint: str, change=lambda batch: batch):
    """Writes each batch, changed, into a folder of its own number, so that a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Where state lives on the executors' disks, in column families with timers.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stateful(groups, processor: StatefulProcessor, schema: str) -> DataFrame:
    groups._df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return groups.transformWithStateInPandas(processor, schema, "Append", "EventTime")


class Forgetting(StatefulProcessor):
    """One value a key that is cleared once the watermark has passed the key's newest row by `keep`, so silent keys cost
    nothing. When that happens depends on batches; what is put out must not, so a subclass tells by event time what is past.

    A subclass gives the state's schema and `step(last, rows)`: the rows of a batch in order, to a new value, the time from
    which it counts, and what is put out."""

    state: str

    def __init__(self, keep: datetime.timedelta, *order: str) -> None:
        self.keep, self.order = keep, list(order)

    def init(self, handle) -> None:
        self.handle, self.value = handle, handle.getValueState("value", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.value.get() if self.value.exists() else None
        value, since, out = self.step(key, last, pd.concat(list(rows)).sort_values(self.order))
        self.value.update(value)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        until = pd.Timestamp(since).tz_localize(None) + self.keep
        self.handle.registerTimer(max(int(until.timestamp() * 1000), timerValues.getCurrentWatermarkInMs() + 1))
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.value.clear()
        return iter(())

    def close(self) -> None:
        pass


class Breaker(Forgetting):
    state = "fails int, seen long"

    def __init__(self, limit: int, keep: datetime.timedelta) -> None:
        super().__init__(keep, "at", "poll_id")
        self.limit = limit

    def step(self, key, last, rows):
        (fails, seen), out = last or (0, None), []
        keep = int(self.keep.total_seconds() * 1_000_000)
        for at, ok in zip(rows["at"].astype("datetime64[us]").astype("int64"), rows["ok"], strict=True):
            fails = 0 if ok else 1 if seen is not None and at - seen > keep else fails + 1
            seen = at
            out.append(fails)
        counted = pd.DataFrame({"channel_id": key[0], "poll_id": rows["poll_id"].to_numpy(), "fail_count": out, "open": [n >= self.limit for n in out]})
        return (fails, int(seen)), rows["at"].max(), counted


def circuit_breaker(polls: DataFrame, limit: int, path: str, checkpoint: str, keep: int = 365, late: str = "30 days"):
    """polls (channel_id, poll_id, at, ok) with fail_count after each poll and whether the channel's circuit is open.

    State is one count a channel; a success resets it, and so does a silence of `keep` days. Polls of a batch are taken in
    order of at and poll_id; one that is over `late` behind the newest is left out."""
    groups = polls.withWatermark("at", late).groupBy("channel_id")
    counted = _stateful(groups, Breaker(limit, datetime.timedelta(keep)), "channel_id long, poll_id long, fail_count int, open boolean")
    return stored(counted, path, checkpoint)


class Cooldown(Forgetting):
    state = "last date"

    def __init__(self, days: int) -> None:
        super().__init__(datetime.timedelta(days), "day")
        self.days = days

    def step(self, key, last, rows):
        last, out = last[0] if last else None, []
        for day in sorted(set(rows["day"])):
            if last is None or (day - last).days >= self.days:
                last = day
                out.append(day)
        return (last,), last, pd.DataFrame({"cluster_id": [key[0]] * len(out), "rule": [key[1]] * len(out), "day": out})


def cooled_alerts(fires: DataFrame, days: int, path: str, checkpoint: str, late: str = "30 days"):
    """Of the days on which a rule fires (cluster_id, rule, day), those that alert: one silences the `days` after it.

    State is the last alert of a cluster and rule, and goes when its silence is over. A day before it that comes late is
    silenced too; one over `late` behind the newest is left out."""
    timed = fires.withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", late).groupBy("cluster_id", "rule")
    return stored(_stateful(timed, Cooldown(days), "cluster_id string, rule string, day date"), path, checkpoint)


_DAY = 86_400_000  # milliseconds


def velocities(readings: DataFrame, path: str, checkpoint: str, keep: int = 3650, late: str = "3650 days", groups: int = 4096):
    """Per video and batch: views a day between the first reading and the last, over the last day, and their ratio.

    readings: video_id, observed_date, views. State holds the first reading, the last and the one of the day before the last;
    of one date the largest counts. A reading that comes after a later one can move the first only, or stand for the day before.
    A video that was silent for more than `keep` days begins anew, and its state goes meanwhile; a reading over `late` behind the
    newest is left out. Videos share a state by the hash of their id, in `groups` of them, so that Python is called once a group
    and works on arrays; the number has to stay as it is while a checkpoint lives."""
    nothing = np.empty((0, 3), "int64")

    def kept(rows: np.ndarray) -> np.ndarray:
        """Of readings (id, day, views), by id and day: the first of each id, the last, and that of the day before the last; of one
        day the largest."""
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        rows = rows[np.r_[(rows[1:, :2] != rows[:-1, :2]).any(axis=1), True]]
        fresh = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
        last = np.r_[fresh[1:], True]
        before = np.r_[last[1:] & ~fresh[1:] & (rows[1:, 1] - rows[:-1, 1] == 1), False]
        return rows[fresh | last | before]

    def ends(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows of each id begin and end, of what kept gives."""
        fresh = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
        return np.flatnonzero(fresh), np.flatnonzero(np.r_[fresh[1:], True])

    def rate(key, frames, state: GroupState):
        held = np.frombuffer(bytes(state.getOption[0]), "int64").reshape(-1, 3) if state.exists else nothing
        if len(held):  # without those that are silent by the watermark
            first, last = ends(held)
            held = held[np.repeat((held[last, 1] + keep) * _DAY >= state.getCurrentWatermarkMs(), last - first + 1)]
        if not state.hasTimedOut:
            new = nothing
            for rows in frames:
                own = np.column_stack([rows[c].fillna(0).to_numpy("int64") for c in ("video_id", "day", "views")])
                new = kept(np.concatenate([new, own]))
            ids, begun = new[ends(new)[0], 0], new[ends(new)[0], 1]
            touched = np.isin(held[:, 0], ids)
            old = held[touched]
            if len(old):
                first, last = ends(old)
                silent = begun[np.searchsorted(ids, old[last, 0])] - old[last, 1] > keep
                old = old[np.repeat(~silent, last - first + 1)]
            new = kept(np.concatenate([old, new]))
            held = np.concatenate([held[~touched], new])
            first, last = ends(new)
            with np.errstate(divide="ignore", invalid="ignore"):
                per_day = (new[last, 2] - new[first, 2]) / np.where(last > first, new[last, 1] - new[first, 1], np.nan)
                newest = np.where((last > first) & (new[last, 1] - new[last - 1, 1] == 1), new[last, 2] - new[last - 1, 2], np.nan)
                speed = np.where((newest != 0) & (per_day > 0), newest / per_day, np.nan)
            ids = pd.array([None] * len(last) if key[1] else new[last, 0], "Int64")
            yield pd.DataFrame({"video_id": ids, "day": new[last, 1].astype("int32"), "per_day": per_day, "last_day": newest, "acceleration": speed})
        if not len(held):
            state.remove()
            return
        held = held[np.argsort(held[:, 0], kind="stable")]
        state.update((held.tobytes(),))
        state.setTimeoutTimestamp(max((int(held[ends(held)[1], 1].min()) + keep) * _DAY, state.getCurrentWatermarkMs() + 1))

    timed = readings.withColumn("at", F.col("observed_date").cast("timestamp")).withWatermark("at", late)
    group = [F.pmod(F.hash("video_id"), F.lit(groups)).alias("share"), F.col("video_id").isNull().alias("unknown")]
    timed = timed.dropna(subset=["observed_date", "views"]).select(*group, "video_id", F.unix_date("observed_date").alias("day"), "views", "at")
    rated = timed.groupBy("share", "unknown").applyInPandasWithState(
        rate, "video_id long, day int, per_day double, last_day double, acceleration double", "held binary", "update", GroupStateTimeout.EventTimeTimeout
    ).select("video_id", F.date_from_unix_date("day").alias("observed_date"), "per_day", "last_day", "acceleration")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rated.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored_titles(items: DataFrame, weights: DataFrame, axes: tuple[str, str], path: str, checkpoint: str):
    """Relevance of incoming items against a static lexicon, one batch at a time."""
    return stored(items, path, checkpoint, lambda batch: relevance.relevance(relevance.axis_scores(batch, weights), axes))
