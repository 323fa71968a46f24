"""Tables that are rewritten by partition, and residuals of unbalanced panels."""

import datetime
import glob
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import stats, tables
from marketloom.sources import raw_store

day = lambda k: datetime.date(2024, 1, 1) + datetime.timedelta(k)
files = lambda path: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def test_upsert_leaves_other_days_alone(spark, tmp_path):
    path, schema = f"{tmp_path}/features", "cluster string, name string, value int, day date"
    put = lambda *rows: tables.upsert_days(spark.createDataFrame(list(rows), schema), path, ["cluster", "name", "day"], "day")
    held = lambda: {(r.cluster, r.name, r.day): r.value for r in spark.read.parquet(path).collect()}
    put(("a", "m", 1, day(0)), ("a", "n", 2, day(0)), ("a", "m", 3, day(1)), ("b", "m", 4, day(2)))
    before = files(path)
    put(("a", "m", 9, day(1)), ("b", "m", None, day(1)), ("c", "m", 5, day(3)))
    want = {("a", "m", day(0)): 1, ("a", "n", day(0)): 2, ("a", "m", day(1)): 9, ("b", "m", day(1)): None, ("b", "m", day(2)): 4, ("c", "m", day(3)): 5}
    assert held() == want
    after = files(path)
    quiet = {f for f in before if f"day={day(0)}" in f or f"day={day(2)}" in f}
    assert quiet and all(after.get(f) == before[f] for f in quiet) and not any(f in after for f in set(before) - quiet)
    put(("a", "m", 9, day(1)), ("b", "m", None, day(1)))  # the same once more
    assert held() == want and spark.read.parquet(path).count() == len(want)


RAW = "record long, source string, kind string, key string, payload string, run_id string, at timestamp"


def _land(spark, path):
    at = lambda k, hour=0: datetime.datetime.combine(day(k), datetime.time(hour))
    rows = [
        (1, "api", "feed", "a", '{"n":1,"t":"x"}', "r", at(0)), (2, "api", "feed", "b", '{ "n" : 2 }', "r", at(0)), (3, "api", "feed", "a", "<xml/>", "r", at(1)),
        (4, "api", "feed", "b", None, "r", at(2)), (5, "web", "feed", "c", '{"n":5}', "r", at(0, 3)), (6, "api", "page", "a", '{"n":6}', "r", at(0)), (7, "api", "feed", "d", '{"n":7}', "r", at(1)),
    ]
    raw_store.land(spark.createDataFrame(rows, RAW), path)
    return {r[0]: r[4] for r in rows}


def test_payloads_come_back_as_they_were(spark, tmp_path):
    path = f"{tmp_path}/raw"
    want = _land(spark, path)
    rows = raw_store.read(spark, path)
    assert {r.record: r.payload for r in rows.collect()} == want
    assert {r.record for r in rows.filter("text is not null").collect()} == {2, 3}  # all others are given back by the VARIANT
    assert {r.record: r.n for r in rows.select("record", raw_store.field("n", "int").alias("n")).collect()} == {1: 1, 2: 2, 3: None, 4: None, 5: 5, 6: 6, 7: 7}
    plan = rows.filter("kind = 'page' and day = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "page" in plan.split("PartitionFilters")[1].split("]")[0]


def test_prune_touches_old_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/raw"
    _land(spark, path)
    before = files(path)
    needed = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "key string")
    with pytest.raises(raw_store.LastCopy):
        raw_store.prune(spark, path, ["feed"], "2024-01-03", needed, refuse=True)
    assert files(path) == before
    assert raw_store.prune(spark, path, ["feed"], "2024-01-03", needed) == (2, 1)
    assert {r.record for r in raw_store.read(spark, path).collect()} == {3, 4, 5, 6}  # 3 and 5: the last copies of a and c
    after = files(path)
    kept = {f for f in before if "kind=page" in f or "day=2024-01-03" in f}
    assert len(kept) == 2 and all(after[f] == before[f] for f in kept)
    assert raw_store.prune(spark, path, ["feed"], "2024-01-03", needed) == (2, 0)
    assert raw_store.prune(spark, path, ["feed"], "2023-01-01", needed, refuse=True) == (0, 0)


def _panel(rng, n, missing):
    rows = []
    for d in range(6):
        for u in range(n):
            if rng.random() > missing:
                block = "abc"[u % 3]
                z, w = rng.gauss(0, 1) + d, rng.gauss(0, 1)
                rows.append((day(7 * d), f"u{u:02d}", block, rng.choice([rng.random(), 0.5]), 0.4 * z - w + "abc".index(block) + 0.1 * d * d + rng.gauss(0, 0.3), z, w))
    return rows


def test_residuals_of_an_unbalanced_panel(spark):
    rows = _panel(random.Random(3), 20, 0.4)
    df = spark.createDataFrame([*rows, (day(0), "x", "a", 0.1, None, 1.0, 1.0)], "date date, unit string, block string, x double, y double, z double, w double")
    for controls in (["z", "w"], ["z"], []):
        x = np.array([[1.0, *[r[5 + "zw".index(c)] for c in controls], *[float(r[2] == b) for b in "bc"], *[float(r[0] == day(7 * k)) for k in range(1, 6)]] for r in rows])
        y = np.array([r[4] for r in rows])
        want = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        got = {(r.date, r.unit): r.residual for r in stats.free_of_effects(df, controls).collect()}
        assert len(got) == len(rows) and max(abs(got[r[0], r[1]] - v) for r, v in zip(rows, want, strict=True)) < 1e-9
        cells = {}
        for r, v in zip(rows, want, strict=True):
            cells.setdefault((r[0], r[2]), []).append((-r[3], r[1], v))
        top = [v for c in cells.values() for _, _, v in sorted(c)[: max(1, math.ceil(0.1 * len(c)))]]
        lift = stats.lift_with_effects(df, controls).first()
        assert abs(lift.lift - math.exp(np.mean(top))) < 2e-6 and lift.n == len(top) and lift.rows == len(rows)
    # a control that the effects explain takes nothing
    same = stats.free_of_effects(df.withColumn("c", F.dayofyear("date").cast("double")), ["c"]).collect()
    assert max(abs(r.residual - got[r.date, r.unit]) for r in same) < 1e-9
    assert stats.lift_with_effects(df.limit(3), ["z"]).first().lift is None and stats.lift_with_effects(df.filter("false"), ["z"]).first().rows == 0
