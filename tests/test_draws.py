"""Draws by matrix products against draws by joins."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import draws, stats

DAY = datetime.date(2024, 1, 1)


def _panel(spark, missing, null, seed=4):
    rng = random.Random(seed)
    rows = []
    for d in range(5):
        for u in range(15):
            if rng.random() >= (missing if d % 2 else 0):  # even dates are whole
                x = rng.choice([1.0, 2.0, rng.random() * 3])
                hole = d % 2 and rng.random() < null
                rows.append((DAY + datetime.timedelta(d), f"u{u}", "ab"[u % 2], x, None if hole else x + rng.random() * 3, rng.random(), rng.choice([0.0, 1.0, 2.0])))
    return spark.createDataFrame(rows, "date date, unit string, block string, x double, y double, z double, w double")


@pytest.mark.parametrize("missing,null", [(0, 0), (0.3, 0.2)])
def test_products_equal_joins(spark, missing, null):
    panel = _panel(spark, missing, null).cache()
    n = 60
    by = ["draw", "date"]
    cases = {
        "plain": ([], None, lambda m: stats.spearman(m, by)), "partial": (["z"], None, lambda m: stats.partial_spearman(m, by)),
        "strata": (["z"], "block", lambda m: stats.stratified_partial(m, ["z"], by)), "two controls": (["z", "w"], "block", lambda m: stats.stratified_partial(m, ["z", "w"], by)),
    }
    for name, (controls, block, rho) in cases.items():
        got = {r.draw: r.null_rho for r in draws.drawn_means(panel, n, 7, controls, block).collect()}
        joined = rho(stats.moved(panel, n, 7, block)).filter("rho is not null").groupBy("draw").agg(F.avg("rho").alias("r"))
        want = {r.draw: r.r for r in joined.collect()}
        assert got.keys() == want.keys() and len(got) == n, name
        assert max(abs(got[d] - want[d]) for d in want) < 2e-6, name


def test_panels_that_cannot_be_laid_out(spark, monkeypatch):
    panel = _panel(spark, 0.2, 0.1)
    assert draws.laid_out(panel.unionByName(panel.limit(1)), []) is None  # two rows of one unit and date
    assert draws.laid_out(panel.unionByName(panel.limit(1).withColumns({"block": F.lit("c"), "date": F.lit("2030-01-01").cast("date")})), [], "block") is None
    assert draws.laid_out(panel.filter("false"), []) is None
    whole = stats.permutation_test(panel, 40).first()
    monkeypatch.setattr(draws, "CELLS", 10)
    assert draws.laid_out(panel, []) is None and stats.permutation_test(panel, 40).first() == whole


def test_ranks_share_places():
    m = np.array([[3.0, 1.0, 3.0, np.nan, 2.0], [5.0, 5.0, 5.0, 5.0, 5.0]])
    assert draws.ranks(m)[0][[0, 1, 2, 4]].tolist() == [3.5, 1, 3.5, 2] and np.isnan(draws.ranks(m)[0][3]) and draws.ranks(m)[1].tolist() == [3.0] * 5
