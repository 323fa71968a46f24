"""What the gate withholds, and rows that follow each other."""

import datetime
import random

from pyspark.sql import functions as F

from marketloom.operators import gates, reads


def test_gate_on_metrics_cards_and_inputs(spark):
    owned = spark.createDataFrame([("a", "event"), ("b", "exposition"), ("c", None), ("d", "unheard")], "cluster_id string, axis string")
    results = spark.createDataFrame([("event", 0.7), ("exposition", 0.4)], "axis string, kappa double")
    gate = gates.axes(owned, results, 0.6)
    assert {r.cluster_id: r.withheld for r in gate.collect()} == {"a": False, "b": True, "c": False, "d": True}
    rows = spark.createDataFrame([(c, n, 1.0, None) for c in "abcde" for n in ("median_views", "weekly_views")], "cluster_id string, name string, value double, reason string")
    got = {(r.cluster_id, r.name): (r.value, r.reason, r.cited) for r in gates.metrics(rows, gate).collect()}
    assert got["b", "median_views"] == (None, "withheld: the exposition rule is not validated", False) and got["d", "median_views"][2] is False
    assert all(got[k] == (1.0, None, True) for k in got if k not in {("b", "median_views"), ("d", "median_views")})
    card = gates.cards(spark.createDataFrame([("a", 0.2, "emerging", 3.0)], "cluster_id string, gap double, stage string, momentum double")).first()
    assert (card.gap, card.stage, card.momentum, card.reason) == (None, None, 3.0, gates.CARD_REASON)
    shown = spark.createDataFrame([(m, c, "i", 0.9, 1) for m in ("on_niche_share", "median_views", "weekly_views") for c in "ab"], "metric string, cluster_id string, input_id string, value double, place int")
    got = {(r.metric, r.cluster_id): (r.value, r.place, r.cited) for r in gates.inputs(shown, gate).collect()}
    assert got["on_niche_share", "b"] == (None, None, False) and got["median_views", "b"] == (0.9, 1, False) and got["weekly_views", "b"] == (0.9, 1, True) and got["on_niche_share", "a"] == (0.9, 1, True)


def test_next_row_across_buckets(spark):
    rng = random.Random(9)
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, rng.choice("ab"), start + datetime.timedelta(minutes=rng.choice([rng.randrange(0, 90), rng.randrange(9000, 9050)]))) for i in range(120)] + [(500, "c", start)]
    df = spark.createDataFrame(rows, "id int, kind string, at timestamp").repartition(5)
    got = {r.id: r.next for r in reads.followed(df, ["kind"], "at", "id", F.date_trunc("hour", "at")).collect()}
    for kind in "abc":
        own = sorted((at, i) for i, k, at in rows if k == kind)
        for (_, i), after in zip(own, [*[a for a, _ in own[1:]], None], strict=True):
            assert got[i] == after
