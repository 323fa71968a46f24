"""Spans and calendars against plain loops over days."""

import datetime
import random

from pyspark.sql import functions as F

from marketloom.operators.world import Calendar, World, in_windows, overtaken, spine, swept

D0 = datetime.date(2020, 1, 1)
day = lambda k: None if k is None else D0 + datetime.timedelta(k)


def _world(rng, n_channels, n_videos):
    channels = [(c, rng.choice("xy"), rng.choice(["FR", "DE", None]), rng.choice([None, 50, 900, 20_000]), day(rng.choice([None, *range(0, 60)]))) for c in range(n_channels)]
    relevance = [None, 0.0, 0.0, 0.3, 0.7]
    quiet = {c for c in range(n_channels) if c % 4 == 0}  # ballast until late
    videos = []
    for v in range(n_videos):
        c, published = rng.randrange(n_channels + 1), rng.choice([None, *range(0, 120)])
        r = rng.choice(relevance[:4] if c in quiet and (published or 0) < 90 else relevance)
        videos.append((v, c, day(published), rng.choice([True, False, False, None]), rng.choice([True, False, None]), r, rng.random() < 0.4))
    readings = [(rng.randrange(n_videos), day(rng.randrange(0, 140)), rng.choice([None, *range(1, 900)])) for _ in range(n_videos * 4)]
    return channels, videos, readings


def _brute(channels, videos, readings, days, ballast, newest):
    out = {k: set() for k in ("members", "ballast", "coverage", "eligible", "views", "date_discovered", "channels")}
    for d in days:
        views = {}
        for v, at, n in readings:
            if n is not None and at <= d:
                views[v] = max(views.get(v, 0), n)
        out["views"] |= {(d, v, n) for v, n in views.items()}
        members = [c for c in channels if c[4] is not None and c[4] <= d]
        out["members"] |= {(d, c[0]) for c in members}
        own = {c[0]: [v for v in videos if v[1] == c[0] and v[2] is not None and v[2] <= d] for c in members}
        on = lambda v: v[5] is not None and v[5] >= 0.55
        off = lambda v: v[5] is not None and v[5] <= 0
        dead = {c for c, vs in own.items() if not any(map(on, vs)) and sum(on(v) or off(v) for v in vs) >= ballast}
        out["ballast"] |= {(d, c) for c in dead}
        for cluster in "xy":
            alive = [c for c in members if c[1] == cluster and c[0] not in dead]
            if alive:
                out["channels"].add((d, cluster, len(alive), sum(c[2] == "FR" for c in alive)))
            vs = [v for c in alive for v in own[c[0]]]
            if vs:
                out["coverage"].add((d, cluster, sum(map(on, vs)), sum(not off(v) for v in vs), sum(on(v) or off(v) for v in vs), len(vs)))
        for c, vs in own.items():
            old = [v for v in vs if v[3] is False and (d - v[2]).days >= 14 and v[0] in views]
            for v in sorted(old, key=lambda v: (-v[2].toordinal(), v[0]))[:newest]:
                out["eligible"].add((d, v[0], views[v[0]]))
            if any(v[6] for v in vs):
                out["date_discovered"].add((d, c))
    return out


def test_populations_against_loops(spark):
    rng = random.Random(5)
    channels, videos, readings = _world(rng, 14, 240)
    days = [day(k) for k in sorted(rng.sample(range(-5, 150), 40))]
    c = spark.createDataFrame(channels, "channel_id int, cluster_id string, country string, subs int, first_seen date")
    v = spark.createDataFrame(videos, "video_id int, channel_id int, published date, is_short boolean, midroll boolean, relevance double, by_date boolean")
    s = spark.createDataFrame(readings, "video_id int, observed_date date, views int")
    w = World(spine(c, [str(d) for d in days]), c, v, s, ballast_decided=4, newest=5)
    want = _brute(channels, videos, readings, days, 4, 5)
    rows = lambda df, *cols: {tuple(r) for r in df.select(*cols).collect()}
    assert rows(w.members, "day", "channel_id") == want["members"]
    assert rows(w.ballast, "day", "channel_id") == want["ballast"] and len(want["ballast"]) > 10
    assert rows(w.member_channels, "day", "channel_id") == want["members"] - want["ballast"]
    assert rows(w.views, "day", "video_id", "views") == want["views"]
    assert rows(w.eligible, "day", "video_id", "views") == want["eligible"] and w.eligible.count() == len(want["eligible"])
    assert rows(w.coverage, "day", "cluster_id", "on_niche", "judgeable", "decided", "total") == want["coverage"]
    assert rows(w.date_discovered, "day", "channel_id") == want["date_discovered"]
    got = rows(w.channel_counts(own=F.col("country") == "FR"), "day", "cluster_id", "total", "own")
    assert got == want["channels"]


def test_calendar_edges(spark):
    spans = spark.createDataFrame([(1, day(3), day(5)), (2, day(-9), None), (3, day(5), day(5)), (4, None, None), (5, day(9), None), (6, day(4), day(99)), (7, day(8), day(4))], "k int, start date, end date")
    days = spark.createDataFrame([(day(3),), (day(4),), (day(4),), (day(8),)], "day date")
    got = {(r.k, (r.day - D0).days) for r in Calendar(days).on(spans).collect()}
    assert got == {(1, 3), (1, 4), (2, 3), (2, 4), (2, 8), (6, 4), (6, 8)}
    assert Calendar(days.filter("false")).on(spans).count() == 0


def test_overtaken_is_the_nth_smallest_before(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(3), i, day(rng.randrange(40))) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, i int, since date")
    for n in (1, 3, 15):
        for r in overtaken(df, ["g"], [F.col("i")], "since", n).collect():
            before = sorted(s for g, i, s in rows if g == r.g and i < r.i)
            assert r.end == (before[n - 1] if len(before) >= n else None)


def test_windows_of_a_series(spark):
    rng = random.Random(7)
    series = [(rng.choice("ab"), day(rng.randrange(100)), rng.choice([None, *map(float, range(9))])) for _ in range(150)]
    days = [day(k) for k in range(0, 120, 7)]
    windows = {0: (2, 10), 1: (12, 10), 2: (0, 90)}
    calendar = Calendar(spark.createDataFrame([(d,) for d in days], "day date"))
    got = {(r.term, r.day, r.w): (r.total, r.points) for r in in_windows(spark.createDataFrame(series, "term string, observed_date date, value double"), ["term"], calendar, windows).collect()}
    want = {}
    for t in "ab":
        for d in days:
            for w, (back, length) in windows.items():
                inside = [v for k, at, v in series if k == t and v is not None and 0 <= (d - at).days - back < length]
                if inside:
                    want[t, d, w] = (sum(inside), len(inside))
    assert got == want


def test_sweep_of_nothing_and_of_spans_that_end(spark):
    spans = spark.createDataFrame([("a", day(1), day(4), True), ("a", day(1), day(2), None), ("b", day(7), None, False)], "g string, start date, end date, f boolean")
    got = {tuple(r) for r in swept(spans, ["g"], f=F.col("f")).collect()}
    assert got == {("a", day(1), day(2), 2, 1), ("a", day(2), day(4), 1, 1), ("b", day(7), None, 1, 0)}
    assert swept(spans.filter("false"), ["g"]).count() == 0


def test_plans_of_a_replay_compare_no_row_with_a_day(spark):
    from marketloom.operators import metrics, scoring

    channels, videos, readings = _world(random.Random(8), 3, 9)
    c = spark.createDataFrame(channels, "channel_id int, cluster_id string, country string, subs int, first_seen date")
    v = spark.createDataFrame(videos, "video_id int, channel_id int, published date, is_short boolean, midroll boolean, relevance double, by_date boolean")
    s = spark.createDataFrame(readings, "video_id int, observed_date date, views int")
    w = World(spine(c, [str(day(k)) for k in range(0, 161 * 7, 7)]), c, v, s)
    series = spark.createDataFrame([("x", day(1), 2.0)], "term string, observed_date date, value double")
    frames = [w.eligible, w.coverage, w.cohort, w.top, metrics.uploads_per_week(w), metrics.change(series, w.spine, 28, "momentum_28d"), metrics.volatility(series, w.spine), scoring.breakouts(series, w.spine)]
    for df in frames:
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
