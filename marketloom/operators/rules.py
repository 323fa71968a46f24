"""Rules over stored days, alerts and their digest, ballast drift, watch lists and poll targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .world import KEY, World


def _by_day():
    return Window.partitionBy("cluster_id").orderBy("day")


def memberships(world: World, ballast_out: bool) -> DataFrame:
    """Members per cluster and day under one definition, named in each row. The switch is a parameter of the run, not of the clock."""
    rows = (world.member_channels if ballast_out else world.members).groupBy(*KEY).agg(F.count("*").alias("channels"))
    return rows.withColumn("definition", F.lit("v3-non-ballast-members" if ballast_out else "v2-on-niche"))


def ballast_counts(world: World) -> DataFrame:
    """(cluster_id, day, members, ballast)."""
    own = world.members.groupBy(*KEY).agg(F.count("*").alias("members"))
    return own.join(world.ballast.groupBy(*KEY).agg(F.count("*").alias("ballast")), KEY, "left").na.fill(0, ["ballast"])


def definition_steps(counts: DataFrame, share: float) -> DataFrame:
    """Days on which ballast moved by more than `share` of the members since the stored day before."""
    rows = counts.withColumn("was", F.lag("ballast").over(_by_day()))
    return rows.filter(F.abs(F.col("ballast") - F.col("was")) > share * F.col("members")).select(*KEY, "was", "ballast", "members")


def ballast_drift(counts: DataFrame, step: float, ramp: float, days: int, least: int) -> DataFrame:
    """Per cluster and stored day: whether ballast moved by over `step` since the day before, and by over `ramp` over the last
    `days` stored days, of which there are at least `least`."""
    span = _by_day().rowsBetween(-(days - 1), 0)
    rows = counts.withColumns({"was": F.lag("ballast").over(_by_day()), "first": F.first("ballast").over(span), "held": F.count("*").over(span)})
    moved = lambda c, limit: F.coalesce(F.abs(F.col("ballast") - F.col(c)) > limit * F.col("members"), F.lit(False))
    return rows.select(*KEY, moved("was", step).alias("drift"), ((F.col("held") >= least) & moved("first", ramp)).alias("ramp"))


def digest(alerts: DataFrame, shown: int = 3) -> DataFrame:
    """Per severity and rule: alerts and the first clusters by name. One rule fires for each cluster once at most a day, so
    distinct clusters bound what is collected."""
    per = alerts.groupBy("severity", "rule", "cluster_id").agg(F.count("*").alias("n"))
    first = F.array_join(F.slice(F.array_sort(F.collect_list("cluster_id")), 1, shown), ", ")
    return per.groupBy("severity", "rule").agg(F.sum("n").alias("n"), first.alias("clusters"))


def channel_watchlist(channel: DataFrame, readings: DataFrame, since: str, subs: int, cap: int) -> DataFrame:
    """Small channels without a reading since the day, the oldest first; the cap is the feature."""
    read = readings.filter(F.col("observed_date") >= F.lit(since).cast("date")).select("channel_id").distinct()
    due = channel.filter(F.col("subs").between(1, subs)).join(read, "channel_id", "left_anti")
    return due.orderBy("first_seen", "channel_id").limit(cap).select("channel_id", "first_seen")


def backlog(channel: DataFrame, cap: int) -> DataFrame:
    """Channels still without details, the oldest first; the cap is the feature."""
    return channel.filter("subs is null").orderBy("first_seen", "channel_id").limit(cap).select("channel_id", "first_seen")


def poll_targets(channel: DataFrame, state: DataFrame, limit: int = 5) -> DataFrame:
    """(channel_id, fail_count, target, dead). state: channel_id, fail_count, last_status; a channel without state is a target."""
    fails = F.coalesce("fail_count", F.lit(0))
    rows = channel.select("channel_id").join(state, "channel_id", "left").withColumn("fail_count", fails)
    dead = (F.col("fail_count") >= limit) & F.coalesce(F.col("last_status") == 404, F.lit(False))
    return rows.select("channel_id", "fail_count", (F.col("fail_count") < limit).alias("target"), dead.alias("dead"))


def gaps(seeds: DataFrame, lexicons: DataFrame, key: str = "slug") -> DataFrame:
    """Seeds without a lexicon and lexicons without a seed."""
    a, b = seeds.select(key).distinct(), lexicons.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("lacks", F.lit("lexicon")).unionByName(b.join(a, key, "left_anti").withColumn("lacks", F.lit("seed")))


def demand_terms(terms: DataFrame, source: str, stratum: str) -> DataFrame:
    """Active terms of each cluster from one source and stratum."""
    return terms.filter((F.col("source") == source) & (F.col("stratum") == stratum) & F.col("active")).select("cluster_id", "term").distinct()


def subs_growth(members: DataFrame, readings: DataFrame, horizon: int, after: int) -> DataFrame:
    """Per cluster and day: members, those absent at the horizon, mean ln(end / start); end is the earliest non-zero reading
    in [day + horizon, day + horizon + after], the largest across sources; start is the member's subs."""
    r = readings.filter("reach > 0").groupBy("channel_id", "observed_date").agg(F.max("reach").alias("reach"))
    gap = F.datediff("observed_date", "day")
    mine = members.filter("subs > 0").select(*KEY, "channel_id", "subs")
    end = mine.join(r, "channel_id").filter(gap.between(horizon, horizon + after)).groupBy(*KEY, "channel_id").agg(F.min_by("reach", "observed_date").alias("end"))
    rows = mine.join(end, [*KEY, "channel_id"], "left")
    return rows.groupBy(*KEY).agg(F.count("*").alias("members"), F.count_if(F.col("end").isNull()).alias("absent"), F.round(F.avg(F.ln(F.col("end") / F.col("subs"))), 6).alias("growth"))


def verdict(rhos: DataFrame, units: int, least: float) -> DataFrame:
    """One row from (date, n, rho): inconclusive without dates, underpowered with too few units, else pass or fail by the mean."""
    out = rhos.filter("rho is not null").agg(F.count("*").alias("dates"), F.min("n").alias("units"), F.round(F.avg("rho"), 6).alias("mean_rho"))
    says = F.when(F.col("dates") == 0, "inconclusive").when(F.col("units") < units, "underpowered").when(F.col("mean_rho") >= least, "pass").otherwise("fail")
    return out.withColumn("verdict", says)


def controlled_verdict(plain: DataFrame, held: DataFrame, units: int, rho: float) -> DataFrame:
    """One row: dates, units, mean rho, mean rho with size held fixed, and the verdict. plain and held: (date, n, rho).

    What passes must do so with size held fixed too: that big niches grow needs no score."""
    known = plain.filter("rho is not null").agg(F.count("*").alias("dates"), F.min("n").alias("units"), F.round(F.avg("rho"), 6).alias("mean_rho"))
    fixed = held.filter("rho is not null").agg(F.round(F.avg("rho"), 6).alias("held_rho"))
    verdict = (
        F.when(F.col("dates") == 0, "inconclusive").when(F.col("units") < units, "underpowered").when(F.col("mean_rho") < rho, "fail")
        .when(F.coalesce(F.col("held_rho") >= rho, F.lit(False)), "pass").otherwise("fail: size")
    )
    return known.crossJoin(fixed).withColumn("verdict", verdict)  # one row each


def clusters_by_seed(seeds: DataFrame, niche_videos: DataFrame, day: str) -> DataFrame:
    """Of every seed's cluster (cluster_id, seed_active): active while its seed is and a video is on the niche, retired on the day
    otherwise; one that has both again is active again, as nothing of an earlier state is read."""
    live = niche_videos.select("cluster_id", F.lit(True).alias("live")).distinct()
    active = F.coalesce(F.col("seed_active"), F.lit(False)) & F.coalesce(F.col("live"), F.lit(False))
    out = seeds.join(live, "cluster_id", "left")
    return out.select("cluster_id", "seed_active", active.alias("active"), F.when(~active, F.lit(day).cast("date")).alias("retired_on"))


def by_definition(counts: dict[str, DataFrame], switch: str) -> DataFrame:
    """(cluster_id, day, ..., definition): each day's row under the definition that held: "members" before the switch, "ballast" from
    it on."""
    parts = {"members": F.col("day") < F.lit(switch).cast("date"), "ballast": F.col("day") >= F.lit(switch).cast("date")}
    old, new = (counts[name].filter(when).withColumn("definition", F.lit(name)) for name, when in parts.items())
    return old.unionByName(new)


def drift_within(counts: DataFrame, step: float, ramp: float, days: int, least: int) -> DataFrame:
    """counts (cluster_id, day, members, ballast, definition), ballast NULL where the row lacks its stamp: `drift` since the stored day
    before, `ramp` over the last `days` stored ones if there are `least`, both among days of one definition only, and `dropped`:
    the stamp is missing though the day before had it."""
    order = Window.partitionBy("cluster_id", "definition").orderBy("day")
    last = order.rowsBetween(-(days - 1), 0)
    before = F.lag("ballast").over(Window.partitionBy("cluster_id").orderBy("day"))
    rows = counts.withColumns({"was": F.lag("ballast").over(order), "first": F.first("ballast").over(last), "held": F.count("*").over(last), "prior": before})
    far = lambda c, share: F.coalesce(F.abs(F.col("ballast") - F.col(c)) > share * F.col("members"), F.lit(False))
    return rows.select(
        "cluster_id", "day", "definition", far("was", step).alias("drift"), ((F.col("held") >= least) & far("first", ramp)).alias("ramp"),
        (F.col("ballast").isNull() & F.col("prior").isNotNull()).alias("dropped"),
    )


def conditions(parts: dict[str, DataFrame]) -> DataFrame:
    """(condition, fires) from frames of one boolean column and one row each."""
    out = None
    for name, one in parts.items():
        row = one.select(F.lit(name).alias("condition"), F.coalesce(F.col(one.columns[0]), F.lit(False)).alias("fires"))
        out = row if out is None else out.unionByName(row)
    return out

