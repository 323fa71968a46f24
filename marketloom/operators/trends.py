"""Features of periodic curves, expansion of rising queries, choice of thresholds, capped draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A rise from which a query counts as a breakout, in per cent.
BREAKOUT = 5000


def interpolated(series: DataFrame) -> DataFrame:
    """term, observed_date, t (0, 1, ...), k (1 for the newest), n, v: zeros and NULLs lie on the line between their neighbours,
    at the ends they take the nearest value, and without any they are 0."""
    order = Window.partitionBy("term").orderBy("observed_date")
    value = F.nullif("value", F.lit(0.0))
    rows = series.withColumns({"t": F.row_number().over(order) - 1, "n": F.count("*").over(Window.partitionBy("term")), "v": value})
    at = F.when(F.col("v").isNotNull(), F.struct("t", "v"))
    rows = rows.withColumns({
        "a": F.last(at, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), "b": F.first(at, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    line = F.col("a.v") + (F.col("b.v") - F.col("a.v")) * (F.col("t") - F.col("a.t")) / F.nullif(F.col("b.t") - F.col("a.t"), F.lit(0))
    return rows.select("term", "observed_date", "t", (F.col("n") - F.col("t")).alias("k"), "n", F.coalesce("v", line, "a.v", "b.v", F.lit(0.0)).alias("v"))


def trend_features(series: DataFrame) -> DataFrame:
    """Per term of a weekly curve (term, observed_date, value): level, log slope, momentum, change over the year, strength of the
    season and its peak month, breakout and volatility; status tells curves that are too short (under 20) or empty."""
    rows = interpolated(series)
    rows = rows.withColumn("move", F.try_divide(F.col("v"), F.lag("v").over(Window.partitionBy("term").orderBy("t"))) - 1)
    k, n, v = F.col("k"), F.col("n"), F.col("v")
    mean = lambda c: F.avg(F.when(c, v))
    half = F.floor(n / 2)
    trail = F.when(n >= 56, (k > 4) & (k <= 56)).otherwise(k > 4)
    out = rows.groupBy("term").agg(
        F.count("*").alias("n"), F.sum("v").alias("total"), mean(k <= 13).alias("level"), F.regr_slope(F.log1p("v"), F.col("t").cast("double")).alias("slope"),
        mean((k > 13) & (k <= 26)).alias("before"), mean(F.when(n >= 104, k <= 52).otherwise(k <= n - half)).alias("year"),
        mean(F.when(n >= 104, (k > 52) & (k <= 104)).otherwise(k > n - half)).alias("year_before"), mean(k <= 4).alias("newest"),
        F.median(F.when(trail, v)).alias("middle"), F.stddev_samp(F.when(trail, v)).alias("spread"), F.stddev_samp("move").alias("volatility"),
    )
    months = rows.groupBy("term", F.month("observed_date").alias("month")).agg(F.avg("v").alias("mean"))
    season = months.groupBy("term").agg(
        F.try_divide(F.stddev_samp("mean"), F.avg("mean")).alias("season"), F.min_by("month", F.struct(-F.round("mean", 9), "month")).alias("peak_month")
    )
    whole = (F.col("n") >= 20) & (F.col("total") > 0)
    z = (F.col("newest") - F.col("middle")) / F.greatest("spread", F.lit(1e-6))
    show = lambda c, name: F.when(whole, F.round(c, 6)).alias(name)
    return out.join(season, "term").select(
        "term", "n", F.when(whole, "ok").otherwise("insufficient").alias("status"), show(F.col("level"), "level"), show(F.col("slope"), "slope"),
        show(F.when((F.col("n") >= 26) & (F.col("before") > 0), F.col("level") / F.col("before") - 1), "momentum"),
        show(F.col("year") / F.greatest("year_before", F.lit(1e-6)) - 1, "yoy"), show(F.col("season"), "season_strength"), F.when(whole, F.col("peak_month")).alias("peak_month"),
        show(z, "breakout_z"), F.when(whole, z > 2.5).alias("breakout"), show(F.col("volatility"), "volatility"),
    )


def rising(payloads: DataFrame) -> DataFrame:
    """parent, kind, value, growth, breakout: the entries of rising lists. payloads: parent, kind, body (JSON list of query, value)."""
    entries = payloads.select("parent", "kind", F.explode(F.from_json("body", "array<struct<query: string, value: string>>")).alias("e"))
    growth = F.coalesce("e.value", F.lit(""))
    digits = F.regexp_replace(growth, "[%+]", "")
    flag = F.contains(growth, F.lit("Breakout")) | (digits.rlike("^[0-9]+$") & F.coalesce(digits.try_cast("bigint") >= BREAKOUT, F.lit(False)))
    return entries.select("parent", "kind", F.col("e.query").alias("value"), growth.alias("growth"), flag.alias("breakout"))


def chosen_thresholds(rows: DataFrame, rules: dict[str, Column], splits: int = 200, steps: int = 20, seed: int = 1) -> DataFrame:
    """Per rule: mean precision, recall and F1 over random halves, each read at the threshold that is best on the other half.

    rows: id, y and what the rules read. A threshold i / steps takes scores above it; of equally good ones the lowest is chosen.
    Rows are reduced to counts by score step at once, so thresholds multiply nothing."""
    spark = rows.sparkSession
    score = {name: F.greatest(F.lit(0), F.least(F.lit(steps), F.ceil(F.round(rule * steps, 6)))).cast("int") for name, rule in rules.items()}
    every = rows.crossJoin(F.broadcast(spark.range(splits).withColumnRenamed("id", "split")))  # splits are a parameter
    per = Window.partitionBy("split")
    nth = F.row_number().over(per.orderBy(F.md5(F.concat_ws(":", F.lit(seed), "split", "id")), "id"))
    scores = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), step.alias("step")) for name, step in score.items()]))
    every = every.withColumn("fit", nth <= F.floor(F.count("*").over(per) / 2))  # rows are placed before they are taken apart by rule
    every = every.select("split", "y", "fit", scores.alias("s")).select("split", "y", "fit", "s.*")
    counts = every.groupBy("rule", "split", "fit", "step").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    passes = counts.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    above = F.col("step") > F.col("i")
    at = passes.groupBy("rule", "split", "fit", "i").agg(F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"), F.sum("pos").alias("all"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    at = at.withColumns({"precision": zero(F.col("tp"), F.col("tp") + F.col("fp")), "recall": zero(F.col("tp"), F.col("all")), "f1": zero(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("all"))})
    best = at.filter("fit").groupBy("rule", "split").agg(F.min_by("i", F.struct(-F.col("f1"), "i")).alias("i"))
    held = at.filter("not fit").join(best, ["rule", "split", "i"])
    return held.groupBy("rule").agg(F.count("*").alias("splits"), *[F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")])


def capped_draw(rows: DataFrame, by: str, channel: str, key: str, target: int, cap_channel: int, cap: int, seed: int) -> DataFrame:
    """`target` rows in seeded order, spread evenly over strata: at most cap_channel of a channel and cap of a stratum; what one
    stratum lacks goes to the others in turn. The place of a row in its stratum is the round in which it is taken."""
    order = [F.md5(F.concat_ws(":", F.lit(seed), key)), F.col(key)]
    mine = rows.withColumn("__c", F.row_number().over(Window.partitionBy(by, channel).orderBy(*order))).filter(F.col("__c") <= cap_channel)
    mine = mine.withColumn("round", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("round") <= cap).drop("__c")
    return mine.withColumn("__t", F.row_number().over(Window.orderBy("round", by))).filter(F.col("__t") <= target).drop("__t")  # cap rows a stratum
