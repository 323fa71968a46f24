"""Rank correlations, permutation tests, bootstrap intervals and regressions on panels, as joins and moments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .draws import drawn_means
from .scoring import average_rank


def pearson(x: str, y: str) -> Column:
    """From moments; NULL below three pairs or where a column is constant."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    n = F.count(F.when(a.isNotNull() & b.isNotNull(), 1))
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    cov = F.covar_pop(a, b)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when((n >= 3) & (spread > 1e-12), cov / F.nullif(spread, F.lit(0.0)))


def spearman(panel: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """by, n, rho."""
    ranked = panel.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({"__a": average_rank(x, by), "__b": average_rank(y, by)})
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), F.round(pearson("__a", "__b"), 6).alias("rho"))


def partial_spearman(panel: DataFrame, by: list[str], x: str = "x", y: str = "y", z: str = "z") -> DataFrame:
    """by, n, rho of x and y with z held fixed; NULL where z explains one of them wholly."""
    full = panel.dropna(subset=[x, y, z]).withColumns({"__a": average_rank(x, by), "__b": average_rank(y, by), "__c": average_rank(z, by)})
    return held_fixed(full, by, "__a", "__b", "__c").select(*by, "n", F.round("rho", 6).alias("rho"))


def held_fixed(rows: DataFrame, by: list[str], x: str, y: str, z: str) -> DataFrame:
    """by, n, rho: correlation of x and y with z held fixed, from three correlations; NULL where z is constant or explains one wholly."""
    r = rows.groupBy(*by).agg(F.count("*").alias("n"), pearson(x, y).alias("xy"), pearson(x, z).alias("xz"), pearson(y, z).alias("yz"))
    rest = (1 - F.col("xz") * F.col("xz")) * (1 - F.col("yz") * F.col("yz"))
    rho = F.when(rest > 1e-12, (F.col("xy") - F.col("xz") * F.col("yz")) / F.sqrt(rest))
    return r.select(*by, "n", rho.alias("rho"))


def relabelled(spark: SparkSession, units: DataFrame, draws: int, seed: int, block: str | None = None) -> DataFrame:
    """(draw, unit, partner[, block]): in every draw a permutation of the units (within blocks), by the order of md5("seed:draw:unit")."""
    by = [block] if block else []
    n = units.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("unit")))
    drawn = units.crossJoin(F.broadcast(spark.range(draws).withColumnRenamed("id", "draw")))  # draws are a parameter
    order = Window.partitionBy("draw", *by).orderBy(F.md5(F.concat_ws(":", F.lit(seed), "draw", "unit")), "unit")
    drawn = drawn.withColumn("place", F.row_number().over(order)).withColumnRenamed("unit", "partner")
    return n.join(drawn, [*by, "place"]).drop("place")


def moved(panel: DataFrame, draws: int, seed: int, block: str | None = None) -> DataFrame:
    """panel once a draw, with y of each unit's partner on the same date; score, block and controls stay with the unit.

    A draw moves outcomes alike on all dates; on dates on which the partner has no row the pair is dropped."""
    by = [block] if block else []
    partners = relabelled(panel.sparkSession, panel.select("unit", *by).distinct(), draws, seed, block)
    return panel.drop("y").join(partners, ["unit", *by]).join(panel.select("date", F.col("unit").alias("partner"), "y"), ["date", "partner"]).drop("partner")


def _tested(real: DataFrame, null: DataFrame) -> DataFrame:
    """One row: dates, rho (mean over dates), draws that have a value, two-sided p = (extreme + 1) / (draws + 1). real: date, rho;
    null: draw, null_rho."""
    mean = real.filter("rho is not null").agg(F.avg("rho").alias("rho"), F.count("*").alias("dates"))
    out = null.crossJoin(F.broadcast(mean)).groupBy("rho", "dates").agg(F.count_if(F.abs("null_rho") >= F.abs("rho") - 1e-9).alias("extreme"), F.count("*").alias("draws"))
    return out.select("dates", F.round("rho", 6).alias("rho"), "draws", F.round((F.col("extreme") + 1) / (F.col("draws") + 1), 6).alias("p"))


def _null(panel: DataFrame, draws: int, seed: int, controls: list[str], block: str | None, rho) -> DataFrame:
    """(draw, null_rho): by matrix products where the panel can be laid out in tasks, else by a join a draw; both the same."""
    by_matrix = drawn_means(panel, draws, seed, controls, block)
    if by_matrix is not None:
        return by_matrix
    return rho(moved(panel, draws, seed, block)).filter("rho is not null").groupBy("draw").agg(F.avg("rho").alias("null_rho"))


def permutation_test(panel: DataFrame, draws: int = 10_000, seed: int = 1) -> DataFrame:
    """Test of the dates' mean Spearman rho; ranks are those among the pairs of a draw. panel: date, unit, x, y."""
    return _tested(spearman(panel, ["date"]), _null(panel, draws, seed, [], None, lambda m: spearman(m, ["draw", "date"])))


def partial_test(panel: DataFrame, draws: int = 10_000, seed: int = 1, z: str = "z") -> DataFrame:
    """The same with z held fixed: outcomes move, score and control stay."""
    return _tested(partial_spearman(panel, ["date"], z=z), _null(panel, draws, seed, [z], None, lambda m: partial_spearman(m, ["draw", "date"], z=z)))


def stratified_test(panel: DataFrame, controls: list[str], draws: int = 10_000, seed: int = 1) -> DataFrame:
    """Test of the mean over dates of stratified_partial: outcomes move within blocks."""
    return _tested(stratified_partial(panel, controls), _null(panel, draws, seed, controls, "block", lambda m: stratified_partial(m, controls, ["draw", "date"])))


def bootstrap(panel: DataFrame, draws: int = 10_000, seed: int = 2, level: float = 0.95) -> DataFrame:
    """One row: low, high, draws: percentile interval of the mean rho over resamples of units, the same at all dates."""
    spark = panel.sparkSession
    units = panel.select("unit").distinct().withColumn("place", F.row_number().over(Window.orderBy("unit")) - 1)
    n = units.count()
    picks = units.select(F.col("place").alias("slot")).crossJoin(F.broadcast(spark.range(draws).withColumnRenamed("id", "draw")))
    number = F.conv(F.left(F.md5(F.concat_ws(":", F.lit(seed), "draw", "slot")), F.lit(8)), 16, 10).cast("long")
    picks = picks.withColumn("place", (number % F.lit(n)).cast("int")).join(F.broadcast(units), "place")
    means = spearman(picks.join(panel, "unit"), ["draw", "date"]).groupBy("draw").agg(F.avg("rho").alias("rho")).filter("rho is not null")
    order = Window.orderBy("rho")
    placed = means.withColumns({"nth": F.row_number().over(order) - 1, "n": F.count("*").over(Window.partitionBy())})
    tail = (1 - level) / 2
    low, high = F.floor(F.col("n") * tail), F.least(F.floor(F.col("n") * (1 - tail)), F.col("n") - 1)
    nth = lambda k: F.round(F.max(F.when(F.col("nth") == k, F.col("rho"))), 6)
    return placed.agg(nth(low).alias("low"), nth(high).alias("high"), F.count("*").alias("draws"))


def power(panel: DataFrame, step: int = 7, horizon: int = 180) -> DataFrame:
    """One row: dates, median_n (the upper middle), detectable_rho, independent_windows."""
    per = panel.filter("x is not null and y is not null").groupBy("date").agg(F.count("*").alias("n"))
    out = per.agg(F.count("*").alias("dates"), F.expr("element_at(sort_array(collect_list(n)), cast(count(*) div 2 as int) + 1)").alias("median_n"))
    return out.select(
        "dates", "median_n", F.round(2 / F.sqrt(F.nullif(F.col("median_n") - 1, F.lit(0))), 6).alias("detectable_rho"),
        (1 + F.floor((F.col("dates") - 1) / -(-horizon // step))).alias("independent_windows"),
    )


def residuals(panel: DataFrame, by: list[str], y: str, controls: list[str]) -> DataFrame:
    """panel with residual: y less its least-squares fit on an intercept and controls, per group; NULL where singular.

    Rows are reduced to cross moments; only those meet in Python."""
    full = panel.dropna(subset=[y, *controls])
    terms = {"one": F.lit(1.0), **{c: F.col(c).cast("double") for c in controls}}
    names = list(terms)
    cross = {f"m_{a}_{b}": F.sum(terms[a] * terms[b]) for i, a in enumerate(names) for b in names[i:]}
    right = {f"r_{a}": F.sum(terms[a] * F.col(y)) for a in names}
    moments = full.groupBy(*by).agg(*[v.alias(k) for k, v in (cross | right).items()])
    k = len(names)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                m = np.array([[row[f"m_{names[min(i, j)]}_{names[max(i, j)]}"] for j in range(k)] for i in range(k)])
                scale = np.sqrt(np.maximum(np.diag(m), 1e-300))
                fit = np.linalg.matrix_rank(m / np.outer(scale, scale), tol=1e-9) == k
                out.append(np.linalg.solve(m, np.array([row[f"r_{n}"] for n in names])) if fit else np.full(k, np.nan))
            coef = pd.DataFrame(out, columns=[f"b_{n}" for n in names], index=pdf.index)
            yield pd.concat([pdf[by], coef], axis=1)

    schema = ", ".join([*(f"`{c}` {dict(panel.dtypes)[c]}" for c in by), *(f"b_{n} double" for n in names)])
    fitted = full.join(moments.mapInPandas(solve, schema), by)
    value = F.col(y) - sum((F.nanvl(F.col(f"b_{n}"), F.lit(None)) * terms[n] for n in names[1:]), F.nanvl(F.col("b_one"), F.lit(None)))
    return fitted.withColumn("residual", F.when(~F.isnan(value), value)).drop(*[f"b_{n}" for n in names])


def stratified_partial(panel: DataFrame, controls: list[str], dates: list[str] | None = None) -> DataFrame:
    """Per date (or the given keys): Spearman of ranks taken within blocks and pooled, x and y taken free of the controls' ranks; NULL below five rows."""
    dates = dates or ["date"]
    by = [*dates, "block"]
    n = F.count("*").over(Window.partitionBy(*by)) + 1
    ranked = panel.dropna(subset=["x", "y", *controls])
    ranked = ranked.withColumns({f"{c}_r": average_rank(c, by) / n for c in ("x", "y", *controls)})
    enough = lambda df: df.select(*dates, "n", F.when(F.col("n") >= 5, F.round("rho", 6)).alias("rho"))
    if len(controls) == 1:  # the same value without a fit
        return enough(held_fixed(ranked, dates, "x_r", "y_r", f"{controls[0]}_r"))
    free = residuals(ranked, dates, "x_r", [f"{c}_r" for c in controls]).withColumnRenamed("residual", "ex")
    free = residuals(free, dates, "y_r", [f"{c}_r" for c in controls]).withColumnRenamed("residual", "ey")
    return enough(free.groupBy(*dates).agg(F.count("*").alias("n"), pearson("ex", "ey").alias("rho")))


def ladder(panel: DataFrame, instrument: DataFrame, primary: DataFrame, units: int, tied: float, p: float, lift: float) -> DataFrame:
    """One row: the verdict's inputs and verdict. Steps in order: enough units a date, few outcomes of zero, an instrument that
    tests below p, a primary that does with rho > 0, a lift of the top tenth. instrument and primary: rows of a test."""
    zero = panel.agg(F.round(F.avg((F.col("y") == 0).cast("int")), 6).alias("tied"))
    rows = power(panel).select("median_n").crossJoin(zero).crossJoin(top_decile_lift(panel).select("lift"))
    rows = rows.crossJoin(instrument.select(F.col("p").alias("instrument_p"))).crossJoin(primary.select("rho", "p"))  # all of one row
    step = (
        F.when(F.col("median_n") < units, "underpowered").when(F.col("tied") > tied, "tied").when(F.col("instrument_p") >= p, "instrument")
        .when((F.col("p") >= p) | (F.col("rho") <= 0), "fail: no association").when(F.col("lift") < lift, "fail: no lift").otherwise("pass")
    )
    return rows.withColumn("verdict", step)


def free_of_effects(panel: DataFrame, controls: list[str], effects: tuple[str, ...] = ("block", "date"), y: str = "y") -> DataFrame:
    """panel with residual: y less its least-squares fit on controls and a constant for each value of every effect.

    Rows of any number are reduced to cells of the effects (counts and sums) and cross moments of the controls; the normal
    equations have a line for each control and effect value, some thousands at most, and are solved in the least-norm
    sense, so a control that the effects explain takes nothing. Rows that lack a value are left out; panels may be unbalanced."""
    full = panel.dropna(subset=[y, *controls, *effects])
    value = {c: F.col(c).cast("double") for c in (*controls, y)}
    sums = {f"s{i}": F.sum(v) for i, v in enumerate(value.values())}
    cells = full.groupBy(*effects).agg(F.count("*").alias("n"), *[v.alias(c) for c, v in sums.items()]).toPandas()
    names = list(value)
    cross = full.agg(*[F.sum(value[a] * value[b]).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]).first()
    if cells.empty:
        return full.withColumn("residual", F.lit(None).cast("double"))
    k, codes, levels = len(controls), {}, {}
    for e in effects:
        codes[e], levels[e] = pd.factorize(cells[e])
    begin = dict(zip(effects, np.cumsum([k, *(len(levels[e]) for e in effects)]), strict=False))
    size = k + sum(map(len, levels.values()))
    left, right = np.zeros((size, size)), np.zeros(size)
    left[:k, :k] = [[cross[f"{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]
    right[:k] = [cross[f"{i}_{k}"] for i in range(k)]
    for e in effects:
        at = begin[e] + codes[e]
        np.add.at(right, at, cells[f"s{k}"])
        for i in range(k):
            np.add.at(left[i], at, cells[f"s{i}"])
            np.add.at(left[:, i], at, cells[f"s{i}"])
        for other in effects:
            np.add.at(left, (at, begin[other] + codes[other]), cells["n"])
    scale = np.sqrt(np.maximum(np.diag(left), 1e-300))
    beta = np.linalg.lstsq(left / np.outer(scale, scale), right / scale, rcond=1e-10)[0] / scale
    out, fit = full, sum((float(b) * value[c] for c, b in zip(controls, beta[:k], strict=True)), F.lit(0.0))
    for e in effects:
        of = pd.DataFrame({"__e": levels[e], f"__b_{e}": beta[begin[e] : begin[e] + len(levels[e])]})
        small = panel.sparkSession.createDataFrame(of).withColumn("__e", F.col("__e").cast(dict(panel.dtypes)[e]))
        out = out.join(F.broadcast(small.withColumnRenamed("__e", e)), e)  # a row for each value of the effect
        fit = fit + F.col(f"__b_{e}")
    return out.withColumn("residual", value[y] - fit).drop(*[f"__b_{e}" for e in effects])


def lift_with_effects(panel: DataFrame, controls: list[str], least: int = 5) -> DataFrame:
    """One row: lift = exp(mean residual over the top tenth of x, one at least, in each date and block; ties by unit), n, rows.

    Residuals are of y on the controls and effects of block and date. lift is NULL below `least` rows."""
    by = ["date", "block"]
    rows = free_of_effects(panel.dropna(subset=["x"]), controls)
    order = Window.partitionBy(*by).orderBy(F.desc("x"), "unit")
    ranked = rows.withColumns({"nth": F.row_number().over(order), "n": F.count("*").over(Window.partitionBy(*by))})
    top = F.col("nth") <= F.ceil(F.col("n") / 10)
    lift = F.exp(F.avg(F.when(top, F.col("residual"))))
    return ranked.agg(F.round(F.when(F.count("*") >= least, lift), 6).alias("lift"), F.count_if(top).alias("n"), F.count("*").alias("rows"))


def top_decile_lift(panel: DataFrame) -> DataFrame:
    """One row: lift = exp(mean of y less its block-and-date mean over the top tenth of x in each block and date), n."""
    by = ["date", "block"]
    order = Window.partitionBy(*by).orderBy(F.desc("x"), "unit")
    whole = Window.partitionBy(*by)
    rows = panel.dropna(subset=["x", "y"]).withColumns({"nth": F.row_number().over(order), "n": F.count("*").over(whole), "rest": F.col("y") - F.avg("y").over(whole)})
    top = rows.filter(F.col("nth") <= F.ceil(F.col("n") / 10))
    return top.agg(F.round(F.exp(F.avg("rest")), 6).alias("lift"), F.count("*").alias("n"))
