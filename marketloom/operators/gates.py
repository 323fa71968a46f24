"""What may be cited: values that rest on a relevance rule nobody has validated are withheld, with the reason in their place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The metrics that read a relevance decision.
SCORER_DEPENDENT = [
    "uploads_per_week", "median_views", "trimmed_mean_views", "on_niche_share", "geo_concentration", "format_mix", "top10_concentration", "pressure_index",
    "midroll_eligible_share", "winner_age_years",
]
#: The fields of a card that are made of such metrics; they stand or fall together.
CARD_FIELDS = ["gap", "gap_confidence", "supply", "demand", "stage", "stage_confidence", "openness"]
#: Inputs of these metrics are ordered by, or show, a video's relevance.
SHOWS_RELEVANCE = ["on_niche_share"]
CARD_REASON = "withheld: cards rest on a score that was tested and not supported"


def axes(owned: DataFrame, results: DataFrame, bar: float) -> DataFrame:
    """(cluster_id, axis, withheld): owned (cluster_id, axis) with whether the axis lacks a result (axis, kappa) that reaches
    the bar. A cluster without an axis has nothing scored, and nothing withheld. One row a cluster."""
    known = owned.join(results, "axis", "left")
    return known.select("cluster_id", "axis", (F.col("axis").isNotNull() & ~F.coalesce(F.col("kappa") >= bar, F.lit(False))).alias("withheld"))


def reason(axis: str = "axis") -> Column:
    return F.concat(F.lit("withheld: the "), F.col(axis), F.lit(" rule is not validated"))


def metrics(rows: DataFrame, gate: DataFrame) -> DataFrame:
    """Metric rows (cluster_id, name, value, reason) with withheld values NULL and the gate's reason in place of theirs."""
    out = rows.join(gate, "cluster_id", "left")
    held = F.coalesce("withheld", F.lit(False)) & F.col("name").isin(SCORER_DEPENDENT)
    return out.withColumns({"value": F.when(~held, F.col("value")), "reason": F.when(held, reason()).otherwise(F.col("reason")), "cited": ~held}).drop("axis", "withheld")


def cards(rows: DataFrame) -> DataFrame:
    """Cards with every field of the score withheld, on any axis: showing one side would give the other away."""
    kind = dict(rows.dtypes)
    gone = {c: F.lit(None).cast(kind[c]) for c in CARD_FIELDS if c in rows.columns}
    return rows.withColumns(gone | {"reason": F.lit(CARD_REASON)})


def inputs(rows: DataFrame, gate: DataFrame) -> DataFrame:
    """Drilled-down inputs (metric, cluster_id, input_id, value, place): of withheld metrics that show relevance neither value nor
    place remains; of other withheld ones the inputs stay, as readings need no scorer, but their order is marked uncited."""
    held = F.coalesce("withheld", F.lit(False)) & F.col("metric").isin(SCORER_DEPENDENT)
    shown = ~(held & F.col("metric").isin(SHOWS_RELEVANCE))
    out = rows.join(gate, "cluster_id", "left")
    return out.withColumns({"value": F.when(shown, F.col("value")), "place": F.when(shown, F.col("place")), "cited": ~held}).drop("axis", "withheld")
