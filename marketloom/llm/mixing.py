"""Mixing sources to target weights: budgets flow down a domain-language-source tree, epochs fill the leaves."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Mix:
    """Target weights (whole numbers; a child that isn't named has weight 1) and limits.

    share: tokens to select, in thousandths of the tokens there are. epochs: how often a leaf may be read at most.
    """

    domains: Mapping[str, int] = field(default_factory=dict)
    langs: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)
    share: int = 500
    epochs: int = 4
    seed: int = 7


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weight(column: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("long").alias("weight")


def _fill(nodes: DataFrame, parent: list[str], weights: Mapping[str, int], carried: list[str] = ()) -> DataFrame:
    """Splits each parent's budget over its children by weight, none above its cap; what a child cannot take goes to siblings.

    nodes: one row per child with parent columns, child, cap, parent_budget. Children are taken by cap over weight; each
    is full as long as its share of what is left covers its cap; the others share the rest by weight. carried: other columns
    to keep.
    """
    order = [F.try_divide(F.col("cap").cast("double"), F.col("weight")).asc_nulls_last(), F.col("child")]
    w = Window.partitionBy(*parent).orderBy(*order) if parent else Window.orderBy(*order)
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    out = nodes.withColumn("weight", _weight("child", weights)).withColumns({"left": left, "heavy": heavy})
    out = out.withColumn("full", F.col("weight") * F.col("left") >= F.col("cap") * F.col("heavy"))
    out = out.withColumns(
        {"rest": F.max(F.when(~F.col("full"), F.col("left"))).over(whole), "rest_weight": F.max(F.when(~F.col("full"), F.col("heavy"))).over(whole)}
    )
    share = F.expr("(rest * weight) div nullif(rest_weight, 0)")
    return out.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.greatest(F.coalesce(share, F.lit(0)), F.lit(0)))).select(
        *parent, "child", *carried, "budget"
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves (domain, lang, source, have) with budget. Shortages go to sources of the same language first, then to
    languages of the domain, then to domains: a node takes no more than its whole subtree can give."""
    own = [c for c in leaves.columns if c not in LEAF]
    leaves = leaves.withColumn("cap", F.col("have") * mix.epochs)
    top = leaves.groupBy(F.col("domain").alias("child")).agg(F.sum("cap").alias("cap"), F.sum("have").alias("have"))
    total = F.sum("have").over(Window.partitionBy()) * mix.share  # a row a domain, which _fill orders in one window too
    top = top.withColumn("total", total).withColumn("parent_budget", F.expr("coalesce(total div 1000, 0)"))
    top = _fill(top, [], mix.domains).select(F.col("child").alias("domain"), F.col("budget").alias("parent_budget"))
    mid = leaves.groupBy("domain", F.col("lang").alias("child")).agg(F.sum("cap").alias("cap")).join(F.broadcast(top), "domain")
    mid = _fill(mid, ["domain"], mix.langs).select("domain", F.col("child").alias("lang"), F.col("budget").alias("parent_budget"))
    low = leaves.withColumnRenamed("source", "child").join(F.broadcast(mid), ["domain", "lang"])
    return _fill(low, ["domain", "lang"], mix.sources, own).select("domain", "lang", F.col("child").alias("source"), *own, "budget")


def domain_of(source: Column) -> Column:
    """The domain of a source: its number modulo 4, as 'd0' to 'd3'."""
    return F.concat(F.lit("d"), F.coalesce(F.try_mod(F.regexp_extract(source, r"(\d+)$", 1).try_cast("long"), F.lit(4)), F.lit(0)).cast("string"))


def mixture(docs: DataFrame, mix: Mix, domain: Column | None = None, carried: str | None = None) -> DataFrame:
    """One row per chosen document and epoch: doc_id, domain, lang, source, epoch, n_tokens.

    Each leaf reads whole epochs while its budget covers them, then the start of one more: an epoch's order is
    md5(seed:epoch:doc_id), and documents are taken while their running sum fits. Null lang and source
    count as ''; a null doc_id orders as 'null'; texts without tokens are taken with their neighbours; repeated rows
    are rows of their own (ties by n_tokens). An empty table gives no rows. carried: a column of docs that the chosen
    rows keep, after doc_id; it breaks further ties.

    The order inside a leaf is cut into about sqrt(rows) ranges of the hash. Only the range in which the budget runs
    out is sorted; for all others the range's sum decides. No leaf is held by one task.
    """
    source = F.coalesce(F.col("source"), F.lit(""))
    own = ["doc_id", *([carried] if carried else [])]
    rows = docs.select(
        *own, (domain_of(source) if domain is None else domain).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source"),
        tokens(F.col("text")).alias("n_tokens"),
    )
    rows = saved(rows, "mix-rows")
    leaves = saved(rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("have"), F.count("*").alias("n")), "mix-leaves")
    plan = budgets(leaves, mix).withColumns(
        {
            "whole": F.expr("coalesce(budget div nullif(have, 0), 0)"),
            "ranges": F.expr("cast(greatest(1, ceil(sqrt(n))) as bigint)"),
        }
    )
    plan = saved(plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("have")), "mix-plan")
    # the plan has a row per leaf; domains, languages and sources are few beside documents, and Spark chooses the join by size
    key = F.md5(F.concat(F.lit(f"{mix.seed}:"), F.col("whole").cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = rows.join(plan.drop("have", "n", "budget"), LEAF).withColumn("key", F.when(F.col("rest") > 0, key))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = saved(rows.withColumn("range", F.shiftright(place * F.col("ranges"), 32)).drop("ranges"), "mix-dealt")
    sums = rows.filter("rest > 0").groupBy(*LEAF, "rest", "range").agg(F.sum("n_tokens").alias("sum"))
    upto = Window.partitionBy(*LEAF).orderBy("range")
    sums = sums.withColumn("end", F.sum("sum").over(upto)).withColumn("start", F.col("end") - F.col("sum"))
    # a leaf's rest is less than what it has, so it ends in one range
    ends = saved(sums.filter("start <= rest and end > rest").select(*LEAF, F.col("range").alias("last"), (F.col("rest") - F.col("start")).alias("left")), "mix-ends")
    rows = rows.drop("rest").join(ends, LEAF, "left")
    read = F.explode(F.expr("sequence(0L, whole - if(range < last, 0, 1))"))
    full = rows.filter("whole > 0 or range < last").select(*own, *LEAF, read.alias("epoch"), "n_tokens")
    order = Window.partitionBy(*LEAF, "range").orderBy("key", "n_tokens", *own[1:]).rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.filter("range = last").withColumn("through", F.sum("n_tokens").over(order)).filter("through <= left")
    edge = edge.select(*own, *LEAF, F.col("whole").alias("epoch"), "n_tokens")
    return full.unionByName(edge).select(*own, *LEAF, F.col("epoch").cast("int").alias("epoch"), "n_tokens")
