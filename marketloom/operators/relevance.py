"""Text relevance against weighted lexicons: tokens joined to terms, two axes, decision bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lexicon_weights(terms: DataFrame) -> DataFrame:
    """terms (slug, axis, term) of one family, with weight 1/k, k being the lexicons that hold the term; 0 if all do."""
    terms = terms.select("slug", "axis", F.lower("term").alias("term")).distinct()
    n = terms.select("slug").distinct().agg(F.count("*").alias("n"))
    held = terms.groupBy("axis", "term").agg(F.countDistinct("slug").alias("k"))
    weight = F.when(F.col("k") == F.col("n"), 0.0).otherwise(1.0 / F.col("k"))
    return terms.join(held, ["axis", "term"]).crossJoin(F.broadcast(n)).select("slug", "axis", "term", weight.alias("weight"))


def singular(word: Column) -> Column:
    n = F.length(word)
    return (
        F.when(word.endswith("es") & (n > 4), F.left(word, n - 2)).when(word.endswith("s") & ~word.endswith("ss") & (n > 3), F.left(word, n - 1)).otherwise(word)
    )


def tokens(text: Column) -> Column:
    """Distinct words in singular form."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))
    return F.array_distinct(F.transform(F.filter(F.split(plain, " "), lambda w: w != ""), singular))


def axis_scores(items: DataFrame, weights: DataFrame) -> DataFrame:
    """(item_id, slug, axis, score): raw = 2 * min(title, 3) + min(description only, 3), score = raw / (raw + 2).

    items: item_id, title, description. Words are exploded once and joined to the terms, which are broadcast; what matches nothing has no row.
    """
    words = items.select(
        "item_id", F.explode(F.concat(
            F.transform(tokens(F.col("title")), lambda w: F.struct(w.alias("word"), F.lit(True).alias("titled"))),
            F.transform(F.array_except(tokens(F.col("description")), tokens(F.col("title"))), lambda w: F.struct(w.alias("word"), F.lit(False).alias("titled"))),
        )).alias("w"),
    ).select("item_id", "w.word", "w.titled")
    terms = weights.filter("weight > 0").select("slug", "axis", singular(F.col("term")).alias("word"), "weight")
    hits = words.join(F.broadcast(terms), "word").groupBy("item_id", "slug", "axis").agg(
        F.sum(F.when(F.col("titled"), F.col("weight")).otherwise(0.0)).alias("t"), F.sum(F.when(~F.col("titled"), F.col("weight")).otherwise(0.0)).alias("d")
    )
    raw = 2 * F.least("t", F.lit(3.0)) + F.least("d", F.lit(3.0))
    return hits.select("item_id", "slug", "axis", F.round(raw / (raw + 2), 4).alias("score"))


def relevance(scores: DataFrame, axes: tuple[str, str]) -> DataFrame:
    """(item_id, slug, relevance): the geometric mean of the two axes; items with one axis only have none."""
    wide = scores.groupBy("item_id", "slug").pivot("axis", list(axes)).agg(F.first("score")).dropna()
    return wide.select("item_id", "slug", F.round(F.sqrt(F.col(axes[0]) * F.col(axes[1])), 4).alias("relevance"))


def band(value: Column, on: float = 0.55, noise: float = 0.0) -> Column:
    return F.when(value.isNull(), "unscorable").when(value >= on, "on_niche").when(value <= noise, "noise").otherwise("undecided")


def latin_share(text: Column) -> Column:
    """Latin letters among letters; NULL without letters."""
    return F.try_divide(F.regexp_count(text, F.lit(r"\p{IsLatin}")), F.nullif(F.regexp_count(text, F.lit(r"\p{L}")), F.lit(0)))


def best(relevances: DataFrame) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("relevance"), "slug")
    return relevances.withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k")


def calibration(scored: DataFrame, *by: str) -> DataFrame:
    """Per half (sha256 of the id modulo 2) and columns `by`: tp, fp, fn, precision, recall, base_rate, unscorable. scored: id, value, label."""
    half = F.conv(F.substring(F.sha2(F.col("id").cast("string"), 256), 64, 1), 16, 10).cast("int") % 2
    hit, yes = F.col("value") >= 0.55, F.col("label") == 1
    out = scored.groupBy(*by, half.alias("half")).agg(
        F.count("*").alias("n"), F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"), F.count_if(yes & ~F.coalesce(hit, F.lit(False))).alias("fn"),
        F.count_if(F.col("value").isNull()).alias("unscorable"), F.round(F.avg("label"), 6).alias("base_rate"),
    )
    return out.withColumns({"precision": F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 6), "recall": F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6)})


def bands(labelled: DataFrame, edges: list[float], *by: str, z: float = 1.96) -> DataFrame:
    """Per band of the score and columns `by` (the edges below or at it, counted; NULL: not scored): labels, share of ones, and the lower end of
    the Wilson interval of that share."""
    band = F.when(F.col("value").isNotNull(), sum((F.col("value") >= e).cast("int") for e in edges))
    per = labelled.groupBy(*by, band.alias("band")).agg(F.count("*").alias("n"), F.avg(F.col("label").cast("double")).alias("share"))
    n, p = F.col("n"), F.col("share")
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return per.select(*by, "band", "n", F.round("share", 6).alias("share"), F.round(low, 6).alias("wilson_low"))
