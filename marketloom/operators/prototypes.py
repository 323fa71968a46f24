"""Language gates, term matches and evidence, keyword exports, posts and keyword-niche features."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relevance import latin_share, singular, tokens


def _plain(text: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def term_matches(items: DataFrame, terms: DataFrame) -> DataFrame:
    """(item_id, term): single words by singular form among an item's words, phrases as whole words in a row; each once.

    items: item_id, text; terms: term, a list of curated words, which is broadcast. A phrase is looked for only where its first
    word occurs. No text is shuffled, and it is repeated only for the first words that it has."""
    first = F.split_part("term", F.lit(" "), F.lit(1))
    kind = F.instr("term", " ") > 0
    words = terms.filter(~kind).select("term", singular(F.col("term")).alias("word"))
    single = items.select("item_id", F.explode(tokens(F.col("text"))).alias("word")).join(F.broadcast(words), "word").select("item_id", "term")
    phrases = terms.filter(kind).select("term", first.alias("word"))
    firsts = phrases.agg(F.collect_set("word").alias("firsts"))
    plain = items.select("item_id", _plain("text").alias("plain")).crossJoin(F.broadcast(firsts))
    begun = plain.select("item_id", "plain", F.explode(F.array_intersect(F.split("plain", " "), F.col("firsts"))).alias("word")).join(F.broadcast(phrases), "word")
    spaced = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    return single.unionByName(begun.filter(spaced("plain").contains(spaced("term"))).select("item_id", "term")).distinct()


def _fold() -> tuple[str, str]:
    """Small Latin letters with marks and the plain letters that they decompose to; combining marks have no counterpart."""
    bases = {c: unicodedata.normalize("NFKD", c) for c in map(chr, range(0xC0, 0x250)) if c.islower()}
    marked = {c: d[0] for c, d in bases.items() if d != c and "a" <= d[0] <= "z" and all(map(unicodedata.combining, d[1:]))}
    return "".join(marked) + "".join(map(chr, range(0x300, 0x370))), "".join(marked.values())


FOLD = _fold()


def gates(items: DataFrame, words: dict[str, list[str]], home: str) -> DataFrame:
    """(item_id, reason): why a text is not scored, NULL if it is. items: item_id, title, description; words: a language's
    function words, without accents, as those of texts are folded.

    Foreign: two or more words of one language in the title and more than of the home language; or six or more in the
    description and more than twice the home language's, unless two home words make the title clear."""
    own = lambda c: F.array_distinct(F.split(F.translate(F.lower(F.coalesce(c, F.lit(""))), *FOLD), r"[^\p{L}]+"))
    found = lambda c, lang: F.size(F.array_intersect(own(c), F.array(*map(F.lit, words[lang]))))
    others = [x for x in words if x != home]
    rows = items.select(
        "item_id", "title", latin_share(F.col("title")).alias("share"), found("title", home).alias("th"), found("description", home).alias("dh"),
        F.greatest(*[found("title", x) for x in others]).alias("tf"), F.greatest(*[found("description", x) for x in others]).alias("df"),
    )
    foreign = ((F.col("tf") >= 2) & (F.col("tf") > F.col("th"))) | ((F.col("df") >= 6) & (F.col("df") > 2 * F.col("dh")) & (F.col("th") < 2))
    reason = F.when(F.trim(F.coalesce("title", F.lit(""))) == "", "no title").when(F.col("share").isNull(), "no letters").when(F.col("share") < 0.5, "script").when(foreign, "foreign")
    return rows.select("item_id", reason.alias("reason"))


def _hits(items: DataFrame, weights: DataFrame) -> DataFrame:
    words = items.select("item_id", F.explode(F.array_union(tokens(F.col("title")), tokens(F.col("description")))).alias("word"))
    return words.join(F.broadcast(weights.filter("weight > 0").withColumn("word", singular(F.col("term")))), "word")


def prefilter(items: DataFrame, weights: DataFrame, axes: int = 2) -> DataFrame:
    """(item_id, slug) with some term on every axis: what alone can have a relevance."""
    return _hits(items, weights).groupBy("item_id", "slug").agg(F.countDistinct("axis").alias("n")).filter(F.col("n") == axes).select("item_id", "slug")


def evidence(items: DataFrame, weights: DataFrame, n: int = 6) -> DataFrame:
    """(item_id, slug, terms): the matched terms of most weight. The lexicon bounds what is collected."""
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "term"))), 1, n)
    return _hits(items, weights).groupBy("item_id", "slug").agg(F.array_join(F.transform(best, lambda x: x["term"]), ",").alias("terms"))


def inspected(relevances: DataFrame, n: int, on: float = 0.55) -> DataFrame:
    """Per slug the n weakest rows kept and the n strongest dropped at the threshold; the cap is the feature."""
    kept = F.col("relevance") >= on
    order = Window.partitionBy("slug", "kept").orderBy(F.when(F.col("kept"), F.col("relevance")).otherwise(-F.col("relevance")), "item_id")
    return relevances.withColumn("kept", kept).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)


def number(text: Column) -> Column:
    """A number of an export: decimal comma, no-break spaces, % as a fraction; a dash, the infinity sign or other text is NULL."""
    plain = F.replace(F.regexp_replace(text, r"[\s\x{a0}%]", ""), F.lit(","), F.lit("."))
    return plain.try_cast("double") / F.when(text.contains("%"), 100).otherwise(1)


def keyword_export(files: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows of tab-separated exports. files: file, content (bytes of a whole export, UTF-16 or UTF-8 by its byte order mark);
    names: column -> a part of its heading. The heading is the first line that holds all parts; rows without a keyword go."""
    head = F.hex(F.substring("content", 1, 2))
    text = F.when(head.isin("FFFE", "FEFF"), F.decode("content", "UTF-16")).otherwise(F.regexp_replace(F.decode("content", "UTF-8"), r"^\x{feff}", ""))
    lines = files.select("file", F.split(text, "\r?\n").alias("lines"))
    is_head = lambda x: F.array_position(F.array(*[F.lower(x).contains(p) for p in names.values()]), False) == 0
    lines = lines.select("file", "lines", F.filter("lines", is_head)[0].alias("head")).withColumn("at", F.array_position("lines", F.col("head")))
    rows = lines.select("file", F.split(F.lower("head"), "\t").alias("head"), F.explode(F.expr("slice(lines, at + 1, size(lines))")).alias("line"))
    cells = F.split("line", "\t")
    place = lambda p: F.array_position(F.transform("head", lambda h: h.contains(p)), True).cast("int")
    cell = {c: F.try_element_at(cells, place(p)) for c, p in names.items()}
    out = rows.select("file", *[(F.trim(v) if c == "keyword" else number(v)).alias(c) for c, v in cell.items()])
    return out.filter("keyword <> ''")


def posts(items: DataFrame, question: str, shared: str) -> DataFrame:
    """(item_id, asks, shared): whether a text asks, and the distinct ids it shares, sorted."""
    ids = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(shared), F.lit(1))))
    return items.select("item_id", F.coalesce(F.col("text").rlike(question), F.lit(False)).alias("asks"), F.coalesce(F.array_join(ids, ","), F.lit("")).alias("shared"))


def disclosures(items: DataFrame, pattern: str, low: float, high: float) -> DataFrame:
    """(item_id, nth, value): all amounts that texts disclose, within bounds."""
    hits = items.select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("nth", "hit"))
    return hits.select("item_id", "nth", F.col("hit").try_cast("double").alias("value")).filter(F.col("value").between(low, high))


def keyword_niches(keywords: DataFrame, top: int = 10) -> DataFrame:
    """Per niche: volume, last three over first three months less 1, population deviation over mean of months, top keywords."""
    months = keywords.groupBy("niche", "observed_date").agg(F.sum("volume").alias("v"))
    a, b = Window.partitionBy("niche").orderBy("observed_date"), Window.partitionBy("niche").orderBy(F.desc("observed_date"))
    months = months.withColumns({"a": F.row_number().over(a), "b": F.row_number().over(b)})
    out = months.groupBy("niche").agg(
        F.sum("v").alias("volume"), (F.try_divide(F.sum(F.when(F.col("b") <= 3, F.col("v"))), F.sum(F.when(F.col("a") <= 3, F.col("v")))) - 1).alias("trend"),
        F.try_divide(F.stddev_pop("v"), F.avg("v")).alias("seasonality"),
    )
    words = keywords.groupBy("niche", "keyword").agg(F.sum("volume").alias("v"))
    words = words.withColumn("k", F.row_number().over(Window.partitionBy("niche").orderBy(F.desc("v"), "keyword"))).filter(F.col("k") <= top)
    best = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "keyword"))), lambda x: x["keyword"]), ",")
    return out.select("niche", "volume", F.round("trend", 6).alias("trend"), F.round("seasonality", 6).alias("seasonality")).join(words.groupBy("niche").agg(best.alias("best")), "niche")


def tier_share(interest: DataFrame, weights: DataFrame, tier: list[str]) -> DataFrame:
    """Per cluster: interest of tier-one countries over all, both weighted by a supplied table (country, weight)."""
    rows = interest.join(F.broadcast(weights), "country").withColumn("w", F.col("value") * F.col("weight"))
    return rows.groupBy("cluster_id").agg(F.round(F.try_divide(F.sum(F.when(F.col("country").isin(tier), F.col("w")).otherwise(0.0)), F.sum("w")), 6).alias("share"))


def cost_ratio(keywords: DataFrame, tier: list[str]) -> DataFrame:
    """Per niche: mean high bid in tier-one geos over that elsewhere."""
    mean = lambda c: F.avg(F.when(c, F.col("bid_high")))
    one = F.col("geo").isin(tier)
    return keywords.groupBy("niche").agg(F.round(F.try_divide(mean(one), mean(~one)), 6).alias("ratio"))


def trending_matches(titles: DataFrame, niches: DataFrame) -> DataFrame:
    """(niche, title, shared): trending titles that share words with a niche's terms, and how many. Joined on words, never all pairs."""
    a = titles.select("title", F.explode(tokens(F.col("title"))).alias("word"))
    b = niches.select("niche", F.explode(tokens(F.col("term"))).alias("word")).distinct()
    return a.join(b, "word").groupBy("niche", "title").agg(F.countDistinct("word").alias("shared"))
