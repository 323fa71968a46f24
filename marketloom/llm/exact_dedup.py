"""Exact duplicates: group by a 128-bit content hash, keep one id, and compare bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, join_groups, saved, sieve


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    keep: "smallest" or "largest" doc_id of equal texts stays. Null text counts as empty, so null and empty texts form
    one group. Rows repeated with the same doc_id and text are one group whose rows are all marked kept. A null doc_id is
    kept only in a group that has no other. Columns besides doc_id and text are not read; an empty table gives no rows.

    The text itself is shuffled only for rows that share their hash with another; there, each row's bytes are compared
    with those of the row that stays. Large groups are salted, and where bytes differ (a collision) those rows are grouped
    by text.
    """
    best = F.max if keep == "largest" else F.min
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = docs.select("doc_id", text.alias("text"), hash_of(text).alias("h"))
    rows = saved(hashed.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256")), "exact-rows")
    groups = saved(rows.groupBy("h").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "exact-groups")

    shared = groups.filter("group_size > 1")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    salts = shared.filter(F.col("group_size") * HOT_SHARE > total).select("h", F.expr("cast(ceil(group_size / 256) as int)").alias("salts"))
    members = sieve(hashed, F.col("h"), shared, "h")
    members = members.join(F.broadcast(salts), "h", "left").withColumn("salt", F.expr("coalesce(pmod(xxhash64(doc_id), salts), 0)"))
    every_salt = F.explode(F.expr("sequence(0L, cast(coalesce(salts, 1) - 1 as bigint))")).alias("salt")
    salted = lambda df: df.join(F.broadcast(salts), "h", "left").select(*df.columns, every_salt)
    staying = members.join(salted(shared.select("h", "keep_id")), ["h", "salt"]).filter("doc_id <=> keep_id")
    first = salted(staying.groupBy("h").agg(F.min("text").alias("kept_text")))
    odd = saved(members.join(first, ["h", "salt"]).filter("text <> kept_text").select("doc_id", "h", "text"), "exact-odd")
    if odd.isEmpty():
        out = join_groups(rows, groups, "h", "group_size")
    else:
        sha = F.sha2("text", 256).alias("text_sha256")
        apart = odd.groupBy("h", "text").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        apart = odd.join(apart, ["h", "text"]).select("doc_id", "h", sha, "keep_id", "group_size")
        marks = odd.select("doc_id", "h", sha).distinct()
        rest = rows.alias("r").join(marks.alias("m"), F.expr("r.doc_id <=> m.doc_id and r.h = m.h and r.text_sha256 = m.text_sha256"), "left_anti")
        rest = saved(rest, "exact-rest")
        same = saved(rest.groupBy("h").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "exact-same")
        out = join_groups(rest, same, "h", "group_size").unionByName(apart)
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")
