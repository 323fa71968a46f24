"""The corpus pipeline: five stages, each on all that its predecessor kept, written as Parquet between stages.

Stages decide row by row: each numbers its rows once and joins its decisions back on that number, so rows with a null
doc_id and rows that share one are judged by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from marketloom.llm.common import saved, scratch, table
from marketloom.llm.queries import MIX, SHARDS


#: The number of a row within a stage.
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ROW, written, so that every read finds the same numbers."""
    return saved(docs.withColumn(ROW, F.monotonically_increasing_id()), "stage-rows")


def by_row(rows: DataFrame) -> DataFrame:
    """What operators read of numbered rows: ROW stands as doc_id."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model rejects go, each by its own text, whatever its id.

    Null and empty texts score the share of toxic labels; rows that repeat are judged alike. An empty table stays empty;
    columns besides text are kept as they are.
    """
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = numbered(docs)
    bad = toxicity.score(by_row(rows), model).filter("predicted = 1").select(F.col("doc_id").alias(ROW))
    return rows.join(bad, ROW, "left_anti").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links of five-word shingles at a Jaccard index of 0.8 connect, the one with the smallest id stays.

    A null id comes after all others. Of a group's rows that share the smallest id one stays: the first by a hash of
    their columns. Rows that share an id but link with nothing all stay, and so does a row without id. Null and empty texts
    link with nothing, so all of them stay. An empty table stays empty; columns besides text and doc_id only break ties.
    """
    rows = numbered(docs)
    groups = jaccard_join.near_duplicates(by_row(rows), n=5, percent=80).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64(*docs.columns).alias("hash"), ROW)
    firsts = groups.join(rows.select(ROW, order.alias("order")), ROW).groupBy("component_id").agg(F.min("order").alias("first"))
    return rows.join(firsts.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_semi").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold the question and answer of a benchmark item go, each by its own text, whatever its id.

    Null and empty texts hold none; rows that repeat go together. An empty table stays empty, and without items all rows
    stay; columns besides text are kept as they are.
    """
    rows = numbered(docs)
    bad = decontaminate.contaminated(by_row(rows), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(bad, ROW, "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture reads them: one for each row and epoch. Rows that share an id are chosen each for
    itself; rows without id are read too, in the order of 'null'. Null lang and source count as ''; null and empty texts have
    no tokens and go with their neighbours; ties go by tokens, then row. An empty table stays empty."""
    rows = numbered(docs)
    times = mixing.mixture(rows, MIX, carried=ROW).select(ROW)
    return rows.join(times, ROW).select(docs.columns)


def deal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each row of docs: doc_id, size, text_crc32, virtual_slot, shard, map_version, slot. Null texts have size 1;
    rows with null or repeated ids have slots of their own; an empty table gives no rows; other columns are not read."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("mixing", mix),
    ("sharding", deal),
]
#: SQL cannot express the stages with learned scores, BM25 passages and hashed slots.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
