"""Channel membership from discoveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dominant_seeds(found: DataFrame) -> DataFrame:
    """channel_id, seed, dated, n, confidence: the seed under which most of a channel's videos were found by date, then at
    all, then the lowest; confidence is its share of the sum over seeds."""
    per = found.groupBy("channel_id", "seed").agg(F.countDistinct(F.when(F.col("by_date"), F.col("video_id"))).alias("dated"), F.countDistinct("video_id").alias("n"))
    order = Window.partitionBy("channel_id").orderBy(F.desc("dated"), F.desc("n"), "seed")
    per = per.withColumns({"k": F.row_number().over(order), "t": F.sum("n").over(Window.partitionBy("channel_id"))})
    return per.filter("k = 1").select("channel_id", "seed", "dated", "n", F.round(F.col("n") / F.col("t"), 6).alias("confidence"))
