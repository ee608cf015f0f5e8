"""Daily lifelog rollup (S10, A9): one Doc per day listing, per activity kind
in first-seen order, its distinct items joined by '; ' (all of them, or the first ``max_items``)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.schema import conform_docs, make_ord


def distinct_items(feed: DataFrame) -> DataFrame:
    """feed: (day string, kind string, item string, seq) with seq the feed order. Distinct
    (day, kind, item) keep their first seq (pre-aggregated map-side)."""
    return feed.groupBy("day", "kind", "item").agg(F.min("seq").alias("seq"))


def daily_rollup(feed: DataFrame, rank: int = 3, max_items: int | None = None) -> DataFrame:
    return rollup(distinct_items(feed), rank, max_items)


def rollup(first: DataFrame, rank: int = 3, max_items: int | None = None) -> DataFrame:
    """Daily documents of distinct items, whose lists are joined in two levels: per range segment
    of (day, kind, seq), then the segments' parts. Nothing is cut by default. With ``max_items`` a rank limit, applied per partition before the shuffle, keeps that many items per day and kind."""
    w = Window.partitionBy("day", "kind").orderBy("seq", "item")
    capped = first if max_items is None else (
        first.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_items))
    # a day's items are joined per range segment first, so a day with a third of all items is many tasks
    ranged = capped.repartitionByRange("day", "kind", "seq", "item").withColumn("_seg", F.spark_partition_id())
    parts = ranged.groupBy("day", "kind", "_seg").agg(
        F.min("seq").alias("seq"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "item"))), lambda x: x["item"]), "; ").alias("items"))
    kinds = parts.groupBy("day", "kind").agg(
        F.min("seq").alias("kseq"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seg", "items"))), lambda x: x["items"]), "; ").alias("items"))
    days = kinds.groupBy("day").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("kseq", F.concat(F.col("kind"), F.lit(": "), F.col("items"))
                                             .alias("line")))),
        lambda x: x["line"]), "\n").alias("text"))
    return conform_docs(days.select(
        F.lit("lifelog").alias("source"), F.col("day").alias("doc_id"),
        F.concat(F.col("day"), F.lit("T00:00:00+00:00")).alias("timestamp"),
        F.concat(F.lit("Activity on "), F.col("day")).alias("title"),
        "text", F.lit(False).alias("authored_by_me"),
        make_ord(rank, None, F.lit(0), F.lit(0)).alias("ord")))
