"""Corpus statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# Rough tokens = characters // 4; own-token thresholds for a thin / strong corpus.
CHARS_PER_TOKEN = 4
THIN_TOKENS = 200_000
STRONG_TOKENS = 1_000_000
# Number of unrecognised chat senders listed.
TOP_UNKNOWN = 8
# End of fixed values
# ---------------------------------------------------------------------------


def _records(msgs: DataFrame, docs: DataFrame) -> DataFrame:
    return (msgs.select("source", F.col("is_me").alias("mine"), F.length("text").alias("n"))
            .unionByName(docs.select("source", F.col("authored_by_me").alias("mine"),
                                     F.length("text").alias("n"))))


def corpus_stats(msgs: DataFrame, docs: DataFrame) -> DataFrame:
    """Per source: records, own and others' rough tokens (sum first, then // 4)."""
    r = _records(msgs, docs)
    return r.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.floor(F.coalesce(F.sum(F.when(F.col("mine"), F.col("n"))), F.lit(0)) / CHARS_PER_TOKEN
                ).cast("long").alias("my_tokens"),
        F.floor(F.coalesce(F.sum(F.when(~F.col("mine"), F.col("n"))), F.lit(0)) / CHARS_PER_TOKEN
                ).cast("long").alias("other_tokens"))


def my_tokens(msgs: DataFrame, docs: DataFrame) -> DataFrame:
    """Total own characters // 4 and the thin/strong verdict."""
    r = _records(msgs, docs)
    tok = F.floor(F.coalesce(F.sum(F.when(F.col("mine"), F.col("n"))), F.lit(0)) / CHARS_PER_TOKEN
                  ).cast("long")
    out = r.agg(tok.alias("my_tokens"))
    return out.withColumn("strength", F.when(F.col("my_tokens") < THIN_TOKENS, F.lit("thin"))
                          .when(F.col("my_tokens") >= STRONG_TOKENS, F.lit("strong"))
                          .otherwise(F.lit("medium")))


def unknown_senders(msgs: DataFrame, k: int = TOP_UNKNOWN) -> DataFrame:
    """The k most frequent chat senders not recognised as the owner (mail
    excluded); equal counts keep first-seen order. Partial counts are combined
    map-side; the top-k runs on one row per sender."""
    c = (msgs.where(~F.col("is_me") & (F.col("source") != "gmail"))
         .groupBy("sender").agg(F.count(F.lit(1)).alias("n_messages"), F.min("ord").alias("_first")))
    w = Window.orderBy(F.desc("n_messages"), F.asc("_first"))
    return c.orderBy(F.desc("n_messages"), F.asc("_first")).limit(k) \
        .withColumn("rank", F.row_number().over(w)).drop("_first")
