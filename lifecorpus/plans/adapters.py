"""Adapters from the driver tables to the record schemas.

``conversations`` becomes chat Messages and ``documents`` becomes Docs, so the
operators run unchanged over table data. The mapping rules are deterministic
functions of each row, and no row is dropped (system turns are messages of one
more sender); the oracle SQL applies the same rules.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.functions.times import iso
from lifecorpus.schema import SOURCE_RANK, conform_docs, conform_messages, make_ord
from lifecorpus.settings import Settings

# Owner identity used for table-derived data.
OWNER = Settings.make("Owner", emails=["owner@example.com"], names=["Owner"])
# Chat source of a conversation: conv_id modulo 7 picks one of these.
CHAT_SOURCES = ["whatsapp", "messenger", "telegram", "gmail", "instagram", "linkedin", "twitter_dm"]
# Document source: the number in documents.source modulo 5 picks one of these.
DOC_SOURCES = ["twitter", "reddit", "facebook", "linkedin", "notes"]
BASE_EPOCH = 1704067200  # 2024-01-01T00:00:00Z


def _pick(names: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx + 1).cast("int"))


def _rank(source: F.Column) -> F.Column:
    m = F.create_map(*[x for k, v in SOURCE_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, source), F.lit(99))


def conversation_rows(conv: DataFrame) -> DataFrame:
    """Turns, each split at its first newline into two consecutive messages of
    the same side (so turn collapsing has work to do)."""
    parts = F.split(F.col("text"), "\n", 2)
    return conv.select("conv_id", "turn", "role", F.posexplode(parts).alias("part", "text"))


def sender_of(role, turn) -> F.Column:
    """Assistant turns are the owner's, system turns one more sender's; two people take the rest."""
    return (F.when(role == "assistant", F.lit(OWNER.name)).when(role == "system", F.lit("System"))
            .when(turn % 4 == 0, F.lit("Ana")).otherwise(F.lit("Ben")))


def conversation_messages(conv: DataFrame) -> DataFrame:
    """conversations -> Message. Time: 2024-01-01 + conv_id days + 7 minutes per
    turn + 5 hours every third turn (so 4-hour sessions split) + 30 s for the
    second part of a split turn."""
    r = conversation_rows(conv)
    source = _pick(CHAT_SOURCES, F.col("conv_id") % 7)
    secs = (F.lit(BASE_EPOCH) + F.col("conv_id") * 86400 + F.col("turn") * 420
            + F.floor(F.col("turn") / 3) * 18000 + F.col("part") * 30)
    sender = sender_of(F.col("role"), F.col("turn"))
    return conform_messages(r.select(
        source.alias("source"),
        F.col("conv_id").cast("string").alias("thread_id"),
        iso(F.timestamp_seconds(secs)).alias("timestamp"),
        sender.alias("sender"),
        (F.col("role") == "assistant").alias("is_me"),
        F.col("text"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("thread_title"),
        F.array().cast("array<string>").alias("participants"),
        make_ord(_rank(source), None, F.col("conv_id"), F.col("turn") * 2 + F.col("part")).alias("ord"),
    ))


def document_docs(docs: DataFrame) -> DataFrame:
    """documents -> Doc: source from the number in documents.source, written by
    the owner unless German, timestamp 2024-01-01 + doc_id hours, meta kind and
    subreddit (= lang)."""
    n = F.regexp_extract(F.col("source"), r"(\d+)", 1).cast("int")
    source = _pick(DOC_SOURCES, n % 5)
    kind = F.when(F.col("doc_id") % 2 == 0, F.lit("post")).otherwise(F.lit("comment"))
    return conform_docs(docs.select(
        source.alias("source"),
        F.col("doc_id").cast("string").alias("doc_id"),
        iso(F.timestamp_seconds(F.lit(BASE_EPOCH) + F.col("doc_id") * 3600)).alias("timestamp"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text"),
        (F.col("lang") != "de").alias("authored_by_me"),
        F.create_map(F.lit("kind"), kind, F.lit("subreddit"), F.col("lang")).alias("meta"),
        make_ord(_rank(source), None, F.lit(0), F.col("doc_id")).alias("ord"),
    ))
