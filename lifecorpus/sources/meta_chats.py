"""Messenger and Instagram DMs (same JSON, incl. E2EE exports) -> Message.

Each thread file is one JSON document (the export splits long threads into
message_1.json, message_2.json, ..., which are merged back by thread id)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifecorpus.functions.identity import is_me
from lifecorpus.functions.text import clean_chat, fix_mojibake
from lifecorpus.functions.times import iso_epoch
from lifecorpus.operators.filters import keep_if
from lifecorpus.schema import MESSAGES, SOURCE_RANK, make_ord, of_kind, records
from lifecorpus.settings import Settings
from lifecorpus.sources.common import BAD_JSON, json_body, json_error, relative, stem, whole_files

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# Auto-generated lines that are dropped.
ATTACHMENT_SUFFIX = " sent an attachment."
REACTION_MARK = " to your message"
# End of fixed values
# ---------------------------------------------------------------------------

THREAD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("threadName", T.StringType()),
    # objects {"name": ...} (classic) or plain strings (E2EE); objects arrive as raw JSON
    T.StructField("participants", T.ArrayType(T.StringType())),
    T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("sender_name", T.StringType()),
        T.StructField("senderName", T.StringType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("is_unsent", T.BooleanType()),
        T.StructField("isUnsent", T.BooleanType()),
    ]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def _nz(c):
    return F.when(c != "", c)


def read_meta_chats(spark: SparkSession, root: str) -> DataFrame:
    return whole_files(spark, root, "*.json")


def meta_chat_records(raw: DataFrame, s: Settings, source: str, root: str) -> DataFrame:
    """raw: (path, content). Objects without a 'messages' array and lists are skipped; what is
    no valid JSON is a reject."""
    body = json_body(F.col("content"))
    data = raw.select("path", body.substr(1, 1).alias("first"), body.alias("body"))
    # a list is no thread, whatever it holds: another job's file
    data = data.where(F.col("first") != "[") \
        .select("path", "first", F.when(F.col("first") == "{", F.from_json("body", THREAD, {"mode": "PERMISSIVE"})).alias("d"))
    found = F.coalesce(F.col("d.messages").isNotNull(), F.lit(False))
    error = F.when(F.col("first") == "{", json_error(F.col("d"), found)).otherwise(F.lit(BAD_JSON))
    data = data.withColumn("error", error).where(found | F.col("error").isNotNull())
    rel = relative(F.col("path"), root)
    parts = F.split(rel, "/")
    tid = F.when(F.size(parts) == 1, stem(rel)).otherwise(
        F.concat(F.element_at(parts, -2), F.lit("/"), stem(rel)))
    tid = F.regexp_replace(tid, "/message_.*$", "")
    title = fix_mojibake(F.coalesce(_nz(F.col("d.title")), _nz(F.col("d.threadName")), tid))
    plist = F.transform(F.coalesce(F.col("d.participants"), F.array().cast("array<string>")),
                        lambda p: fix_mojibake(F.coalesce(
                            F.when(F.ltrim(p).startswith("{"), F.coalesce(F.get_json_object(p, "$.name"), F.lit(""))),
                            p)))
    th = data.select("path", tid.alias("thread_id"), title.alias("thread_title"), plist.alias("participants"),
                     F.posexplode_outer("d.messages").alias("i", "m"), "error")
    m = F.col("m")
    text = F.coalesce(_nz(m["content"]), _nz(m["text"]), F.lit(""))
    sender = F.coalesce(_nz(m["sender_name"]), _nz(m["senderName"]), F.lit(""))
    ts = F.coalesce(F.when(m["timestamp_ms"] != 0, m["timestamp_ms"]), m["timestamp"])
    unsent = F.coalesce(m["is_unsent"], F.lit(False)) | F.coalesce(m["isUnsent"], F.lit(False))
    failed = F.col("error").isNotNull()
    x = th.where(failed | (text != "") & ~unsent).select(
        "path", "thread_id", "thread_title", "participants", "i",
        fix_mojibake(text).alias("text"), fix_mojibake(sender).alias("sender"), ts.alias("ts"), "error")
    x = keep_if(x, failed | ~F.col("text").endswith(ATTACHMENT_SUFFIX) & ~F.col("text").contains(REACTION_MARK))
    return records(x.select(
        F.lit(source).alias("source"), "thread_id",
        F.when(F.col("ts").isNull(), F.lit("")).otherwise(iso_epoch(F.col("ts"))).alias("timestamp"),
        "sender", is_me(F.col("sender"), s).alias("is_me"), clean_chat(F.col("text")).alias("text"),
        "thread_title", "participants",
        make_ord(SOURCE_RANK[source], F.split(rel, "/"), F.lit(0), F.col("i")).alias("ord"), "path", "error"), MESSAGES)


def parse_meta_chats(raw: DataFrame, s: Settings, source: str, root: str) -> DataFrame:
    return of_kind(meta_chat_records(raw, s, source, root), MESSAGES)


def messenger_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return meta_chat_records(read_meta_chats(spark, root), s, "messenger", root)


def instagram_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return meta_chat_records(read_meta_chats(spark, root), s, "instagram", root)


def ingest_instagram(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return of_kind(instagram_job(spark, root, s), MESSAGES)
