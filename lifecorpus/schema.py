"""Record schemas: Message, Doc and the SFT example, plus helpers that conform
source outputs to them.

Row order carries meaning (stable thread sort, first-seen threads, keep-first
dedup), so every record carries an ``ord`` struct that sorts like the
reference's file walk: registry rank, path components, file block, position.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORD = T.StructType([
    T.StructField("src_rank", T.IntegerType()),
    T.StructField("path", T.ArrayType(T.StringType())),
    T.StructField("block", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("sub", T.LongType()),
])

MESSAGE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("thread_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("is_me", T.BooleanType()),
    T.StructField("text", T.StringType()),
    T.StructField("thread_title", T.StringType()),
    T.StructField("participants", T.ArrayType(T.StringType())),
    T.StructField("ord", ORD),
])

DOC = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("authored_by_me", T.BooleanType()),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType(), True)),
    T.StructField("ord", ORD),
])

REJECT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# What a source job gives: messages, docs and rejected files in one frame, told apart by
# ``tag``, so that one pass over the files and one write serve all three tables.
MESSAGES, DOCS, REJECTS = TAGS = ("messages", "docs", "rejects")
SCHEMAS = {MESSAGES: MESSAGE, DOCS: DOC, REJECTS: REJECT}
RECORD = T.StructType([T.StructField("tag", T.StringType())]
                      + list({f.name: f for t in TAGS for f in SCHEMAS[t].fields}.values()))

CHAT_MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

EXAMPLE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("messages", T.ArrayType(CHAT_MESSAGE)),
])

# Source registry rank (position in the reference's registry): the first
# component of ``ord`` so that a union of all sources sorts like its output.
SOURCE_RANK = {
    "gmail": 0, "calendar": 1, "drive": 2, "lifelog": 3, "messenger": 4, "facebook": 5,
    "instagram": 6, "whatsapp": 7, "telegram": 8, "twitter": 9, "reddit": 10,
    "linkedin": 11, "notes": 12, "git": 13,
    # direct messages come out of the same job as tweets
    "twitter_dm": 9,
}


def make_ord(rank: int | Column, path: Column | None = None, block: Column | None = None,
             pos: Column | None = None, sub: Column | None = None) -> Column:
    rank_c = rank if isinstance(rank, Column) else F.lit(rank)
    return F.struct(
        rank_c.cast("int").alias("src_rank"),
        (path if path is not None else F.array().cast("array<string>")).alias("path"),
        (block if block is not None else F.lit(0)).cast("long").alias("block"),
        (pos if pos is not None else F.lit(0)).cast("long").alias("pos"),
        (sub if sub is not None else F.lit(0)).cast("long").alias("sub"),
    )


def path_parts(path_col: Column) -> Column:
    """Path components, so that array comparison sorts like Python's Path."""
    return F.split(path_col, "/")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _message_columns() -> list[Column]:
    """The Message columns in order, with the dataclass defaults."""
    return [
        F.col("source").cast("string"),
        F.coalesce(F.col("thread_id").cast("string"), F.lit("")).alias("thread_id"),
        F.coalesce(F.col("timestamp").cast("string"), F.lit("")).alias("timestamp"),
        F.coalesce(F.col("sender").cast("string"), F.lit("")).alias("sender"),
        F.coalesce(F.col("is_me"), F.lit(False)).alias("is_me"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("thread_title"), F.lit("")).alias("thread_title"),
        F.coalesce(F.col("participants"), F.array().cast("array<string>")).alias("participants"),
        F.col("ord").cast(ORD).alias("ord"),
    ]


def _doc_columns(df: DataFrame) -> list[Column]:
    meta = F.col("meta") if "meta" in df.columns else F.create_map().cast("map<string,string>")
    return [
        F.col("source").cast("string"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.coalesce(F.col("timestamp").cast("string"), F.lit("")).alias("timestamp"),
        F.coalesce(F.col("title").cast("string"), F.lit("")).alias("title"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("authored_by_me"), F.lit(False)).alias("authored_by_me"),
        F.coalesce(meta, F.create_map().cast("map<string,string>")).alias("meta"),
        F.col("ord").cast(ORD).alias("ord"),
    ]


def conform_messages(df: DataFrame) -> DataFrame:
    """Select Message columns in order, filling the dataclass defaults."""
    return df.select(*_message_columns())


def conform_docs(df: DataFrame) -> DataFrame:
    return df.select(*_doc_columns(df))


def records(df: DataFrame, tag: str) -> DataFrame:
    """Rows of one kind as records. Where ``df`` has an ``error``, a row with one is a
    rejected file: its ``path`` and the error are kept, the rest is the kind's defaults."""
    columns = _message_columns() if tag == MESSAGES else _doc_columns(df) if tag == DOCS else [F.col("source")]
    failed = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    path, reason = (F.when(failed, F.col(c)) if c in df.columns else F.lit(None) for c in ("path", "error"))
    named = [F.when(failed, F.lit(REJECTS)).otherwise(F.lit(tag)).alias("tag"), *columns,
             path.cast("string").alias("path"), reason.cast("string").alias("reason")]
    got = df.select(*named)
    return got.select(*[F.col(f.name) if f.name in got.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in RECORD.fields])


def of_kind(recs: DataFrame, tag: str) -> DataFrame:
    """The records of one kind, with that kind's columns."""
    return recs.where(F.col("tag") == tag).select(*SCHEMAS[tag].fieldNames())


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
