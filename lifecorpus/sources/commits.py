"""S24 (re-aimed): commit messages from commit-log dumps -> Doc 'git'.

The reference runs `git log` itself; here each repository's log is a dump file
<repo>.gitlog written with the format '%H%x1f%aI%x1f%B%x1e', read as records
split at the 0x1E separator (splittable)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.text import py_strip
from lifecorpus.schema import SOURCE_RANK, conform_docs, make_ord
from lifecorpus.sources.common import file_lines, relative, stem

# FIXED VALUES: field and record separators of the log format.
FIELD_SEP = "\x1f"
RECORD_SEP = "\x1e"


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return file_lines(spark, root, "*.gitlog", line_sep=RECORD_SEP)


def parse_commits(raw: DataFrame, root: str = "", s=None) -> DataFrame:
    """Records of hash, date and message, or of hash, date, author's address and message;
    of the latter only the owner's are kept (all of them without settings)."""
    parts = F.split(py_strip(F.col("value")), FIELD_SEP, -1)
    x = raw.withColumn("p", parts).where(F.size("p").isin(3, 4))
    x = x.withColumn("message", F.element_at("p", -1)).where(py_strip("message") != "")
    if s is not None:
        x = x.where((F.size("p") == 3) | F.lower(py_strip(F.col("p")[2])).isin(list(s.emails)))
    repo = stem(F.col("path"))
    rel = relative(F.col("path"), root) if root else F.col("path")
    return conform_docs(x.select(
        F.lit("git").alias("source"), F.col("p")[0].alias("doc_id"), F.col("p")[1].alias("timestamp"),
        F.concat(F.lit("Commit in "), repo).alias("title"), py_strip(F.col("message")).alias("text"),
        F.lit(True).alias("authored_by_me"), F.create_map(F.lit("repo"), repo).alias("meta"),
        make_ord(SOURCE_RANK["git"], F.split(rel, "/"), F.col("block"), F.col("pos")).alias("ord")))


def ingest_commits(spark: SparkSession, root: str, s=None) -> DataFrame:
    return parse_commits(read_commits(spark, root), root, s)
