"""Shared scan helpers for export folders: whole-file and line scans that keep
the path, and an order key that sorts like the reference's file walk."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

WHOLE = T.StructType([T.StructField("path", T.StringType()), T.StructField("content", T.StringType())])
LINES = T.StructType([T.StructField("path", T.StringType()), T.StructField("block", T.LongType()),
                      T.StructField("pos", T.LongType()), T.StructField("value", T.StringType())])


def exists_nonempty(spark: SparkSession, root: str) -> bool:
    """IO4: the folder exists and has at least one entry (driver-side listing)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and len(fs.listStatus(p)) > 0


def file_path() -> Column:
    """Decoded local path of the row's file ('+' protected from form decoding)."""
    raw = F.regexp_replace(F.col("_metadata.file_path"), "^file:(//)?", "")
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def relative(path: Column, root: str) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))).otherwise(path)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def glob_of(suffixes: list[str]) -> str:
    """A listing pattern for file names that end in one of ``suffixes``, in any case."""
    def any_case(c: str) -> str:
        return f"[{c.lower()}{c.upper()}]" if c.isalpha() else c
    return "*{" + ",".join("".join(any_case(c) for c in x) for x in suffixes) + "}"


#: Reasons of rejected files.
BAD_JSON = "not valid JSON"


def json_body(content: Column) -> Column:
    """The text of a JSON file without the white space before it."""
    return F.ltrim(F.coalesce(content, F.lit("")), F.lit(" \t\r\n"))


def json_error(parsed: Column, found: Column) -> Column:
    """The reject reason of a file read with ``from_json`` into a struct that has a
    ``_corrupt_record``: nothing was ``found`` in it and it is no valid JSON. Fields that are
    only of another type than expected do not reject a file."""
    return F.when(~found & (parsed.isNull() | parsed["_corrupt_record"].isNotNull()), F.lit(BAD_JSON))


def whole_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """One row per file: (path, content). For formats that are one document
    per file (JSON, JS, ICS, CSV with quoted newlines)."""
    if not exists_nonempty(spark, root):
        return spark.createDataFrame([], WHOLE)
    try:
        df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
              .text(root, wholetext=True))
    except AnalysisException:
        return spark.createDataFrame([], WHOLE)
    return df.select(file_path().alias("path"), F.col("value").alias("content"))


def file_lines(spark: SparkSession, root: str, glob: str, line_sep: str | None = None) -> DataFrame:
    """One row per line (or per ``line_sep`` record), splittable: (path, block,
    pos, value); (path, block, pos) sorts in file order."""
    if not exists_nonempty(spark, root):
        return spark.createDataFrame([], LINES)
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if line_sep:
        r = r.option("lineSep", line_sep)
    try:
        df = r.text(root)
    except AnalysisException:
        return spark.createDataFrame([], LINES)
    return df.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"), "value")
