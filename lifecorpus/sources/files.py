"""Documents from folders: notes (S4, the owner's) and Drive exports (S3), turned
into text by suffix (IO11).

Only files with a suffix that has text are listed; media beside them are never
opened. Sizes come from the listing, and the bytes of a file over ``MAX_BYTES``
are not read. Text suffixes are decoded in the JVM; .html/.htm go through the HTML
UDF (T3); .docx through a small Arrow UDF (stdlib zipfile + ElementTree). A file
that is too large or fails to decode becomes a reject (IO13)."""
from __future__ import annotations

import io
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from lifecorpus.functions.html import html_to_text_py
from lifecorpus.functions.text import normalize, redact
from lifecorpus.functions.times import iso
from lifecorpus.operators.filters import keep_if
from lifecorpus.schema import DOCS, SOURCE_RANK, make_ord, of_kind, records
from lifecorpus.sources.common import exists_nonempty, file_path, glob_of, relative

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
TEXT_SUFFIXES = [".txt", ".md", ".markdown", ".org", ".csv"]
HTML_SUFFIXES = [".html", ".htm"]
DOCX_SUFFIX = ".docx"
MIN_DOC_CHARS = 20
DRIVE_DIRS = ["drive", "dysk"]
# End of fixed values
# ---------------------------------------------------------------------------

#: A document is one row, and a row holds less than 2 GB: larger files are rejects.
MAX_BYTES = 1 << 30
TOO_LARGE = "larger than a document can be"
BAD_DOCX = "not a readable .docx file"
BINARY = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("content", T.BinaryType())])
DECODED = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text_py(data: bytes | None) -> tuple[str | None, str | None]:
    """Body paragraphs' text joined by newlines (runs: text, tabs, breaks)."""
    if data is None:
        return None, BAD_DOCX
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            root = ET.fromstring(z.read("word/document.xml"))
        body = root.find(f"{_W}body")
        paras = []
        for p in (body.findall(f"{_W}p") if body is not None else []):
            out = []
            for el in p.iter():
                if el.tag == f"{_W}t":
                    out.append(el.text or "")
                elif el.tag in (f"{_W}tab", f"{_W}ptab"):
                    out.append("\t")
                elif el.tag in (f"{_W}br", f"{_W}cr"):
                    out.append("\n")
                elif el.tag == f"{_W}noBreakHyphen":
                    out.append("-")
            paras.append("".join(out))
        return "\n".join(paras), None
    except Exception:  # corrupt archives are common in old exports
        return None, BAD_DOCX


def _py_decode_batch(sfx: pd.Series, data: pd.Series) -> pd.DataFrame:
    """HTML (UTF-8 with replacement, then T3) and docx; other rows arrive as
    nulls and are passed over."""
    rows = []
    for x, b in zip(sfx, data):
        if b is None:
            rows.append((None, None))
        elif x == DOCX_SUFFIX:
            rows.append(docx_text_py(b))
        else:
            page = bytes(b).decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n")
            rows.append((html_to_text_py(page), None))
    return pd.DataFrame(rows, columns=["text", "error"])


def py_decode(sfx: Column, content: Column) -> Column:
    return F.pandas_udf(_py_decode_batch, DECODED)(sfx, content)


def read_files(spark: SparkSession, root: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, modificationTime, content) of every file under root whose suffix has text; the
    content of one over ``max_bytes`` is null. The suffixes are part of the listing, and the
    size is a filter that the scan applies before it opens a file."""
    if not exists_nonempty(spark, root):
        return spark.createDataFrame([], BINARY)
    try:
        df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", glob_of(TEXT_SUFFIXES + HTML_SUFFIXES + [DOCX_SUFFIX])).load(root))
    except AnalysisException:
        return spark.createDataFrame([], BINARY)
    small = df.where(F.col("length") <= max_bytes).select(file_path().alias("path"), "modificationTime", "content")
    large = df.where(F.col("length") > max_bytes).select(file_path().alias("path"), "modificationTime",
                                                         F.lit(None).cast("binary").alias("content"))
    return small.unionByName(large)


def suffix(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.when(name.rlike(r"[^.]\.[^./]*$"), F.regexp_extract(name, r"(\.[^.]*)$", 1)).otherwise(""))


def decode(df: DataFrame) -> DataFrame:
    """Adds text/error by suffix; other suffixes (incl. .pdf, not built) give ''.
    Plain text is decoded in the JVM; only .html/.htm/.docx bytes are shipped to
    the Python decoder (other rows send a null)."""
    sfx = suffix(F.col("path"))
    needs_py = sfx.isin(HTML_SUFFIXES + [DOCX_SUFFIX])
    d = df.withColumn("_py", py_decode(sfx, F.when(needs_py, F.col("content"))))
    plain = F.make_valid_utf8(F.col("content").cast("string"))
    text = (F.when(sfx.isin(TEXT_SUFFIXES), F.regexp_replace(plain, "\r\n?", "\n"))
            .when(needs_py, F.col("_py.text"))
            .otherwise(F.lit("")))
    error = F.when(F.col("content").isNull(), F.lit(TOO_LARGE)).otherwise(F.col("_py.error"))
    return d.withColumn("text", text).withColumn("error", error).drop("_py")


def _visible(rel: Column) -> Column:
    return ~F.exists(F.split(rel, "/"), lambda p: p.startswith("."))


def file_records(raw: DataFrame, root: str, source: str, authored_by_me: bool, drive: bool = False,
                 max_chars: int | None = None) -> DataFrame:
    """Documents and rejects of raw (path, modificationTime, content). For Drive, only files
    below a folder named drive/dysk count, relative to the outermost such folder. Texts
    are kept whole unless ``max_chars`` is given."""
    rel = relative(F.col("path"), root)
    x = raw.withColumn("rel", rel).where(_visible(F.col("rel")))
    if drive:
        parts = F.split("rel", "/")
        idx = F.array_position(F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.lower(p)
                                           .isin(DRIVE_DIRS).cast("int")), 1)
        x = x.withColumn("_i", idx).where(F.col("_i") > 0) \
            .withColumn("rel", F.array_join(F.slice(F.split("rel", "/"), (F.col("_i") + 1).cast("int"),
                                                    F.size(F.split("rel", "/"))), "/")).drop("_i")
    d = decode(x)
    text = normalize(redact(F.col("text")))
    text = text if max_chars is None else F.substring(text, 1, max_chars)
    d = keep_if(d.withColumn("text", text), F.col("error").isNotNull() | (F.length("text") >= MIN_DOC_CHARS))
    name = F.element_at(F.split("rel", "/"), -1)
    title = F.when(name.rlike(r"[^.]\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    return records(d.select(
        F.lit(source).alias("source"), F.col("rel").alias("doc_id"), iso(F.col("modificationTime")).alias("timestamp"),
        title.alias("title"), "text", F.lit(authored_by_me).alias("authored_by_me"),
        make_ord(SOURCE_RANK[source], F.split("path", "/"), F.lit(0), F.lit(0)).alias("ord"), "path", "error"), DOCS)


def parse_files(raw: DataFrame, root: str, source: str, authored_by_me: bool, drive: bool = False,
                max_chars: int | None = None) -> DataFrame:
    return of_kind(file_records(raw, root, source, authored_by_me, drive, max_chars), DOCS)


def notes_job(spark: SparkSession, root: str, s=None) -> DataFrame:
    return file_records(read_files(spark, root), root, "notes", True, max_chars=s.max_doc_chars if s else None)


def drive_job(spark: SparkSession, root: str, s=None) -> DataFrame:
    return file_records(read_files(spark, root), root, "drive", False, drive=True,
                        max_chars=s.max_doc_chars if s else None)


def ingest_notes(spark: SparkSession, root: str, s=None) -> DataFrame:
    return of_kind(notes_job(spark, root, s), DOCS)


def ingest_drive(spark: SparkSession, root: str, s=None) -> DataFrame:
    return of_kind(drive_job(spark, root, s), DOCS)
