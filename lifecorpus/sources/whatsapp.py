"""WhatsApp chat exports (*.txt) -> Message 'whatsapp'.

Files are read line by line (splittable, so one long chat is many tasks).
A header line starts a message; other lines continue the previous message;
lines before the first header are dropped. Message numbers are a running
count of header lines in file order (gaps and islands, segmented scan)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.identity import is_me
from lifecorpus.functions.text import clean_chat
from lifecorpus.functions.times import iso
from lifecorpus.operators.segmented import POS, SEG, running_sum
from lifecorpus.schema import SOURCE_RANK, conform_messages, make_ord
from lifecorpus.settings import Settings
from lifecorpus.sources.common import file_lines, relative, stem

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# Header line: optional LRM, optional '[', date, time (opt. seconds, opt. am/pm),
# optional ']', optional ' -' or ':', then 'sender: text'.
HEADER = (r"^\x{200e}?\[?(\d{1,4}[./-]\d{1,2}[./-]\d{1,4}),? "
          r"(\d{1,2}:\d{2}(?::\d{2})?(?:\s?[APap]\.?[Mm]\.?)?)\]?(?: -|:)? ([^:]{1,80}): (.*)$")
# Messages containing any of these are system lines.
SYSTEM = ["<Media omitted>", "<Multimedia pominięte>", "image omitted", "video omitted", "sticker omitted",
          "audio omitted", "This message was deleted", "Ta wiadomość została usunięta", "<attached:"]
# Date formats tried in this order (day-first wins on ambiguous dates).
DATE_FORMATS = ["%d.%m.%Y", "%d.%m.%y", "%d/%m/%Y", "%d/%m/%y", "%m/%d/%y", "%m/%d/%Y", "%Y-%m-%d"]
# File-name prefixes removed to get the thread name.
TITLE_PREFIXES = ["WhatsApp Chat with ", "Czat WhatsApp z "]
# Characters stripped around the sender name.
SENDER_STRIP = "‎ "
# End of fixed values
# ---------------------------------------------------------------------------

HEADER_RE = "(?U)" + HEADER
# Line breaks that str.splitlines() honours beyond the \n, \r, \r\n the text reader splits on.
EXTRA_BREAKS = r"[\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"

#: Header fields of a line, told apart from other lines by marks that no chat line begins with.
MARK = "\x01\x02"


def header_fields(line: Column) -> Column:
    """array(date, time, sender, text) of a header line, null for other lines: one match a line."""
    parts = F.split(F.regexp_replace(line, HEADER_RE, f"{MARK}$1{MARK}$2{MARK}$3{MARK}$4"), MARK, 5)
    return F.when(~line.startswith(MARK) & (F.size(parts) == 5) & (parts[0] == ""), F.slice(parts, 2, 4))


_DAY = r"(3[01]|[12]\d|0[1-9]|[1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"


def _date_parts(fmt: str, d: Column) -> tuple[Column, Column, Column, Column]:
    """(matches, year, month, day) of ``d`` under one strptime format."""
    tokens = {"%d": _DAY, "%m": _MONTH, "%Y": r"(\d{4})", "%y": r"(\d{2})"}
    pat, order = "^", []
    i = 0
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in tokens:
            pat += tokens[tok]
            order.append(tok)
            i += 2
        else:
            pat += "\\" + fmt[i]
            i += 1
    pat += "$"
    grp = {tok: F.regexp_extract(d, pat, k + 1) for k, tok in enumerate(order)}
    if "%Y" in grp:
        year = grp["%Y"].try_cast("int")
    else:
        yy = grp["%y"].try_cast("int")
        year = F.when(yy <= 68, yy + 2000).otherwise(yy + 1900)
    return d.rlike(pat), year, grp["%m"].try_cast("int"), grp["%d"].try_cast("int")


def parse_chat_datetime(d: Column, t: Column) -> Column:
    """First (date format x time format) that fits, as a timestamp (naive = UTC).
    Dots are removed from the time and any whitespace (fix Q16), am/pm upper-cased."""
    tt = F.upper(F.regexp_replace(F.replace(t, F.lit("."), F.lit("")), r"(?U)\s", ""))
    pm_form = tt.endswith("M")
    hms = F.regexp_extract(tt, r"^(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(AM|PM)?$", 0)
    h = F.regexp_extract(tt, r"^(\d{1,2}):", 1)
    mi = F.regexp_extract(tt, r"^\d{1,2}:(\d{1,2})", 1).try_cast("int")
    sec_s = F.regexp_extract(tt, r"^\d{1,2}:\d{1,2}:(\d{1,2})", 1)
    sec = F.when(sec_s == "", F.lit(0)).otherwise(sec_s.try_cast("int"))
    h24 = F.when(~pm_form & h.rlike(r"^(2[0-3]|[0-1]\d|\d)$"), h.try_cast("int"))
    h12 = F.when(pm_form & h.rlike(r"^(1[0-2]|0[1-9]|[1-9])$") & tt.rlike("(AM|PM)$"),
                 h.try_cast("int") % 12 + F.when(tt.endswith("PM"), 12).otherwise(0))
    hour = F.when(hms != "", F.coalesce(h24, h12))
    ok_time = hour.isNotNull() & (mi < 60) & (sec < 60)
    candidates = []
    for fmt in DATE_FORMATS:
        m, y, mo, dd = _date_parts(fmt, d)
        candidates.append(F.when(m & ok_time, F.try_make_timestamp(y, mo, dd, hour, mi, sec, F.lit("UTC"))))
    return reduce(lambda a, b: F.coalesce(a, b), candidates)


def read_whatsapp(spark: SparkSession, root: str) -> DataFrame:
    return file_lines(spark, root, "*.txt")


def parse_whatsapp(raw: DataFrame, s: Settings, root: str = "") -> DataFrame:
    """raw: (path, block, pos, value) lines in file order."""
    # str.splitlines() also breaks on a few separators the line reader keeps.
    lines = raw.select("path", "block", "pos",
                       F.posexplode(F.split("value", EXTRA_BREAKS, -1)).alias("sub", "line"))
    lines = lines.withColumn("h", header_fields(F.col("line"))).withColumn("_hdr", F.col("h").isNotNull().cast("int"))
    lines = lines.withColumn("line", F.coalesce(F.col("h")[3], "line"))
    numbered = running_sum(lines, ["path"], ["block", "pos", "sub"], "_hdr", "msg_no")
    body = numbered.where(F.col("msg_no") > 0)
    hdr = F.col("_hdr") == 1
    # lines are joined per (message, segment), then the segments' parts, in one exchange: no list outgrows a segment
    pieces = F.array_sort(F.collect_list(F.struct(F.col(POS), "line")))
    parts = body.repartition("path", "msg_no").groupBy("path", "msg_no", SEG).agg(
        F.array_join(F.transform(pieces, lambda x: x["line"]), "\n").alias("piece"),
        F.max(F.when(hdr, F.col("h"))).alias("h"), F.min(F.struct("block", "pos", "sub")).alias("first"))
    whole = F.array_sort(F.collect_list(F.struct(F.col(SEG), "piece")))
    msgs = parts.groupBy("path", "msg_no").agg(
        F.array_join(F.transform(whole, lambda x: x["piece"]), "\n").alias("text"),
        F.max("h").alias("h"), F.min("first").alias("first"))
    msgs = msgs.select("path", "text", "first", F.col("h")[0].alias("d"), F.col("h")[1].alias("t"), F.col("h")[2].alias("sender_raw"))
    msgs = msgs.withColumn("sender", F.trim(F.col("sender_raw"), F.lit(SENDER_STRIP)))
    # A10: participants = sorted distinct senders of the file, before system
    # lines go; taken from the header lines (distinct, combined map-side) so
    # the per-message texts are aggregated only once.
    senders = numbered.where(hdr).select("path", F.trim(F.col("h")[2], F.lit(SENDER_STRIP)).alias("sender")).distinct()
    people = senders.groupBy("path").agg(F.array_sort(F.collect_list("sender")).alias("participants"))
    system = reduce(lambda a, b: a | b, [F.col("text").contains(x) for x in SYSTEM])
    msgs = msgs.where(~system).join(people, "path")
    thread = stem(F.col("path"))
    for p in TITLE_PREFIXES:
        thread = F.when(thread.startswith(p), F.substr(thread, F.lit(len(p) + 1))).otherwise(thread)
    rel = relative(F.col("path"), root) if root else F.col("path")
    return conform_messages(msgs.select(
        F.lit("whatsapp").alias("source"), thread.alias("thread_id"),
        iso(parse_chat_datetime(F.col("d"), F.col("t"))).alias("timestamp"),
        "sender", is_me(F.col("sender"), s).alias("is_me"), clean_chat(F.col("text")).alias("text"),
        thread.alias("thread_title"), "participants",
        make_ord(SOURCE_RANK["whatsapp"], F.split(rel, "/"), F.col("first")["block"],
                 F.col("first")["pos"], F.col("first")["sub"]).alias("ord")))


def ingest_whatsapp(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return parse_whatsapp(read_whatsapp(spark, root), s, root)
