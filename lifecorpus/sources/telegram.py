"""Telegram Desktop JSON export (result.json) -> Message 'telegram'.

The export is one JSON document (all chats, or a single chat); message text is
a string or an array of strings and {type, text} parts (T9), read as VARIANT.

Telegram writes one key or bracket a line, indented by a space a level, and JSON strings hold
no line breaks. So a file is read line by line (splittable: one long export is many tasks):
running counts of the lines that open a key of the document, a chat and a message tell to which
each line belongs, and every message is parsed by itself. Files of any other layout
are put together and parsed whole."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.identity import is_me
from lifecorpus.functions.text import clean_chat
from lifecorpus.functions.times import iso_epoch
from lifecorpus.operators.filters import keep_if
from lifecorpus.operators.segmented import POS, SEG, running_sums
from lifecorpus.schema import MESSAGES, SOURCE_RANK, make_ord, of_kind, records
from lifecorpus.session import written
from lifecorpus.settings import Settings
from lifecorpus.sources.common import BAD_JSON, file_lines, json_error, relative

FIELDS = ["type", "from", "from_id", "date", "date_unixtime"]
MESSAGE_FIELDS = ", ".join(f"`{f}`: string" for f in FIELDS) + ", text: variant"
MSG = f"array<struct<{MESSAGE_FIELDS}>>"
CHAT = f"struct<id: variant, name: string, messages: {MSG}>"
EXPORT = (f"struct<personal_information: struct<user_id: variant>, chats: struct<list: array<{CHAT}>>,"
          f" id: variant, name: string, messages: {MSG}, _corrupt_record: string>")


def flatten_text(t: Column) -> Column:
    """A string as is; an array joined from its strings and parts' 'text'."""
    arr = F.try_variant_get(t, "$", "array<variant>")
    joined = F.array_join(F.transform(arr, lambda e: F.when(
        F.schema_of_variant(e).startswith("OBJECT"),
        F.coalesce(F.try_variant_get(e, "$.text", "string"), F.lit(""))
    ).otherwise(F.coalesce(F.try_variant_get(e, "$", "string"), F.lit("")))), "")
    return F.coalesce(F.when(arr.isNotNull(), joined), F.try_variant_get(t, "$", "string"), F.lit(""))


def _vstr(v: Column) -> Column:
    """Python str() of a JSON scalar (ints stay ints)."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("None"))


def read_telegram(spark: SparkSession, root: str) -> DataFrame:
    return file_lines(spark, root, "result.json")


def _sent(m: DataFrame, s: Settings, root: str) -> DataFrame:
    """Records of (path, me_id, ci, cid, cname, mi, m, error): the messages, and a reject for each error."""
    failed = F.col("error").isNotNull()
    m = keep_if(m.withColumn("flat", flatten_text(F.col("m.text"))), failed | (F.col("m.type") == "message") & (F.col("flat") != ""))
    sender = F.coalesce(F.col("m.from"), F.lit(""))
    unix = F.col("m.date_unixtime")
    ts = F.when(F.coalesce(unix, F.lit("")) != "", iso_epoch(unix.try_cast("long"))) \
        .otherwise(F.coalesce(F.col("m.date"), F.lit("")))
    title = F.coalesce(F.when(F.col("cname") != "", F.col("cname")), F.col("cid"))
    rel = relative(F.col("path"), root) if root else F.col("path")
    return records(m.select(
        F.lit("telegram").alias("source"), F.col("cid").alias("thread_id"), ts.alias("timestamp"),
        sender.alias("sender"),
        ((F.coalesce(F.col("m.from_id"), F.lit("")) == F.col("me_id")) | is_me(sender, s)).alias("is_me"),
        clean_chat(F.col("flat")).alias("text"), title.alias("thread_title"),
        F.array().cast("array<string>").alias("participants"),
        make_ord(SOURCE_RANK["telegram"], F.split(rel, "/"), F.col("ci"), F.col("mi")).alias("ord"), "path", "error"), MESSAGES)


def _from_documents(raw: DataFrame) -> DataFrame:
    """(path, me_id, ci, cid, cname, mi, m, error) of raw (path, content), whole documents."""
    d = raw.select("path", F.from_json("content", EXPORT).alias("d"))
    found = F.coalesce(F.col("d.chats.list").isNotNull() | F.col("d.messages").isNotNull(), F.lit(False))
    d = d.withColumn("error", json_error(F.col("d"), found))
    me_id = F.concat(F.lit("user"), F.coalesce(F.try_variant_get("d.personal_information.user_id", "$", "string"),
                                               F.lit("")))
    single = F.array(F.struct(F.col("d.id").alias("id"), F.col("d.name").alias("name"),
                              F.col("d.messages").alias("messages")))
    chats = F.when(F.coalesce(F.size("d.chats.list"), F.lit(0)) > 0, F.col("d.chats.list")).otherwise(single)
    c = d.select("path", me_id.alias("me_id"), F.posexplode(chats).alias("ci", "chat"), "error")
    return c.select("path", "me_id", "ci", _vstr(F.col("chat.id")).alias("cid"), F.col("chat.name").alias("cname"),
                    F.posexplode_outer("chat.messages").alias("mi", "m"), "error")


def telegram_records(raw: DataFrame, s: Settings, root: str = "") -> DataFrame:
    """raw: (path, content), whole documents."""
    return _sent(_from_documents(raw), s, root)


# ---------------------------------------------------------------------------
# FIXED VALUES (the export's layout): lines that open a chat and a message of an export of all
# chats, and a message of a single chat's; the lines of a message begin like its first one.
CHAT_OPENS, MESSAGE_OPENS, SINGLE_OPENS = "   {", "     {", "  {"
# End of fixed values
# ---------------------------------------------------------------------------


def _scalar(raw: Column) -> Column:
    """The JSON scalar that a line's value is written as."""
    return F.get_json_object(F.concat(F.lit('{"v": '), raw, F.lit("}")), "$.v")


def _value(line: Column, indent: int, name: str) -> Column:
    """The value that a line gives to a key, null for other lines."""
    pattern = f'^ {{{indent}}}"{name}": (.*?),?$'
    return F.when(line.rlike(pattern), _scalar(F.regexp_extract(line, pattern, 1)))


def telegram_line_records(lines: DataFrame, s: Settings, root: str = "", order: tuple[str, ...] = ("block", "pos"),
                          segments: int | None = None) -> DataFrame:
    """lines: (path, ``order``..., value). Files that Telegram laid out are taken apart by lines;
    others are put together and go the way of whole documents. Of a file that is cut off,
    the messages before the cut are kept, and the file is a reject."""
    v, place = F.col("value"), F.struct(*order)
    x = running_sums(lines.select("path", *order, "value"), ["path"], list(order), {
        "part": v.rlike('^ "').cast("int"), "ci": (v == CHAT_OPENS).cast("int"),
        "m_all": (v == MESSAGE_OPENS).cast("int"), "m_one": (v == SINGLE_OPENS).cast("int")}, segments)

    # a row for each file, from its first and last line and the lines that give keys and attributes
    key = F.when(v.rlike('^ "'), F.regexp_extract("value", '^ "([^"]*)"', 1))  # indented by one space
    facts = x.where(F.trim("value") != "").groupBy("path").agg(
        F.min_by("value", place).alias("begins"), F.max_by("value", place).alias("ends"),
        *[F.max(F.when(key == k, F.col("part"))).alias(f"in_{k}") for k in ("chats", "messages", "personal_information")],
        F.max(_value(v, 1, "id")).alias("one_id"), F.max(_value(v, 1, "name")).alias("one_name"),
        F.max("part").alias("keys"))
    # a chat opens in the part of the chats, not only in those of contacts and left chats
    opened = x.where(v == CHAT_OPENS).select("path", "part").distinct().join(
        facts.select("path", F.col("in_chats").alias("part")), ["path", "part"]).select("path", F.lit(True).alias("full"))
    info = x.where(v.rlike('^ {2}"user_id": ')).select("path", "part", _value(v, 2, "user_id").alias("me")).join(
        facts.select("path", F.col("in_personal_information").alias("part")), ["path", "part"]).groupBy("path").agg(F.max("me").alias("me"))
    # written: what follows reads a table of known size, and the scan is not planned again under each join
    files = written(facts.join(opened, "path", "left").join(info, "path", "left").select(
        "path", ((F.col("begins") == "{") & (F.col("keys") > 0)).alias("laid"), (F.col("ends") == "}").alias("closed"),
        F.coalesce("full", F.lit(False)).alias("full"), "in_chats", "in_messages", "one_id", "one_name",
        F.concat(F.lit("user"), F.coalesce("me", F.lit(""))).alias("me_id")), "telegram-files")
    x = x.join(files.select("path", "laid", "full", "in_chats", "in_messages"), "path")

    other = x.where(~F.col("laid")).groupBy("path").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(*order, "value"))), lambda e: e["value"]), "\n").alias("content"))
    in_chats = F.col("laid") & F.col("full") & (F.col("part") == F.col("in_chats")) & (F.col("ci") > 0)
    chats = x.where(in_chats & v.rlike('^ {4}"(?:id|name)": ')).groupBy("path", "ci").agg(
        F.max(_value(v, 4, "id")).alias("cid"), F.max(_value(v, 4, "name")).alias("cname"))
    of_chats = in_chats & (F.col("m_all") > 0) & v.startswith(MESSAGE_OPENS[:-1])
    of_one = F.col("laid") & ~F.col("full") & (F.col("part") == F.col("in_messages")) & (F.col("m_one") > 0) & v.startswith(SINGLE_OPENS[:-1])
    own = x.where(of_chats | of_one).select("path", F.when(F.col("full"), F.col("ci")).otherwise(_long(0)).alias("ci"),
                                            F.when(F.col("full"), F.col("m_all")).otherwise(F.col("m_one")).alias("mi"), SEG, POS, "value")
    # the lines of each message, joined per segment and then over segments, in one exchange
    pieces = own.repartition("path", "ci", "mi").groupBy("path", "ci", "mi", SEG).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(POS, "value"))), lambda e: e["value"]), "\n").alias("piece"))
    whole = pieces.groupBy("path", "ci", "mi").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(SEG, "piece"))), lambda e: e["piece"]), "\n").alias("json"))
    parsed = F.from_json(F.regexp_replace("json", r",\s*\z", ""), f"struct<{MESSAGE_FIELDS}, _corrupt_record: string>")
    m = whole.select("path", "ci", "mi", parsed.alias("p"))
    m = m.select("path", "ci", "mi", F.struct(*[F.col("p")[f].alias(f) for f in [*FIELDS, "text"]]).alias("m"),
                 json_error(F.col("p"), F.coalesce(F.col("p.type").isNotNull(), F.lit(False))).alias("error"))
    m = m.join(files, "path").join(chats, ["path", "ci"], "left")
    none = F.lit("None")  # as an absent id is written
    sent = m.select("path", "me_id", "ci", F.coalesce(F.when(F.col("full"), F.col("cid")).otherwise(F.col("one_id")), none).alias("cid"),
                    F.when(F.col("full"), F.col("cname")).otherwise(F.col("one_name")).alias("cname"), "mi", "m",
                    F.when(F.col("closed"), F.col("error")).alias("error"))  # a file that is cut off is one reject
    cut = files.where("laid and not closed").select(
        "path", "me_id", *[F.lit(None).cast(sent.schema[c].dataType).alias(c) for c in ("ci", "cid", "cname", "mi", "m")],
        F.lit(BAD_JSON).alias("error"))
    return _sent(sent.unionByName(cut).unionByName(_from_documents(other)), s, root)


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def parse_telegram(raw: DataFrame, s: Settings, root: str = "") -> DataFrame:
    return of_kind(telegram_records(raw, s, root), MESSAGES)


def telegram_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return telegram_line_records(read_telegram(spark, root), s, root)
