"""Public writing and DMs: X (S16 tweets, S17 DMs), Reddit (S18, S19),
LinkedIn (S20-S23) and Facebook posts/comments (S13).

Social docs are normalized but not redacted (the reference keeps them as
written, quirk Q8); direct messages are redacted."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.identity import is_me
from lifecorpus.functions.text import clean_chat, fix_mojibake, normalize
from lifecorpus.functions.times import iso, iso_epoch
from lifecorpus.schema import DOCS, MESSAGES, REJECTS, SOURCE_RANK, make_ord, of_kind, records
from lifecorpus.session import written
from lifecorpus.settings import Settings
from lifecorpus.sources.common import BAD_JSON, exists_nonempty, file_path, json_body, json_error, relative, whole_files

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
RETWEET_PREFIX = "RT @"
REDDIT_SKIP_BODIES = ["", "[deleted]", "[removed]"]
POSITION_OPEN_END = "now"
# End of fixed values
# ---------------------------------------------------------------------------


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def js_array(content: Column) -> Column:
    """IO9: 'window.X = [ ... ]' -> the JSON text from the first '['."""
    return F.substr(content, F.instr(content, "["))


def js_items(content: Column, schema: str) -> Column:
    """The items of an IO9 file; null if it holds no valid JSON array."""
    return F.when(F.instr(content, "[") > 0, F.from_json(js_array(content), schema))


def list_error(items: Column) -> Column:
    return F.when(items.isNull(), F.lit(BAD_JSON))


# --- X / Twitter -----------------------------------------------------------------

TWEET_FIELDS = ("id_str: string, full_text: string, text: string, created_at: string, "
                "in_reply_to_screen_name: string")
TWEETS = f"array<struct<tweet: struct<{TWEET_FIELDS}>, {TWEET_FIELDS}>>"
DMS = ("array<struct<dmConversation: struct<conversationId: string, messages: array<struct<"
       "messageCreate: struct<createdAt: string, senderId: string, text: string>>>>>>")
ACCOUNTS = "array<struct<account: struct<accountId: string>>>"


def tweet_time(created_at: Column) -> Column:
    """'EEE MMM dd HH:mm:ss Z yyyy' -> ISO UTC (the weekday is skipped: Spark
    does not parse 'EEE')."""
    return iso(F.try_to_timestamp(F.substr(created_at, F.lit(5)), F.lit("MMM dd HH:mm:ss Z yyyy")))


def read_twitter(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (whole_files(spark, root, "tweet*.js"), whole_files(spark, root, "direct-messages*.js"),
            whole_files(spark, root, "account.js"))


def tweet_records(raw: DataFrame, root: str = "") -> DataFrame:
    files = raw.where(~F.element_at(F.split("path", "/"), -1).contains("deleted"))
    files = files.select("path", js_items(F.col("content"), TWEETS).alias("items"))
    items = files.select("path", list_error(F.col("items")).alias("error"), F.posexplode_outer("items").alias("i", "it"))
    failed = F.col("error").isNotNull()
    has_tweet = F.col("it.tweet").isNotNull()
    g = (lambda n: F.when(has_tweet, F.col(f"it.tweet.{n}")).otherwise(F.col(f"it.{n}")))
    text = F.coalesce(_nz(g("full_text")), g("text"), F.lit(""))
    x = items.select("path", "i", "it", text.alias("text"), g("id_str").alias("id_str"),
                     g("created_at").alias("created_at"), g("in_reply_to_screen_name").alias("reply_to"), "error")
    x = x.where(failed | F.col("it").isNotNull() & ~F.col("text").startswith(RETWEET_PREFIX))
    rel = relative(F.col("path"), root) if root else F.col("path")
    return records(x.select(
        F.lit("twitter").alias("source"), F.coalesce("id_str", F.lit("")).alias("doc_id"),
        tweet_time(F.col("created_at")).alias("timestamp"), F.lit("Tweet").alias("title"),
        normalize(F.col("text")).alias("text"), F.lit(True).alias("authored_by_me"),
        F.create_map(F.lit("reply_to"), F.col("reply_to")).alias("meta"),
        make_ord(SOURCE_RANK["twitter"], F.split(rel, "/"), F.lit(0), F.col("i")).alias("ord"), "path", "error"), DOCS)


def parse_tweets(raw: DataFrame, root: str = "") -> DataFrame:
    return of_kind(tweet_records(raw, root), DOCS)


def x_dm_records(dms: DataFrame, accounts: DataFrame, s: Settings, root: str = "") -> DataFrame:
    """The owner's account ids (one per archive) are matched against sender ids."""
    ids = accounts.select(F.explode(js_items(F.col("content"), ACCOUNTS)).alias("a")) \
        .select(F.col("a.account.accountId").alias("my_id")).where(F.col("my_id").isNotNull()).distinct()
    conv = dms.select("path", js_items(F.col("content"), DMS).alias("items"))
    conv = conv.select("path", list_error(F.col("items")).alias("error"), F.posexplode_outer("items").alias("ci", "c"))
    m = conv.select("path", "ci", F.col("c.dmConversation.conversationId").alias("thread_id"), "error",
                    F.posexplode_outer("c.dmConversation.messages").alias("mi", "m")) \
        .where(F.col("error").isNotNull() | F.col("m.messageCreate").isNotNull())
    m = m.select("path", "ci", "mi", "thread_id", "error", F.col("m.messageCreate.*"))
    m = m.join(ids, F.col("senderId") == F.col("my_id"), "left")
    rel = relative(F.col("path"), root) if root else F.col("path")
    return records(m.select(
        F.lit("twitter_dm").alias("source"), "thread_id", F.col("createdAt").alias("timestamp"),
        F.col("senderId").alias("sender"), F.col("my_id").isNotNull().alias("is_me"),
        clean_chat(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
        F.lit("").alias("thread_title"), F.array().cast("array<string>").alias("participants"),
        make_ord(SOURCE_RANK["twitter_dm"], F.split(rel, "/"), F.col("ci"), F.col("mi")).alias("ord"), "path", "error"), MESSAGES)


def parse_x_dms(dms: DataFrame, accounts: DataFrame, s: Settings, root: str = "") -> DataFrame:
    return of_kind(x_dm_records(dms, accounts, s, root), MESSAGES)


def account_rejects(accounts: DataFrame) -> DataFrame:
    """Account files (one per archive, a few hundred bytes) that cannot be read: without one the
    owner's messages are not recognised."""
    bad = accounts.select(F.lit("twitter").alias("source"), "path",
                          list_error(js_items(F.col("content"), ACCOUNTS)).alias("error"))
    return records(bad.where(F.col("error").isNotNull()), REJECTS)


def twitter_records(tweets: DataFrame, dms: DataFrame, accounts: DataFrame, s: Settings, root: str = "") -> DataFrame:
    return x_dm_records(dms, accounts, s, root).unionByName(tweet_records(tweets, root)).unionByName(account_rejects(accounts))


def twitter_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return twitter_records(*read_twitter(spark, root), s, root)


def ingest_twitter(spark: SparkSession, root: str, s: Settings) -> tuple[DataFrame, DataFrame]:
    job = twitter_job(spark, root, s)
    return of_kind(job, MESSAGES), of_kind(job, DOCS)


# --- CSV exports (Reddit, LinkedIn) -------------------------------------------------

CSV_RECORD = "path string, row long, cells array<string>, head array<string>, error string"
UNCLOSED = "a quote is not closed"
#: The reader's array of cells, 8 bytes each in every task; a wider record stops the read.
MOST_CELLS = 1 << 20

#: Inside quotes, where a quote is doubled; and a cell with the comma before it: in quotes, then with
#: what stands between the closing one and the next comma, or without. Possessive: no way back, no stack.
QUOTED = r'"(?:[^"]++|"")*+'
CELL = rf',(?:{QUOTED}(?:"[^,]*+|\z)|(?:[^,"][^,]*+)?+)'


def split_record(record: Column) -> Column:
    """A CSV record of any width as struct(cells, open): quotes open only at the start of a cell,
    double inside one, and are letters elsewhere; ``open`` if the last one is not closed.

    One pass of a pattern finds the cells, each is unquoted on its own: linear in the record."""
    def value(t: Column) -> Column:
        inside = F.replace(F.regexp_extract(t, r'^,"((?:[^"]++|"")*+)', 1), F.lit('""'), F.lit('"'))
        return F.when(t.startswith(',"'), F.concat(inside, F.regexp_extract(t, rf'^,{QUOTED}"([^,]*+)', 1))) \
            .otherwise(F.substr(t, F.lit(2)))

    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), F.lit(0))
    # through an array of one: found once, though both fields are taken from it
    return F.transform(F.array(found), lambda ts: F.struct(
        F.transform(ts, value).alias("cells"), F.element_at(ts, -1).rlike(rf"^,{QUOTED}\z").alias("open")))[0]


def csv_records(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, row, record) of every file called ``name`` under root: the text of each record, with its
    quoted line breaks. The reader finds where records end; it is not told their width."""
    # a record of more cells than the schema has is kept as text, a single cell is read without its quotes
    rows = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name)
            .option("header", False).option("multiLine", True).option("escape", '"').option("maxColumns", MOST_CELLS)
            .schema("cell string, record string").option("columnNameOfCorruptRecord", "record").csv(root))
    quoted = F.concat(F.lit('"'), F.replace("cell", F.lit('"'), F.lit('""')), F.lit('"'))
    return rows.select(file_path().alias("path"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce("record", quoted).alias("record")).where(F.col("record").isNotNull())


def read_csv_records(spark: SparkSession, root: str, name: str) -> DataFrame:
    """IO10: the records (path, row, cells, head, error) of every file called ``name`` under root,
    beside its header; quoted newlines and BOM are read, empty cells are null. A record with a
    quote that is not closed (it takes the rest of its file) has an error and no cells."""
    if not exists_nonempty(spark, root):
        return spark.createDataFrame([], CSV_RECORD)
    read = written(csv_records(spark, root, name), "csv")  # the reader's pass over the files is made once

    def split(records: DataFrame) -> DataFrame:
        r = records.withColumn("r", split_record(F.regexp_replace("record", "^\ufeff", "")))
        return r.select("path", "row", F.when(F.col("r.open"), F.lit(UNCLOSED)).alias("error"),
                        F.when(~F.col("r.open"), F.transform("r.cells", _nz)).alias("cells"))

    # files of one name may order their columns differently: each has its own header, found by one
    # number a file, of the files that the driver has listed: only their first records are split for it
    first = read.groupBy("path").agg(F.min("row").alias("row")).select("row")
    head = split(read.join(F.broadcast(first), "row")).select("path", F.col("row").alias("first"), F.col("cells").alias("head"))
    rows = split(read)
    return rows.join(head, "path").where((F.col("row") > F.col("first")) | F.col("error").isNotNull()) \
        .select("path", "row", "cells", "head", "error")


def read_csv_rows(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    """(path, row, error, <columns>) with '' for empty cells and null for columns the file
    does not have (as a dict lookup in the reference would)."""
    def cell(c: str) -> Column:
        at = F.array_position("head", c)
        return F.when(at > 0, F.coalesce(F.get("cells", (at - 1).cast("int")), F.lit(""))).alias(c)

    return read_csv_records(spark, root, name).select("path", "row", "error", *[cell(c) for c in columns])


def with_error(rows: DataFrame) -> DataFrame:
    """Rows that a reader has not checked have no error."""
    return rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast("string"))


REDDIT_COLUMNS = ["id", "date", "subreddit", "title", "body"]


def reddit_records(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows (path, row, id, date, subreddit, title, body)."""
    def docs(rows, kind, k):
        rows = with_error(rows)
        body = F.coalesce(F.col("body"), F.lit(""))
        title = F.coalesce(_nz(F.col("title")), F.concat(F.lit("r/"), F.coalesce("subreddit", F.lit("")),
                                                          F.lit(" " + kind)))
        if kind == "comment":
            rows = rows.where(F.col("error").isNotNull() | ~body.isin(REDDIT_SKIP_BODIES))
            text = body
        else:
            text = F.concat(title, F.lit("\n\n"), body)
        return rows.select(
            F.lit("reddit").alias("source"), F.coalesce("id", F.lit("")).alias("doc_id"),
            F.coalesce("date", F.lit("")).alias("timestamp"), title.alias("title"), normalize(text).alias("text"),
            F.lit(True).alias("authored_by_me"),
            F.create_map(F.lit("subreddit"), F.col("subreddit"), F.lit("kind"), F.lit(kind)).alias("meta"),
            make_ord(SOURCE_RANK["reddit"], F.split("path", "/"), F.lit(k), F.col("row")).alias("ord"), "path", "error")
    return records(docs(comments, "comment", 0).unionByName(docs(posts, "post", 1)), DOCS)


def parse_reddit(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return of_kind(reddit_records(comments, posts), DOCS)


def reddit_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return reddit_records(read_csv_rows(spark, root, "comments.csv", REDDIT_COLUMNS),
                          read_csv_rows(spark, root, "posts.csv", REDDIT_COLUMNS))


def ingest_reddit(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return of_kind(reddit_job(spark, root, s), DOCS)


LI_MESSAGES = ["CONVERSATION ID", "CONVERSATION TITLE", "FROM", "DATE", "SUBJECT", "CONTENT"]
LI_SHARES = ["Date", "ShareLink", "ShareCommentary"]
LI_POSITIONS = ["Company Name", "Title", "Description", "Started On", "Finished On"]


def linkedin_message_records(rows: DataFrame, s: Settings) -> DataFrame:
    """DATE kept verbatim; title = conversation title, else subject."""
    sender = F.coalesce(F.col("FROM"), F.lit(""))
    return records(with_error(rows).select(
        F.lit("linkedin").alias("source"), F.coalesce("`CONVERSATION ID`", F.lit("")).alias("thread_id"),
        F.coalesce("DATE", F.lit("")).alias("timestamp"), sender.alias("sender"),
        is_me(sender, s).alias("is_me"), clean_chat(F.coalesce("CONTENT", F.lit(""))).alias("text"),
        F.coalesce(_nz(F.col("`CONVERSATION TITLE`")), F.col("SUBJECT"), F.lit("")).alias("thread_title"),
        F.array().cast("array<string>").alias("participants"),
        make_ord(SOURCE_RANK["linkedin"], F.split("path", "/"), F.lit(0), F.col("row")).alias("ord"), "path", "error"), MESSAGES)


def parse_linkedin_messages(rows: DataFrame, s: Settings) -> DataFrame:
    return of_kind(linkedin_message_records(rows, s), MESSAGES)


def linkedin_share_records(rows: DataFrame) -> DataFrame:
    """Posts with non-empty commentary."""
    r = with_error(rows).where(F.col("error").isNotNull() | (F.coalesce(F.col("ShareCommentary"), F.lit("")) != ""))
    return records(r.select(
        F.lit("linkedin").alias("source"), F.coalesce("ShareLink", F.lit("")).alias("doc_id"),
        F.coalesce("Date", F.lit("")).alias("timestamp"), F.lit("LinkedIn post").alias("title"),
        normalize(F.col("ShareCommentary")).alias("text"), F.lit(True).alias("authored_by_me"),
        make_ord(SOURCE_RANK["linkedin"], F.split("path", "/"), F.lit(1), F.col("row")).alias("ord"), "path", "error"), DOCS)


def parse_linkedin_shares(rows: DataFrame) -> DataFrame:
    return of_kind(linkedin_share_records(rows), DOCS)


def linkedin_profile_records(rows: DataFrame) -> DataFrame:
    """One doc per profile row (path, row, cells, head), 'column: value' for
    every non-empty cell in header order."""
    pairs = F.filter(F.arrays_zip("head", "cells"),
                     lambda p: p["head"].isNotNull() & (F.coalesce(p["cells"], F.lit("")) != ""))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(p["head"], F.lit(": "), p["cells"])), "\n")
    return records(with_error(rows).select(
        F.lit("linkedin").alias("source"), F.lit("profile").alias("doc_id"), F.lit("").alias("timestamp"),
        F.lit("LinkedIn profile").alias("title"), text.alias("text"), F.lit(True).alias("authored_by_me"),
        make_ord(SOURCE_RANK["linkedin"], F.split("path", "/"), F.lit(2), F.col("row")).alias("ord"), "path", "error"), DOCS)


def parse_linkedin_profile(rows: DataFrame) -> DataFrame:
    return of_kind(linkedin_profile_records(rows), DOCS)


def linkedin_position_records(rows: DataFrame) -> DataFrame:
    """One doc per file, its rows folded in file order; a rejected record is a row of its own."""
    def cell(c):
        return F.coalesce(F.col(f"`{c}`"), F.lit("None"))
    line = F.concat(cell("Title"), F.lit(" at "), cell("Company Name"), F.lit(" ("), cell("Started On"),
                    F.lit(" – "), F.coalesce(_nz(F.col("`Finished On`")), F.lit(POSITION_OPEN_END)), F.lit("): "),
                    F.coalesce(F.col("Description"), F.lit("")))
    g = with_error(rows).groupBy("path", "error").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("row", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    return records(g.select(
        F.lit("linkedin").alias("source"), F.lit("positions").alias("doc_id"), F.lit("").alias("timestamp"),
        F.lit("Career history").alias("title"), "text", F.lit(True).alias("authored_by_me"),
        make_ord(SOURCE_RANK["linkedin"], F.split("path", "/"), F.lit(3), F.lit(0)).alias("ord"), "path", "error"), DOCS)


def parse_linkedin_positions(rows: DataFrame) -> DataFrame:
    return of_kind(linkedin_position_records(rows), DOCS)


def linkedin_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    parts = [linkedin_message_records(read_csv_rows(spark, root, "messages.csv", LI_MESSAGES), s),
             linkedin_share_records(read_csv_rows(spark, root, "Shares.csv", LI_SHARES)),
             linkedin_position_records(read_csv_rows(spark, root, "Positions.csv", LI_POSITIONS)),
             linkedin_profile_records(read_csv_records(spark, root, "Profile.csv"))]   # free-form columns
    return reduce(DataFrame.unionByName, parts)


def ingest_linkedin(spark: SparkSession, root: str, s: Settings) -> tuple[DataFrame, DataFrame]:
    job = linkedin_job(spark, root, s)
    return of_kind(job, MESSAGES), of_kind(job, DOCS)


# --- Facebook posts and comments --------------------------------------------------------

FB_ITEM = "struct<timestamp: long, title: string, data: array<map<string, string>>>"


def read_facebook_posts(spark: SparkSession, root: str) -> DataFrame:
    return whole_files(spark, root, "*.json")


def facebook_post_records(raw: DataFrame, root: str = "") -> DataFrame:
    """your_posts*.json (top-level list) and comments*.json ({comments_v2:
    [...]}), outside any 'messages' folder. kind = post when the item has a
    'post' key (presence, even if null), else comment."""
    rel = relative(F.col("path"), root) if root else F.col("path")
    name = F.element_at(F.split(rel, "/"), -1)
    f = raw.where(~F.array_contains(F.split(rel, "/"), "messages")
                  & (name.startswith("your_posts") | name.startswith("comments")))
    as_list = F.from_json("content", f"array<{FB_ITEM}>")
    as_obj = F.from_json("content", f"struct<comments_v2: array<{FB_ITEM}>, _corrupt_record: string>")
    is_list = json_body(F.col("content")).startswith("[")
    f = f.select("path", is_list.alias("is_list"), F.when(is_list, as_list).alias("l"), F.when(~is_list, as_obj).alias("o"))
    error = F.when(F.col("is_list"), list_error(F.col("l"))).otherwise(json_error(F.col("o"), F.col("o.comments_v2").isNotNull()))
    f = f.select("path", F.coalesce("l", "o.comments_v2").alias("items"), error.alias("error"))
    items = f.select("path", "error", F.posexplode_outer("items").alias("ii", "it"))
    d = items.select("path", "ii", "it.timestamp", "it.title", "error", F.posexplode_outer("it.data").alias("di", "d"))
    has_post = F.map_contains_key("d", "post")
    text = F.coalesce(_nz(F.col("d")["post"]), F.get_json_object(F.col("d")["comment"], "$.comment"))
    kind = F.when(has_post, F.lit("post")).otherwise(F.lit("comment"))
    x = d.select("path", "ii", "di", "timestamp", "title", text.alias("text"), kind.alias("kind"), "error") \
        .where(F.col("error").isNotNull() | (F.coalesce(F.col("text"), F.lit("")) != ""))
    return records(x.select(
        F.lit("facebook").alias("source"),
        F.concat(F.col("kind"), F.lit("-"), F.coalesce(F.col("timestamp").cast("string"), F.lit("None"))).alias("doc_id"),
        F.when(F.col("timestamp").isNull(), F.lit("")).otherwise(iso_epoch(F.col("timestamp"))).alias("timestamp"),
        fix_mojibake(F.coalesce(F.col("title"), F.concat(F.lit("Facebook "), F.col("kind")))).alias("title"),
        normalize(fix_mojibake(F.col("text"))).alias("text"), F.lit(True).alias("authored_by_me"),
        F.create_map(F.lit("kind"), F.col("kind")).alias("meta"),
        make_ord(SOURCE_RANK["facebook"], F.split(rel, "/"), F.col("ii"), F.col("di")).alias("ord"), "path", "error"), DOCS)


def parse_facebook_posts(raw: DataFrame, root: str = "") -> DataFrame:
    return of_kind(facebook_post_records(raw, root), DOCS)


def facebook_job(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return facebook_post_records(read_facebook_posts(spark, root), root)


def ingest_facebook_posts(spark: SparkSession, root: str, s: Settings) -> DataFrame:
    return of_kind(facebook_job(spark, root, s), DOCS)
