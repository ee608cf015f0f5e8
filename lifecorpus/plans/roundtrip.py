"""Round-trip queries: table rows are rendered in Spark into a source's raw
export shape (lines or whole files), then parsed back by the source job. The
oracle computes the expected records straight from the table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.plans.adapters import OWNER, BASE_EPOCH, sender_of
from lifecorpus.plans.tables import table
from lifecorpus.session import scratch
from lifecorpus.sources import whatsapp


def message_output(m: DataFrame) -> DataFrame:
    return m.select("source", "thread_id", "timestamp", "sender", "is_me", "text", "thread_title",
                    F.array_join("participants", ", ").alias("participants"))


def chat_turns(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns with sender, time and text."""
    c = table(spark, d, "conversations")
    secs = F.lit(BASE_EPOCH) + F.col("conv_id") * 86400 + F.col("turn") * 420 + F.floor(F.col("turn") / 3) * 18000
    return c.select("conv_id", "turn", sender_of(F.col("role"), F.col("turn")).alias("sender"),
                    F.timestamp_seconds(secs).alias("ts"), "text")


def one_row(spark: SparkSession) -> DataFrame:
    """A literal frame for decoy files, apart from the tables."""
    return spark.range(1)


def _wa_header(style, ts, sender):
    """Android (dd.mm.yyyy, HH:MM - ), iOS ([dd.mm.yyyy, HH:MM:SS] ), US (M/d/yy, h:mm a - )."""
    return (F.when(style == 0, F.concat(F.date_format(ts, "dd.MM.yyyy, HH:mm"), F.lit(" - "), sender, F.lit(": ")))
            .when(style == 1, F.concat(F.lit("["), F.date_format(ts, "dd.MM.yyyy, HH:mm:ss"), F.lit("] "), sender,
                                       F.lit(": ")))
            .otherwise(F.concat(F.date_format(ts, "M/d/yy, h:mm a"), F.lit(" - "), sender, F.lit(": "))))


def render_whatsapp(spark: SparkSession, d: str) -> DataFrame:
    t = chat_turns(spark, d)
    style = F.col("conv_id") % 3
    path = F.concat(F.lit("/exports/whatsapp/WhatsApp Chat with Conv "), F.col("conv_id").cast("string"),
                    F.lit(".txt"))
    lines = F.split("text", "\n")
    first = F.concat(_wa_header(style, F.col("ts"), F.col("sender")), lines[0])
    media = F.when(F.col("turn") == 1, F.array(F.concat(_wa_header(style, F.col("ts"), F.lit(OWNER.name)),
                                                        F.lit("<Media omitted>")))
                   ).otherwise(F.array().cast("array<string>"))
    body = F.concat(F.array(first), F.slice(lines, 2, F.size(lines)), media)
    msgs = t.select(path.alias("path"), F.col("turn"), F.posexplode(body).alias("i", "value")) \
        .select("path", F.col("turn").cast("long").alias("block"), F.col("i").cast("long").alias("pos"), "value")
    pre = t.select(path.alias("path")).distinct().select(
        "path", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("pos"),
        F.lit("Messages and calls are end-to-end encrypted. Tap to learn more.").alias("value"))
    return msgs.unionByName(pre)


def q_parse_whatsapp(spark, d):
    return message_output(whatsapp.parse_whatsapp(render_whatsapp(spark, d), OWNER))


def mojibake(c):
    """UTF-8 bytes read back as Latin-1, as Meta exports store text."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def render_messenger(spark: SparkSession, d: str, root: str = "/exports/facebook") -> DataFrame:
    """One JSON file per conversation, newest message first. Even conversations
    use the classic shape under inbox/<thread>/message_1.json, odd ones the E2EE
    shape at e2ee/<conv>.json. Each file also holds an unsent message and an
    attachment notice, which the parser must drop."""
    t = chat_turns(spark, d).withColumn("ms", F.unix_millis("ts"))
    raw_text = F.col("text")
    msgs_classic = F.struct(F.col("sender").alias("sender_name"), F.col("ms").alias("timestamp_ms"),
                            mojibake(raw_text).alias("content"))
    msgs_e2ee = F.struct(F.col("sender").alias("senderName"), F.col("ms").alias("timestamp"),
                         mojibake(raw_text).alias("text"), F.lit(False).alias("isUnsent"))
    g = t.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("turn")).alias("k"), msgs_classic.alias("m")))).alias("c"),
        F.array_sort(F.collect_list(F.struct((-F.col("turn")).alias("k"), msgs_e2ee.alias("m")))).alias("e"),
        F.array_sort(F.collect_set("sender")).alias("senders"), F.max("ms").alias("last_ms"))
    extra_c = F.array(
        F.struct(F.lit("Ana").alias("sender_name"), F.col("last_ms").alias("timestamp_ms"),
                 F.lit("gone").alias("content"), F.lit(True).alias("is_unsent")),
        F.struct(F.lit("Ben").alias("sender_name"), F.col("last_ms").alias("timestamp_ms"),
                 F.lit("Ben sent an attachment.").alias("content"), F.lit(False).alias("is_unsent")))
    classic = F.to_json(F.struct(
        F.transform("senders", lambda n: F.struct(n.alias("name"))).alias("participants"),
        F.concat(F.lit("Conv "), F.col("conv_id").cast("string")).alias("title"),
        F.concat(extra_c, F.transform("c", lambda x: x["m"].withField("is_unsent", F.lit(False)))).alias("messages")))
    extra_e = F.array(F.struct(F.lit("Ana").alias("senderName"), F.col("last_ms").alias("timestamp"),
                               F.lit("reacted to your message").alias("text"), F.lit(False).alias("isUnsent")))
    e2ee = F.to_json(F.struct(
        F.concat(F.lit("Conv "), F.col("conv_id").cast("string")).alias("threadName"),
        F.col("senders").alias("participants"),
        F.concat(extra_e, F.transform("e", lambda x: x["m"])).alias("messages")))
    even = F.col("conv_id") % 2 == 0
    path = F.when(even, F.concat(F.lit(root + "/your_activity/messages/inbox/conv_"),
                                 F.col("conv_id").cast("string"), F.lit("/message_1.json"))) \
        .otherwise(F.concat(F.lit(root + "/e2ee/conv_"), F.col("conv_id").cast("string"), F.lit(".json")))
    return g.select(path.alias("path"), F.when(even, classic).otherwise(e2ee).alias("content"))


def q_parse_messenger(spark, d):
    from lifecorpus.sources.meta_chats import parse_meta_chats
    return message_output(parse_meta_chats(render_messenger(spark, d), OWNER, "messenger", "/exports/facebook"))


def q_parse_instagram(spark, d):
    from lifecorpus.sources.meta_chats import parse_meta_chats
    root = "/exports/instagram"
    return message_output(parse_meta_chats(render_messenger(spark, d, root), OWNER, "instagram", root))


def json_str(c):
    """A JSON string literal for ``c`` (quoted and escaped)."""
    j = F.to_json(F.array(c))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def render_telegram(spark: SparkSession, d: str) -> DataFrame:
    """One result.json per conversation. Even conversations: a full export with
    personal_information (user_id 42) and the owner shown as 'Me Alias', so the
    owner is recognised by id; odd ones: a single-chat file, owner named 'Owner'.
    Multi-line texts become [first line, {type: bold, text: rest}]; each chat
    also carries a service message."""
    t = chat_turns(spark, d)
    even = F.col("conv_id") % 2 == 0
    lines = F.split("text", "\n", 2)
    text_json = F.when(F.size(lines) > 1, F.concat(
        F.lit("["), json_str(lines[0]), F.lit(',{"type":"bold","text":'),
        json_str(F.concat(F.lit("\n"), lines[1])), F.lit("}]"))).otherwise(json_str(F.col("text")))
    owner = F.col("sender") == OWNER.name
    frm = F.when(owner & even, F.lit("Me Alias")).otherwise(F.col("sender"))
    from_id = F.when(owner, F.lit("user42")).otherwise(F.concat(F.lit("user"), (F.col("turn") % 4 + 7).cast("string")))
    msg = F.concat(
        F.lit('{"type":"message","from":'), json_str(frm),
        F.lit(',"from_id":"'), from_id, F.lit('","date":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('","date_unixtime":"'), F.unix_timestamp("ts").cast("string"), F.lit('","text":'), text_json,
        F.lit("}"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", msg.alias("j")))).alias("ms"))
    service = F.lit('{"type":"service","action":"create_group","text":""}')
    msgs = F.concat(F.lit("["), F.array_join(F.concat(F.array(service), F.transform("ms", lambda x: x["j"])), ","),
                    F.lit("]"))
    chat = F.concat(F.lit('{"id":'), F.col("conv_id").cast("string"), F.lit(',"name":"Conv '),
                    F.col("conv_id").cast("string"), F.lit('","messages":'), msgs, F.lit("}"))
    doc = F.when(even, F.concat(F.lit('{"personal_information":{"user_id":42},"chats":{"list":['), chat,
                                F.lit("]}}"))).otherwise(chat)
    path = F.concat(F.lit("/exports/telegram/conv_"), F.col("conv_id").cast("string"), F.lit("/result.json"))
    return g.select(path.alias("path"), doc.alias("content"))


def render_telegram_lines(spark: SparkSession, d: str) -> DataFrame:
    """The same exports as Telegram lays them out, as lines (path, block, pos, sub, value): all even
    conversations in one export of all chats, each odd one as a single chat's."""
    t = chat_turns(spark, d)
    even = F.col("conv_id") % 2 == 0
    all_path, conv = "/exports/telegram/all/result.json", F.col("conv_id").cast("string")
    path = F.when(even, F.lit(all_path)).otherwise(F.concat(F.lit("/exports/telegram/conv_"), conv, F.lit("/result.json")))

    def lines(df, block, pos, texts, indent=None):
        return df.select("path", block.cast("long").alias("block"), pos.cast("long").alias("pos"), F.posexplode(texts).alias("sub", "value"),
                         *([] if indent is None else [indent.alias("_i")])).select(
            "path", "block", "pos", F.col("sub").cast("long").alias("sub"), (F.col("value") if indent is None else F.concat("_i", "value")).alias("value"))

    def lit(*texts):
        return F.array(*[F.lit(x) for x in texts])

    x = t.withColumn("path", path)
    owner = F.col("sender") == OWNER.name
    frm = F.when(owner & even, F.lit("Me Alias")).otherwise(F.col("sender"))
    from_id = F.when(owner, F.lit("user42")).otherwise(F.concat(F.lit("user"), (F.col("turn") % 4 + 7).cast("string")))
    parts = F.split("text", "\n", 2)
    body = F.when(F.size(parts) > 1, F.array(
        F.lit(' "text": ['), F.concat(F.lit("  "), json_str(parts[0]), F.lit(",")), F.lit("  {"), F.lit('   "type": "bold",'),
        F.concat(F.lit('   "text": '), json_str(F.concat(F.lit("\n"), parts[1]))), F.lit("  }"), F.lit(" ]"))) \
        .otherwise(F.array(F.concat(F.lit(' "text": '), json_str(F.col("text")))))
    head = F.array(F.lit("{"), F.concat(F.lit(' "id": '), F.col("turn").cast("string"), F.lit(",")), F.lit(' "type": "message",'),
                   F.concat(F.lit(' "date": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('",')),
                   F.concat(F.lit(' "date_unixtime": "'), F.unix_timestamp("ts").cast("string"), F.lit('",')),
                   F.concat(F.lit(' "from": '), json_str(frm), F.lit(",")), F.concat(F.lit(' "from_id": "'), from_id, F.lit('",')))
    deep = F.when(even, F.lit("     ")).otherwise(F.lit("  "))
    msgs = lines(x, F.col("conv_id"), F.col("turn"), F.concat(head, body, lit("},")), deep)
    chats = x.select("path", "conv_id").distinct()
    name = F.concat(F.lit('"name": "Conv '), conv, F.lit('",'))
    service = ["{", ' "type": "service",', ' "action": "create_group",', ' "text": ""', "}"]  # the last message of each chat
    at = F.when(even, F.lit("    ")).otherwise(F.lit(" "))
    opens = F.concat(F.when(even, lit("   {")).otherwise(lit("{")),
                     F.array(F.concat(at, name), F.concat(at, F.lit('"id": '), conv, F.lit(",")), F.concat(at, F.lit('"messages": ['))))
    closes = F.concat(F.transform(lit(*service), lambda v: F.concat(F.when(even, F.lit("     ")).otherwise(F.lit("  ")), v)),
                      F.when(even, lit("    ]", "   },")).otherwise(lit(" ]", "}")))
    first, last = F.lit(-(2**62)), F.lit(2**62)
    around = one_row(spark).select(F.lit(all_path).alias("path"))
    return (msgs.unionByName(lines(chats, F.col("conv_id"), first, opens)).unionByName(lines(chats, F.col("conv_id"), last, closes))
            .unionByName(lines(around, first, first, lit("{", ' "personal_information": {', '  "user_id": 42', " },", ' "chats": {', '  "list": [')))
            .unionByName(lines(around, last, last, lit("   {", '    "name": "Saved Messages",', '    "id": 0,', '    "messages": []', "   }", "  ]", " }", "}"))))


def q_parse_telegram(spark, d):
    from lifecorpus.sources.telegram import telegram_line_records
    from lifecorpus.schema import MESSAGES, of_kind
    recs = telegram_line_records(render_telegram_lines(spark, d), OWNER, order=("block", "pos", "sub"))
    return message_output(of_kind(recs, MESSAGES))


def doc_output(d: DataFrame) -> DataFrame:
    meta = F.array_join(F.transform(F.array_sort(F.map_entries("meta")),
                                    lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("<null>")))),
                        ";")
    return d.select("source", "doc_id", "timestamp", "title", "text", "authored_by_me", meta.alias("meta"))


def doc_rows(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", "lang", "text")
    return x.withColumn("ts", F.timestamp_seconds(F.lit(BASE_EPOCH) + F.col("doc_id") * 3600))


def render_tweets(spark: SparkSession, d: str) -> DataFrame:
    """One tweet*.js per document; Spanish documents are also retweeted ('RT @...',
    in a file of their own); even ids use the {tweet: {...}} wrapper; German ones
    reply to someone."""
    x = doc_rows(spark, d).withColumn("retweet", F.explode(
        F.when(F.col("lang") == "es", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    text = F.when(F.col("retweet"), F.concat(F.lit("RT @someone: "), F.col("text"))).otherwise(F.col("text"))
    t = F.struct(F.col("doc_id").cast("string").alias("id_str"), text.alias("full_text"),
                 F.date_format("ts", "EEE MMM dd HH:mm:ss +0000 yyyy").alias("created_at"),
                 F.when(F.col("lang") == "de", F.lit("someone")).alias("in_reply_to_screen_name"))
    item = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.array(F.struct(t.alias("tweet"))))) \
        .otherwise(F.to_json(F.array(t)))
    path = F.concat(F.lit("/exports/twitter/data/tweets-"), F.col("doc_id").cast("string"),
                    F.when(F.col("retweet"), F.lit("-rt.js")).otherwise(F.lit(".js")))
    return x.select(path.alias("path"), F.concat(F.lit("window.YTD.tweets.part0 = "), item).alias("content"))


def q_parse_tweets(spark, d):
    from lifecorpus.sources.social import parse_tweets
    return doc_output(parse_tweets(render_tweets(spark, d)))


def render_x_dms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = chat_turns(spark, d)
    sid = F.when(F.col("sender") == OWNER.name, F.lit("42")).otherwise(
        F.when(F.col("sender") == "Ana", F.lit("1001")).when(F.col("sender") == "Ben", F.lit("1002"))
        .otherwise(F.lit("1003")))
    mc = F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("createdAt"),
                           sid.alias("senderId"), F.col("text").alias("text")).alias("messageCreate"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", mc.alias("m")))).alias("ms"))
    conv = F.struct(F.struct(F.concat(F.lit("dm-"), F.col("conv_id").cast("string")).alias("conversationId"),
                             F.transform("ms", lambda x: x["m"]).alias("messages")).alias("dmConversation"))
    dms = g.select(F.concat(F.lit("/exports/twitter/data/direct-messages-"), F.col("conv_id").cast("string"),
                            F.lit(".js")).alias("path"),
                   F.concat(F.lit("window.YTD.direct_messages.part0 = "), F.to_json(F.array(conv))).alias("content"))
    # reactions are not messages; one per conversation, spliced into the JSON
    dms = dms.withColumn("content", F.regexp_replace("content", r'"messages":\[', '"messages":[{"reactionCreate":{}},'))
    acc = one_row(spark).select(F.lit("/exports/twitter/data/account.js").alias("path"),
                            F.lit('window.YTD.account.part0 = [{"account":{"accountId":"42"}}]').alias("content"))
    return dms, acc


def q_parse_x_dm(spark, d):
    from lifecorpus.sources.social import parse_x_dms
    dms, acc = render_x_dms(spark, d)
    return message_output(parse_x_dms(dms, acc, OWNER))


def q_parse_reddit(spark, d):
    """Documents as Reddit rows: French ones as posts, the rest as comments; beside
    each German document lies a '[deleted]' comment (dropped); English ones have
    no title (fallback 'r/<sub> <kind>')."""
    from lifecorpus.sources.social import parse_reddit
    x = doc_rows(spark, d)
    x = x.unionByName(x.where(F.col("lang") == "de").withColumn("text", F.lit("[deleted]")))
    rows = x.select(F.lit("/exports/reddit/export.csv").alias("path"), F.col("doc_id").alias("row"),
                    F.concat(F.lit("t1_"), F.col("doc_id").cast("string")).alias("id"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("date"),
                    F.col("lang").alias("subreddit"),
                    F.when(F.col("lang") == "en", F.lit("")).otherwise(F.concat(F.lit("Doc "), F.col("doc_id")))
                    .alias("title"),
                    F.col("text").alias("body"),
                    "lang")
    return doc_output(parse_reddit(rows.where(F.col("lang") != "fr").drop("lang"),
                                   rows.where(F.col("lang") == "fr").drop("lang")))


def render_facebook_posts(spark: SparkSession, d: str) -> DataFrame:
    """Even documents as posts (your_posts_<id>.json, a list), odd ones as
    comments (comments_<id>.json, {comments_v2: [...]}), text as mojibake; one
    extra file under a messages folder must be ignored."""
    x = doc_rows(spark, d).withColumn("sec", F.unix_timestamp("ts"))
    post = F.to_json(F.array(F.struct(F.col("sec").alias("timestamp"),
                                      F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"),
                                      F.array(F.create_map(F.lit("post"), mojibake(F.col("text")))).alias("data"))))
    com = F.to_json(F.struct(F.array(F.struct(
        F.col("sec").alias("timestamp"), F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"),
        F.array(F.struct(F.struct(mojibake(F.col("text")).alias("comment"),
                                  F.lit("Owner").alias("author")).alias("comment"))).alias("data"))
    ).alias("comments_v2")))
    even = F.col("doc_id") % 2 == 0
    path = F.when(even, F.concat(F.lit("/exports/facebook/your_activity/posts/your_posts_"),
                                 F.col("doc_id").cast("string"), F.lit(".json"))) \
        .otherwise(F.concat(F.lit("/exports/facebook/your_activity/comments/comments_"),
                            F.col("doc_id").cast("string"), F.lit(".json")))
    files = x.select(path.alias("path"), F.when(even, post).otherwise(com).alias("content"))
    decoy = one_row(spark).select(F.lit("/exports/facebook/messages/inbox/a/your_posts_1.json").alias("path"),
                              F.lit('[{"timestamp": 1, "data": [{"post": "not a post"}]}]').alias("content"))
    return files.unionByName(decoy)


def q_parse_facebook(spark, d):
    from lifecorpus.sources.social import parse_facebook_posts
    return doc_output(parse_facebook_posts(render_facebook_posts(spark, d), "/exports/facebook"))


def q_parse_linkedin(spark, d):
    """Conversations as LinkedIn message rows (even ones titled, odd ones with a
    subject only)."""
    from lifecorpus.sources.social import parse_linkedin_messages
    t = chat_turns(spark, d)
    rows = t.select(F.concat(F.lit("/exports/linkedin/"), F.col("conv_id").cast("string"), F.lit("/messages.csv"))
                    .alias("path"), F.col("turn").alias("row"),
                    F.concat(F.lit("li-"), F.col("conv_id").cast("string")).alias("CONVERSATION ID"),
                    F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Conv "), F.col("conv_id").cast("string")))
                    .otherwise(F.lit("")).alias("CONVERSATION TITLE"),
                    F.col("sender").alias("FROM"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("DATE"),
                    F.lit("Hello").alias("SUBJECT"), F.col("text").alias("CONTENT"))
    return message_output(parse_linkedin_messages(rows, OWNER))


def q_parse_linkedin_shares(spark, d):
    """Documents as LinkedIn shares; beside each Spanish one lies a share without
    commentary (dropped)."""
    from lifecorpus.sources.social import parse_linkedin_shares
    x = doc_rows(spark, d)
    x = x.unionByName(x.where(F.col("lang") == "es").withColumn("text", F.lit("")))
    return doc_output(parse_linkedin_shares(x.select(
        F.lit("/exports/linkedin/Shares.csv").alias("path"), F.col("doc_id").alias("row"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date"),
        F.concat(F.lit("share/"), F.col("doc_id").cast("string")).alias("ShareLink"),
        F.col("text").alias("ShareCommentary"))))


def q_parse_linkedin_profile(spark, d):
    """Customers as profile files of their own; columns stand in two orders, and
    those of the first nations have no segment."""
    from lifecorpus.sources.social import parse_linkedin_profile
    c = table(spark, d, "customer")
    name, key, seg = F.col("c_name"), F.col("c_custkey").cast("string"), F.when(F.col("c_nationkey") > 4, F.col("c_mktsegment"))
    even = F.col("c_custkey") % 2 == 0
    names = [F.array(*[F.lit(x) for x in h]) for h in (["First Name", "Headline", "Key"], ["Key", "Headline", "First Name"])]
    return doc_output(parse_linkedin_profile(c.select(
        F.concat(F.lit("/exports/linkedin/"), key, F.lit("/Profile.csv")).alias("path"), F.lit(1).alias("row"),
        F.when(even, F.array(name, seg, key)).otherwise(F.array(key, seg, name)).alias("cells"),
        F.when(even, names[0]).otherwise(names[1]).alias("head"))))


def q_parse_linkedin_positions(spark, d):
    """Orders as career rows, one file per customer; open orders have no end."""
    from lifecorpus.sources.social import parse_linkedin_positions
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return doc_output(parse_linkedin_positions(o.select(
        F.concat(F.lit("/exports/linkedin/"), F.col("o_custkey").cast("string"), F.lit("/Positions.csv")).alias("path"),
        F.col("o_orderkey").alias("row"), F.col("o_orderpriority").alias("Title"),
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("Company Name"), day.alias("Started On"),
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(day).alias("Finished On"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("Description"))))


def _ext(lang):
    return (F.when(lang == "en", F.lit(".md")).when(lang == "fr", F.lit(".txt"))
            .when(lang == "es", F.lit(".org")).otherwise(F.lit(".html")))


def _html_page(text):
    esc = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                    F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><p>"), esc,
                    F.lit("</p><!-- end --></body></html>"))


def render_files(spark: SparkSession, d: str, base: str) -> DataFrame:
    """Documents as files <base>/<lang>/doc_<id>.<ext> (English .md, French .txt,
    Spanish .org, German .html), mtime 2024-01-01 + id hours, plus a hidden file
    and a PDF that must not produce documents."""
    x = doc_rows(spark, d)
    ext = _ext(F.col("lang"))
    body = F.when(F.col("lang") == "de", _html_page(F.col("text"))).otherwise(F.col("text"))
    files = x.select(F.concat(F.lit(base + "/"), F.col("lang"), F.lit("/doc_"), F.col("doc_id").cast("string"), ext)
                     .alias("path"), F.col("ts").alias("modificationTime"), F.encode(body, "UTF-8").alias("content"))
    decoys = one_row(spark).select(
        F.explode(F.array(F.lit(base + "/.obsidian/workspace.md"), F.lit(base + "/scan.pdf"))).alias("path"),
        F.timestamp_seconds(F.lit(BASE_EPOCH)).alias("modificationTime"),
        F.encode(F.lit("a hidden or undecodable file with enough characters"), "UTF-8").alias("content"))
    return files.unionByName(decoys)


def q_parse_notes(spark, d):
    from lifecorpus.sources.files import parse_files
    return doc_output(parse_files(render_files(spark, d, "/exports/notes"), "/exports/notes", "notes", True))


def q_parse_drive(spark, d):
    """Even documents under Takeout/Drive, odd ones under Takeout/Dysk; one more
    folder level named drive inside must not shift ids (outermost wins), and
    files outside any drive folder are ignored."""
    from lifecorpus.sources.files import parse_files
    f = render_files(spark, d, "/exports/google/Takeout/X")
    did = F.regexp_extract("path", r"doc_(\d+)\.", 1).try_cast("long")
    top = F.when(did % 2 == 0, F.lit("Drive")).otherwise(F.lit("Dysk"))
    f = f.withColumn("path", F.when(did.isNull(), F.col("path")).otherwise(
        F.concat(F.lit("/exports/google/Takeout/"), top, F.lit("/"),
                 F.regexp_replace("path", "^/exports/google/Takeout/X/", ""))))
    nested = f.where(did == 0).withColumn("path", F.lit("/exports/google/Takeout/Drive/archive/drive/kept.md"))
    return doc_output(parse_files(f.unionByName(nested), "/exports/google", "drive", False, drive=True))


def render_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Events as VEVENT records (what a BEGIN:VEVENT-split scan yields), one
    calendar file per user: all-day dates for views, floating times for clicks
    (with an escaped comma), UTC otherwise; purchases have a location, signups a
    folded description, errors two attendees."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "props", "ts")
    ts = F.col("ts").cast("timestamp")
    uid = F.lpad(F.col("user_id").cast("string"), 12, "0")
    dt = (F.when(F.col("event_type") == "view", F.concat(F.lit("DTSTART;VALUE=DATE:"), F.date_format(ts, "yyyyMMdd")))
          .when(F.col("event_type") == "click", F.concat(F.lit("DTSTART:"), F.date_format(ts, "yyyyMMdd'T'HHmmss")))
          .otherwise(F.concat(F.lit("DTSTART:"), F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))))
    summary = F.when(F.col("event_type") == "click", F.concat(F.lit("click\\, tap "), F.col("props"))) \
        .otherwise(F.concat(F.col("event_type"), F.lit(" "), F.col("props")))
    desc = F.concat(F.lit("DESCRIPTION:Signed up as user "), F.col("user_id").cast("string"),
                    F.lit(" after a long walk through the onboarding flow"))
    desc = F.concat(F.substring(desc, 1, 30), F.lit("\r\n "), F.substr(desc, F.lit(31)))
    extra = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("LOCATION:Shop "), F.col("user_id").cast("string"),
                                                                 F.lit("\r\n")))
             .when(F.col("event_type") == "signup", F.concat(desc, F.lit("\r\n")))
             .when(F.col("event_type") == "error", F.concat(
                 F.lit('ATTENDEE;CN="Ops: Team":mailto:user'), F.col("user_id").cast("string"),
                 F.lit("@example.com\r\nATTENDEE:MAILTO:ops@example.com\r\n")))
             .otherwise(F.lit("")))
    value = F.concat(F.lit("\r\nUID:ev"), F.col("event_id").cast("string"), F.lit("\r\n"), dt, F.lit("\r\nSUMMARY:"),
                     summary, F.lit("\r\n"), extra, F.lit("END:VEVENT\r\n"))
    path = F.concat(F.lit("/exports/google/Takeout/Calendar/user_"), uid, F.lit(".ics"))
    ev = e.select(path.alias("path"), F.lit(0).cast("long").alias("block"), F.col("event_id").alias("pos"),
                  value.alias("value"))
    head = e.select(path.alias("path")).distinct().select(
        "path", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("pos"),
        F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0\r\n").alias("value"))
    return ev.unionByName(head)


def q_parse_ics(spark, d):
    from lifecorpus.sources.calendar import parse_calendar
    return doc_output(parse_calendar(render_calendar(spark, d)))


def q_parse_commits(spark, d):
    """Documents as commit records of repo-<lang>.gitlog; beside each Spanish one
    lies a commit with a blank body, which is skipped."""
    from lifecorpus.sources.commits import parse_commits
    x = doc_rows(spark, d)
    x = x.unionByName(x.where(F.col("lang") == "es").withColumn("text", F.lit("   \n")))
    body = F.col("text")
    rec = F.concat(F.lit("\n"), F.sha1(F.col("doc_id").cast("string")), F.lit("\x1f"),
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00\x1f"), body, F.lit("\n"))
    raw = x.select(F.concat(F.lit("/exports/git/repo-"), F.col("lang"), F.lit(".gitlog")).alias("path"),
                   F.lit(0).cast("long").alias("block"), F.col("doc_id").alias("pos"), rec.alias("value"))
    return doc_output(parse_commits(raw))


def render_feeds(spark: SparkSession, d: str) -> dict:
    """Events as lifelog feeds, one file per user and feed: views -> watch
    history, clicks -> search history, purchases -> Chrome history, signups ->
    new Timeline, errors -> legacy Timeline."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "props", "ts")
    ts = F.col("ts").cast("timestamp")
    uid = F.lpad(F.col("user_id").cast("string"), 12, "0")
    base = "/exports/google/Takeout"

    def files(kind, path, item, wrap):
        x = e.where(F.col("event_type") == kind)
        g = x.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(ts.alias("ts"), "event_id", item.alias("it"))))
                                     .alias("xs"))
        return g.select(F.concat(F.lit(base), F.lit(path), F.lpad(F.col("user_id").cast("string"), 12, "0"),
                                 F.lit(".json") if "Semantic" in path else F.lit("")).alias("path"),
                        wrap(F.transform("xs", lambda r: r["it"])).alias("content"))

    iso_t = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    watch = files("view", "/YouTube/watch/", F.struct(F.concat(F.lit("Watched "), F.col("props")).alias("title"),
                                                     iso_t.alias("time")), F.to_json)
    search = files("click", "/YouTube/search/", F.struct(F.concat(F.lit("search "), F.col("props")).alias("title"),
                                                        iso_t.alias("time")), F.to_json)
    chrome = files("purchase", "/Chrome/", F.struct(F.col("props").alias("title"),
                                                   F.unix_micros(ts).alias("time_usec")),
                   lambda a: F.to_json(F.struct(a.alias("Browser History"))))
    timeline = files("signup", "/Timeline/", F.struct(iso_t.alias("startTime"), F.struct(F.struct(
        F.col("props").alias("semanticType")).alias("topCandidate")).alias("visit")),
        lambda a: F.to_json(F.struct(a.alias("semanticSegments"))))
    legacy = files("error", "/Location History/Semantic Location History/2024/user_", F.struct(F.struct(
        F.struct(F.col("props").alias("name")).alias("location"),
        F.struct(iso_t.alias("startTimestamp")).alias("duration")).alias("placeVisit")),
        lambda a: F.to_json(F.struct(a.alias("timelineObjects"))))

    def named(df, leaf):
        return df.withColumn("path", F.concat("path", F.lit("/" + leaf)))
    return {"watch": named(watch, "watch-history.json"), "search": named(search, "search-history.json"),
            "chrome": named(chrome, "History.json"), "timeline": named(timeline, "Timeline.json"),
            "legacy": legacy}


def q_parse_lifelog(spark, d):
    from lifecorpus.operators.lifelog import daily_rollup
    from lifecorpus.sources.lifelog import parse_feeds
    return daily_rollup(parse_feeds(render_feeds(spark, d), "/exports/google")) \
        .select("doc_id", "timestamp", "title", "text")


MAIL_OWNER = "owner@example.com"
MAIL_SETTINGS = OWNER.__class__.make("Owner", emails=[MAIL_OWNER], names=["Owner"], skip_senders=["noreply"])


def render_mbox(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as mbox records (what a '\\nFrom '-split scan yields).
    User mails quote the previous mail; owner mails in even conversations end
    with a signature, in odd ones they are multipart/alternative with an empty
    plain part (so the HTML part is used). Each thread also gets a newsletter,
    a spam-labelled mail and one from a skip-listed sender."""
    t = chat_turns(spark, d)
    owner = F.col("sender") == OWNER.name
    even = F.col("conv_id") % 2 == 0
    addr = F.when(owner, F.lit(MAIL_OWNER)).when(F.col("sender") == "Ana", F.lit("ana@example.com")) \
        .when(F.col("sender") == "Ben", F.lit("ben@example.com")).otherwise(F.lit("system@example.com"))
    disp = F.when(F.col("sender") == "Ben", F.lit("=?utf-8?q?Ben?=")).otherwise(F.col("sender"))
    frm = F.concat(disp, F.lit(" <"), addr, F.lit(">"))
    to = F.when(owner, F.lit("Ana <ana@example.com>")).otherwise(F.lit("Owner <owner@example.com>"))
    cc = F.when(owner & even, F.lit("Cc: ben@example.com\n")).otherwise(F.lit(""))
    date = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0000'")
    subj = F.concat(F.lit("Conv "), F.col("conv_id").cast("string"))

    def head(frm_, labels, extra):
        return F.concat(F.lit("X-GM-THRID: "), F.col("conv_id").cast("string"), F.lit("\nX-Gmail-Labels: "), labels,
                        F.lit("\nFrom: "), frm_, F.lit("\nTo: "), to, F.lit("\n"), cc, F.lit("Subject: "), subj,
                        F.lit("\nDate: "), date, F.lit("\n"), extra)

    plain_ct = F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n")
    quoted = F.concat(F.col("text"), F.lit("\n\nOn Mon, 1 Jan 2024 at 00:00, Owner <owner@example.com> wrote:\n"
                                            "> earlier message\n> more"))
    signed = F.concat(F.col("text"), F.lit("\n-- \nOwner\nSent with care"))
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                    F.lit(">"), F.lit("&gt;"))
    alt = F.concat(F.lit('Content-Type: multipart/alternative; boundary="b1"\n\n--b1\n'
                         'Content-Type: text/plain; charset=utf-8\n\n\n--b1\n'
                         'Content-Type: text/html; charset=utf-8\n\n<html><body><p>'), esc,
                   F.lit("</p></body></html>\n--b1--\n"))
    body = F.when(~owner, F.concat(plain_ct, quoted)).when(even, F.concat(plain_ct, signed)).otherwise(alt)
    env = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("@mail Mon Jan 01 00:00:00 2024\n"))
    real = F.concat(env, head(frm, F.lit("Inbox,Important"), F.lit("")), body)
    decoys = F.array(
        F.concat(env, head(F.lit("Shop <news@shop.example>"), F.lit("Inbox"),
                           F.lit("List-Unsubscribe: <mailto:u@shop.example>\n")), plain_ct, F.lit("Big sale today")),
        F.concat(env, head(frm, F.lit(" Spam , Inbox"), F.lit("")), plain_ct, F.lit("Win a prize now")),
        F.concat(env, head(F.lit("Service <noreply@service.example>"), F.lit("Inbox"), F.lit("")), plain_ct,
                 F.lit("Your code was used")))
    recs = F.when(F.col("turn") == 1, F.concat(F.array(real), decoys)).otherwise(F.array(real))
    path = F.concat(F.lit("/exports/google/Takeout/Mail/conv_"), F.col("conv_id").cast("string"), F.lit(".mbox"))
    return t.select(path.alias("path"), F.col("turn").cast("long").alias("block"),
                    F.posexplode(recs).alias("pos", "value"))


def q_parse_mbox(spark, d):
    from lifecorpus.sources.mail import parse_mail
    return message_output(parse_mail(render_mbox(spark, d), MAIL_SETTINGS))


def q_reingest_only(spark, d):
    """IO6/A12: a table of chat messages (all sources), then a fresh WhatsApp
    ingest written as `--only whatsapp twitter`: WhatsApp, twitter and the
    twitter-owned twitter_dm rows are replaced; counts per source as read back."""
    from lifecorpus.plans.adapters import conversation_messages
    from lifecorpus.schema import MESSAGES, records
    from lifecorpus.sources import store
    folder = scratch(spark, "reingest")
    store.write_records(spark, records(conversation_messages(table(spark, d, "conversations")), MESSAGES), folder)
    new = whatsapp.parse_whatsapp(render_whatsapp(spark, d), OWNER)
    store.write_records(spark, records(new, MESSAGES), folder, ["whatsapp", "twitter"])
    return store.read_table(spark, folder, "messages").groupBy("source").agg(F.count(F.lit(1)).alias("n_messages"))


def damaged(files: DataFrame, number: str) -> DataFrame:
    """Files (path, content), some emptied and some cut in half, by the number in their name."""
    n = F.regexp_extract("path", number, 1).try_cast("long")
    half = F.substr("content", F.lit(1), F.floor(F.length("content") / 2).cast("int"))
    return files.withColumn("content", F.when(n % 25 == 2, F.lit("")).when(n % 5 == 1, half).otherwise(F.col("content")))


def write_comment_files(spark: SparkSession, d: str, folder: str) -> None:
    """Documents as CSV files of 100 comments each; every second file ends in a record whose last
    quote is not closed."""
    x = table(spark, d, "documents").select("doc_id", "lang", "text", F.floor(F.col("doc_id") / 100).alias("file"))
    body = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.concat(F.lit("t1_"), "doc_id"), F.lit("2024-01-01"), "lang", F.lit('"a, ""title"""'), body)
    files = x.select("file").distinct()
    head = files.select("file", F.lit(-1).cast("long").alias("k"), F.lit("id,date,subreddit,title,body").alias("value"))
    tail = files.where("file % 2 = 1").select("file", F.lit(2**62).alias("k"),
                                              F.lit('t1_x,2024-01-01,en,t,"open, and, never closed').alias("value"))
    rows = x.select("file", F.col("doc_id").alias("k"), line.alias("value")).unionByName(head).unionByName(tail)
    rows.repartition("file").sortWithinPartitions("file", "k").select("file", "value").write.partitionBy("file").text(folder)


def q_ingest_rejects(spark, d):
    """IO13, IO5: conversations, documents and events as files of every whole-file format, some of
    them broken, through one ingest write: the rejected files with their reasons, and the rows
    that the other files gave per table and source."""
    from functools import reduce

    from lifecorpus.schema import DOCS, MESSAGES, REJECTS
    from lifecorpus.sources import files, lifelog, meta_chats, social, store, telegram
    conv, any_id = r"conv_(\d+)", r"(\d+)\D*$"
    dms, accounts = render_x_dms(spark, d)
    folder = scratch(spark, "rejects")
    write_comment_files(spark, d, f"{folder}/csv")
    comments = social.read_csv_rows(spark, f"{folder}/csv", "*.txt", social.REDDIT_COLUMNS)
    notes = render_files(spark, d, "/exports/notes")
    n = F.regexp_extract("path", any_id, 1).try_cast("long")
    broken, large = n % 10 == 3, n % 10 == 4  # a file over the size limit comes without its bytes
    notes = notes.withColumn("content", F.when(~F.coalesce(large, F.lit(False)), F.col("content"))) \
        .withColumn("path", F.when(broken, F.concat("path", F.lit(".docx"))).otherwise(F.col("path")))
    parts = [
        meta_chats.meta_chat_records(damaged(render_messenger(spark, d), conv), OWNER, "messenger", "/exports/facebook"),
        telegram.telegram_records(damaged(render_telegram(spark, d), conv), OWNER),
        social.twitter_records(damaged(render_tweets(spark, d), any_id), damaged(dms, any_id), accounts, OWNER),
        social.facebook_post_records(damaged(render_facebook_posts(spark, d), any_id), "/exports/facebook"),
        social.reddit_records(comments, comments.where(F.lit(False))),
        lifelog.lifelog_records({k: damaged(f, r"(\d{12})") for k, f in render_feeds(spark, d).items()}, "/exports/google"),
        files.file_records(notes, "/exports/notes", "notes", True),
    ]
    store.write_records(spark, reduce(DataFrame.unionByName, parts), f"{folder}/corpus")
    path = F.when(F.col("path").contains("/file="), F.regexp_extract("path", r"/(file=\d+)/", 1)).otherwise(F.col("path"))
    one = F.lit(1).cast("long").alias("n")
    bad = store.read_table(spark, f"{folder}/corpus", REJECTS).select("source", path.alias("path"), "reason", one)
    good = [store.read_table(spark, f"{folder}/corpus", t).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
            .select("source", F.lit(t).alias("path"), F.lit("").alias("reason"), "n") for t in (MESSAGES, DOCS)]
    return reduce(DataFrame.unionByName, good, bad)


def q_sft_sinks(spark, d):
    """IO1/IO2/IO12/A5: writing examples through the training and validation
    sinks, read back from their JSON lines."""
    from lifecorpus.operators import examples as exm
    from lifecorpus.plans.adapters import document_docs
    from lifecorpus.schema import EXAMPLE
    from lifecorpus.sources import store
    ex = exm.assign_split(exm.dedup_examples(exm.writing_examples(document_docs(table(spark, d, "documents")), OWNER)))
    folder = scratch(spark, "sft")
    store.write_sft(ex, folder)

    def back(split):
        x = store.read_jsonl(spark, f"{folder}/sft_{split}", EXAMPLE)
        body = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
        return x.select(F.lit(split).alias("split"), "source", F.sha1(F.encode(body, "UTF-8")).alias("body_sha1"))
    return back("train").unionByName(back("val"))
