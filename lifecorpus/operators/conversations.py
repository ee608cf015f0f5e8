"""Messages -> conversation examples: thread attributes (A1, P4, W9), sessions
(W1, W2), turns (W3, W4), chunks (W5-W8) and their assembly (A16, T10-T14).

Everything up to the assembly is decided on narrow rows: who spoke, when, and how
long the text is. Texts are joined once, by the message's ``ord``, to the messages
of turns that stay, and move twice: to that join and to their chunk.

Thread-order scans run on range segments (see ``segmented``), so a single huge
thread is spread over many tasks. Thread-wide attributes that the scans need
(does the owner speak, is it a group chat, first-seen order) are decomposable
(max / min), so they are combined across segments the same way.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.functions.times import parse_iso_micros
from lifecorpus.operators import segmented as sg
from lifecorpus.schema import ORD
from lifecorpus.settings import Settings

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# Session gap: mail threads split after 30 days of silence, everything else after 4 hours.
GAP_MAIL_US = 30 * 24 * 3600 * 1_000_000
GAP_DEFAULT_US = 4 * 3600 * 1_000_000
# Channel display names used in the system prompt; other sources show their own name.
CHANNEL = {
    "gmail": "email", "whatsapp": "WhatsApp", "messenger": "Messenger", "instagram": "Instagram DM",
    "telegram": "Telegram", "linkedin": "LinkedIn messages", "twitter_dm": "X DMs",
}
# Placeholder user turn when the owner opens the conversation.
YOU_START = "(you start the conversation)"
# Number of other speakers named in the system prompt.
PROMPT_OTHERS = 6
# End of fixed values
# ---------------------------------------------------------------------------

KEYS = ["source", "thread_id"]


def session_gap_us(source: Column) -> Column:
    """T14."""
    return F.when(source == "gmail", F.lit(GAP_MAIL_US)).otherwise(F.lit(GAP_DEFAULT_US))


def channel_name(source: Column) -> Column:
    """T13."""
    m = F.create_map(*[x for k, v in CHANNEL.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, source), source)


def system_prompt(name: str | Column, channel: Column, others: Column, when: Column) -> Column:
    """T10: 'You are N. Conversation on CH[ with a, b]. Date: D.' (first 6 others)."""
    name_c = name if isinstance(name, Column) else F.lit(name)
    with_ = F.when(F.coalesce(F.size(others), F.lit(0)) > 0,
                   F.concat(F.lit(" with "), F.array_join(F.slice(others, 1, PROMPT_OTHERS), ", "))
                   ).otherwise(F.lit(""))
    return F.concat(F.lit("You are "), name_c, F.lit(". Conversation on "), channel, with_,
                    F.lit(". Date: "), when, F.lit("."))


def prepare_messages(msgs: DataFrame, s: Settings) -> DataFrame:
    """The narrow rows of messages that are long enough (P3): keys, order, speaker, the text's length,
    and the parsed time (T7: epoch micros, null when not ISO). ``ord`` is a message's identity:
    it must be there and be unique."""
    known = F.coalesce("ord", F.raise_error(F.lit("messages need an order key (ord)")).cast(ORD))
    return (msgs.where(F.length("text") >= s.min_chars)
            .select(*KEYS, "timestamp", known.alias("ord"), "sender", "is_me", "thread_title",
                    F.length("text").cast("long").alias("len"), parse_iso_micros(F.col("timestamp")).alias("t")))


def thread_others(rows: DataFrame, limit: int | None = PROMPT_OTHERS) -> DataFrame:
    """A1: per thread, the sorted distinct senders that are not the owner
    (the first ``limit`` of them; the prompt never shows more). Distinct pairs are
    pre-aggregated map-side; the rank limit is applied per partition before the
    shuffle (WindowGroupLimit), so a thread with many senders stays cheap."""
    pairs = rows.where(~F.col("is_me")).select(*KEYS, "sender").distinct()
    if limit is not None:
        w = Window.partitionBy(*KEYS).orderBy("sender")
        pairs = pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit)
    return pairs.groupBy(*KEYS).agg(F.array_sort(F.collect_list("sender")).alias("others"))


def scan_threads(prepared: DataFrame, segments: int | None = None) -> DataFrame:
    """W1-W4 numbering: order each thread by (timestamp string, ord), keep threads
    with the owner (P4), and number sessions (W2) and turns (W4) thread-wide.

    One scan per segment plus one carry table: a segment's rows only depend on
    earlier segments through the last known time and the last speaker, which
    change the outcome of at most two rows (the first row and the first row with
    a known time), so segment totals are corrected on the small carry table.

    Adds: grp (group chat), thread_first (first-seen ord), session_no (0-based),
    turn_no (1-based, consecutive over the thread), plus the segment keys."""
    order = ["timestamp", "ord"]
    df = sg.add_segments(prepared, KEYS, order, segments)
    w = sg.local_window(KEYS, [sg.POS])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(sg.SEG, *KEYS)
    other = F.when(~F.col("is_me"), F.col("sender"))
    me_int = F.col("is_me").cast("int")
    t, gap = F.col("t"), session_gap_us(F.col("source"))
    df = (df.withColumn("_t_prev", F.last("t", ignorenulls=True).over(before))
          .withColumn("_me_prev", F.lag("is_me").over(w))
          .withColumn("_has_me", F.max(me_int).over(whole))
          .withColumn("_omin", F.min(other).over(whole))
          .withColumn("_omax", F.max(other).over(whole))
          .withColumn("_first", F.min("ord").over(whole)))
    ns = t.isNotNull() & F.col("_t_prev").isNotNull() & ((t - F.col("_t_prev")) > gap)
    df = (df.withColumn("_ns", F.coalesce(ns, F.lit(False)).cast("int"))
          .withColumn("_fk", (t.isNotNull() & F.col("_t_prev").isNull()).cast("int"))
          .withColumn("_rc", F.coalesce(F.col("is_me") != F.col("_me_prev"), F.lit(False)).cast("int")))
    df = df.withColumn("_nt", F.greatest(F.col("_ns"), F.col("_rc"), F.col("_me_prev").isNull().cast("int")))
    df = (df.withColumn("_S", F.sum("_ns").over(run)).withColumn("_U", F.sum("_nt").over(run))
          .withColumn("_K", F.max("_fk").over(run)))

    big = F.lit(1 << 62)
    edge = sg.boundary_summaries(df, KEYS, [
        F.max(F.struct(F.when(t.isNotNull(), F.col(sg.POS)).alias("p"), t))["t"].alias("last_t"),
        F.min(F.struct(F.coalesce(F.when(t.isNotNull(), F.col(sg.POS)), big).alias("p"), t))["t"].alias("fk_t"),
        F.min(F.when(F.col("_fk") == 1, F.col(sg.POS))).alias("fk_pos"),
        F.max(F.when(F.col("_fk") == 1, F.col("_rc"))).alias("fk_rc"),
        F.max_by("is_me", sg.POS).alias("last_me"),
        F.min_by("is_me", sg.POS).alias("first_me"),
        F.sum("_ns").alias("s_loc"), F.sum("_nt").alias("u_loc"),
        F.max(me_int).alias("s_has_me"), F.min(other).alias("s_omin"), F.max(other).alias("s_omax"),
        F.min("ord").alias("s_first"), F.first(gap).alias("gap"),
    ])
    prev, all_ = sg.carry_windows(KEYS)
    c = (edge.withColumn("c_t", F.last("last_t", ignorenulls=True).over(prev))
         .withColumn("c_me", F.last("last_me").over(prev))
         .withColumn("c_has_me", F.max("s_has_me").over(all_))
         .withColumn("c_omin", F.min("s_omin").over(all_))
         .withColumn("c_omax", F.max("s_omax").over(all_))
         .withColumn("c_first", F.min("s_first").over(all_)))
    corr_s = F.coalesce(F.col("fk_t").isNotNull() & F.col("c_t").isNotNull()
                        & ((F.col("fk_t") - F.col("c_t")) > F.col("gap")), F.lit(False))
    c = c.withColumn("corr_s", corr_s.cast("int"))
    fk_first = F.coalesce(F.col("fk_pos") == 1, F.lit(False))
    nt_first = ((fk_first & (F.col("corr_s") == 1)) | F.col("c_me").isNull()
                | (F.col("first_me") != F.col("c_me")))
    c = (c.withColumn("corr_u1", nt_first.cast("int") - 1)
         .withColumn("corr_uk", (F.col("fk_pos").isNotNull() & ~fk_first & (F.col("corr_s") == 1)
                                 & (F.coalesce(F.col("fk_rc"), F.lit(0)) == 0)).cast("int")))
    c = (c.withColumn("c_sess", F.sum(F.col("s_loc") + F.col("corr_s")).over(prev))
         .withColumn("c_turn", F.sum(F.col("u_loc") + F.col("corr_u1") + F.col("corr_uk")).over(prev)))
    carry = c.select(sg.SEG, *KEYS, "corr_s", "corr_u1", "corr_uk", "c_sess", "c_turn",
                     "c_has_me", "c_omin", "c_omax", "c_first")
    df = sg.attach_carry(df, carry, KEYS)
    omin = F.coalesce(F.col("c_omin"), F.col("_omin"))
    omax = F.coalesce(F.col("c_omax"), F.col("_omax"))
    after_fk = F.col("_K") == 1
    z = F.lit(0)
    session_no = (F.coalesce(F.col("c_sess"), z) + F.col("_S")
                  + F.when(after_fk, F.coalesce(F.col("corr_s"), z)).otherwise(z))
    turn_no = (F.coalesce(F.col("c_turn"), z) + F.col("_U") + F.coalesce(F.col("corr_u1"), z)
               + F.when(after_fk, F.coalesce(F.col("corr_uk"), z)).otherwise(z))
    out = (df.where(F.coalesce(F.col("c_has_me"), F.col("_has_me")) == 1)
           .withColumn("grp", F.coalesce(omin != omax, F.lit(False)))
           .withColumn("thread_first", F.coalesce(F.col("c_first"), F.col("_first")))
           .withColumn("session_no", session_no.cast("long"))
           .withColumn("turn_no", turn_no.cast("long")))
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in (sg.SEG, sg.POS)],
                    *carry.columns[len(KEYS) + 1:])


def piece_length() -> Column:
    """Length of a message in its turn: with 'sender: ' before other people's text in a group chat."""
    return F.col("len") + F.when(F.col("grp") & ~F.col("is_me"), F.length("sender") + 2).otherwise(F.lit(0))


def turn_rows(scanned: DataFrame) -> DataFrame:
    """W3/W4 without texts: one row per turn with its speaker, the length of its text (messages
    joined by newlines), and its first message."""
    return scanned.groupBy(*KEYS, "turn_no").agg(
        F.min("session_no").alias("session_no"), F.max("is_me").alias("is_me"),
        (F.sum(piece_length()) + F.count(F.lit(1)) - 1).alias("len"),
        F.min(F.struct(F.col(sg.SEG), F.col(sg.POS), F.col("timestamp"), F.col("thread_title"))).alias("first_msg"),
        F.min("thread_first").alias("thread_first"))


def with_texts(rows: DataFrame, msgs: DataFrame) -> DataFrame:
    """Narrow message rows with their text, each as it stands in its turn (``piece``)."""
    texts = msgs.select(F.col("ord").alias("_id"), "text")
    piece = F.when(F.col("grp") & ~F.col("is_me"),
                   F.concat(F.col("sender"), F.lit(": "), F.col("text"))).otherwise(F.col("text"))
    return rows.join(texts, rows["ord"] == texts["_id"]).withColumn("piece", piece).drop("_id", "text")


def joined(pieces: Column, sep: str = "\n") -> Column:
    """The texts of an array of (order, piece) structs, in order."""
    return F.array_join(F.transform(F.sort_array(pieces), lambda x: x["piece"]), sep)


def turn_texts(pieces: DataFrame, by: list[str], keep: list[Column]) -> DataFrame:
    """One row per turn with its text. Messages are joined per (turn, segment) first, then the
    segments' parts, so no list is longer than a segment or than the number of segments, and the
    work is linear in the text. Rows must lie by ``by``, all levels then share that exchange."""
    turn = [*by, "turn_no"] if "turn_no" not in by else by
    parts = pieces.groupBy(*turn, sg.SEG).agg(
        joined(F.collect_list(F.struct(F.col(sg.POS), "piece"))).alias("piece"), *keep)
    return parts.groupBy(*turn).agg(joined(F.collect_list(F.struct(F.col(sg.SEG), "piece"))).alias("text"), *keep)


def first(name: str) -> Column:
    return F.first(name, ignorenulls=True).alias(name)


def collapse_turns(scanned: DataFrame, msgs: DataFrame) -> DataFrame:
    """One row per turn with its text. Role = assistant when the owner speaks; in group
    chats other people's text is prefixed 'sender: '; consecutive messages of one
    side are joined by newlines in thread order."""
    rows = scanned.select(*KEYS, "turn_no", "session_no", sg.SEG, sg.POS, "ord", "is_me", "grp", "sender")
    by = [*KEYS, "turn_no"]
    return turn_texts(with_texts(rows, msgs).repartition(*by), by, [first("session_no"), first("is_me")])


def assign_chunks(turns: DataFrame, s: Settings, segments: int | None = None) -> DataFrame:
    """Chunk number (0-based within the session) for every turn row; the
    chunking automaton runs on range segments (see ``chunking``), so a huge
    session is spread over many tasks."""
    from lifecorpus.operators.chunking import assign_chunk_numbers
    nums = assign_chunk_numbers(turns, s, segments)
    return turns.join(nums.drop("session_no", "is_me"), [*KEYS, "turn_no"])


CHUNK = [*KEYS, "session_no", "chunk_no"]


def kept_turns(turns: DataFrame, others: DataFrame, s: Settings, segments: int | None = None) -> DataFrame:
    """W5, W6, P5 on lengths alone: the turns that examples show, with their chunk. Chunks without
    the owner go, and so does a user turn at the end of one. The first turn of a chunk carries
    what all chunks of a session share in ``head`` (W8: the session's first message; the
    thread's first-seen order and other speakers)."""
    from lifecorpus.operators.chunking import assign_chunk_numbers
    nums = assign_chunk_numbers(turns, s, segments)
    w = Window.partitionBy(*CHUNK)  # at most max_turns + 1 rows
    chunks = (nums.withColumn("_mine", F.max(F.col("is_me").cast("int")).over(w))
              .withColumn("_first", F.min("turn_no").over(w)).withColumn("_last", F.max("turn_no").over(w))
              .where((F.col("_mine") == 1) & (F.col("is_me") | (F.col("turn_no") < F.col("_last")))))
    sess = turns.groupBy(*KEYS, "session_no").agg(
        F.min("first_msg").alias("first_msg"), F.min("thread_first").alias("thread_first"))
    heads = (chunks.where(F.col("turn_no") == F.col("_first")).select(*CHUNK, "turn_no")
             .join(sess, [*KEYS, "session_no"]).join(others, KEYS, "left")
             .select(*KEYS, "turn_no", F.struct("first_msg", "thread_first", "others").alias("head")))
    return chunks.select(*CHUNK, "turn_no").join(heads, [*KEYS, "turn_no"], "left")


def assemble_examples(pieces: DataFrame, s: Settings) -> DataFrame:
    """One example per chunk, with a placeholder user turn when the owner
    starts. ``pieces``: the messages of kept turns, with their text and the chunk's head."""
    dealt = pieces.repartition(*CHUNK)  # one exchange: (turn, segment) parts, turns and chunks lie together
    turns = turn_texts(dealt, CHUNK, [first("is_me"), first("head")])
    ts = F.sort_array(F.collect_list(F.struct("turn_no", "is_me", "text")))
    ch = turns.groupBy(*CHUNK).agg(ts.alias("ts"), first("head")).select(*CHUNK, "ts", "head.*")
    title = F.col("first_msg")["thread_title"]
    topic = F.when((F.col("source") == "gmail") & (F.coalesce(title, F.lit("")) != ""),
                   F.concat(F.lit(' Subject: "'), title, F.lit('"'))).otherwise(F.lit(""))
    prompt = F.concat(system_prompt(s.name, channel_name(F.col("source")),
                                    F.coalesce(F.col("others"), F.array().cast("array<string>")),
                                    F.substring(F.col("first_msg")["timestamp"], 1, 10)), topic)
    opener = F.when(F.col("ts")[0]["is_me"],
                    F.array(F.struct(F.lit("user").alias("role"), F.lit(YOU_START).alias("content")))
                    ).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    body = F.transform("ts", lambda t: F.struct(
        F.when(t["is_me"], F.lit("assistant")).otherwise(F.lit("user")).alias("role"),
        t["text"].alias("content")))
    messages = F.concat(F.array(F.struct(F.lit("system").alias("role"), prompt.alias("content"))),
                        opener, body)
    return ch.select(
        "source", F.col("thread_id").alias("example_key"), messages.alias("messages"),
        F.struct(F.lit(0).alias("kind"), F.col("thread_first").alias("ord"),
                 F.col("session_no").alias("session_no"), F.col("chunk_no").cast("long").alias("chunk_no")
                 ).alias("priority"))


def conversation_examples(msgs: DataFrame, s: Settings, segments: int | None = None) -> DataFrame:
    """Messages -> chat examples (source, example_key, messages, priority).

    Sessions, turns, chunks and what each example shows are settled on narrow rows,
    which are kept for the branches that read them. Texts move to the join by ``ord``
    and to their chunk, those of kept turns only."""
    scanned = sg.keep(scan_threads(prepare_messages(msgs, s), segments))
    turns = sg.keep(turn_rows(scanned))
    kept = kept_turns(turns, thread_others(scanned), s, segments)
    rows = scanned.select(*KEYS, "turn_no", sg.SEG, sg.POS, "ord", "is_me", "grp", "sender").join(kept, [*KEYS, "turn_no"])
    return assemble_examples(with_texts(rows, msgs), s)
