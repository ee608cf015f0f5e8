"""Registered queries over the driver tables: one per operator family of the
inventory. Each takes (spark, sf_dir) and returns a DataFrame whose column
names match the oracle SQL in ``oracle``. All of them read whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions import text as tx
from lifecorpus.functions.hashing import md5_mod_1000
from lifecorpus.functions.times import iso, parse_iso_micros
from lifecorpus.operators import chatml, conversations as cv, examples as exm, report
from lifecorpus.operators import segmented as sg
from lifecorpus.operators.lifelog import daily_rollup
from lifecorpus.operators.sessions import number_sessions
from lifecorpus.plans.adapters import OWNER, conversation_messages, document_docs
from lifecorpus.plans.tables import table
from lifecorpus.settings import Settings

GAP_4H_US = 4 * 3600 * 1_000_000
# Small chunk limits so chunking has work to do on the test tables (4 turns, 800 chars).
SMALL_CHUNKS = Settings.make("Owner", emails=["owner@example.com"], names=["Owner"],
                             context_messages=2, max_chars_per_example=800)


def _msgs(spark, d):
    return conversation_messages(table(spark, d, "conversations"))


def _docs(spark, d):
    return document_docs(table(spark, d, "documents"))


# --- flagship -----------------------------------------------------------------

def sft_examples(spark: SparkSession, d: str, s: Settings = OWNER) -> DataFrame:
    conv = cv.conversation_examples(_msgs(spark, d), s)
    wr = exm.writing_examples(_docs(spark, d), s)
    return exm.build_examples(conv, wr)


def q_sft_build(spark, d):
    ex = sft_examples(spark, d)
    return ex.select(
        "source", "example_key", "split", "bucket",
        F.size("messages").cast("long").alias("n_messages"),
        F.aggregate(F.col("messages"), F.lit(0).cast("long"),
                    lambda a, m: a + F.length(m["content"])).alias("n_chars"),
        "digest",
        F.sha1(F.encode(chatml.render(F.col("messages")), "UTF-8")).alias("render_sha1"))


# --- sessions, turns, chunks --------------------------------------------------

def _events(spark, d, unknown_kind: str | None = None):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    ts = iso(F.col("ts").cast("timestamp"))
    if unknown_kind:
        ts = F.when(F.col("event_type") == unknown_kind, F.lit("")).otherwise(ts)
    return e.select("user_id", "event_id", ts.alias("timestamp")) \
        .withColumn("t", parse_iso_micros(F.col("timestamp")))


def _session_summary(x: DataFrame) -> DataFrame:
    o = F.struct("timestamp", "event_id")
    return x.groupBy("user_id", "session_no").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min_by("event_id", o).alias("first_event_id"),
        F.max_by("event_id", o).alias("last_event_id"),
        F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"))


def q_sessionize(spark, d):
    x = number_sessions(_events(spark, d), ["user_id"], ["timestamp", "event_id"], "t", GAP_4H_US)
    return _session_summary(x)


def q_session_unknown_ts(spark, d):
    """Error events carry no usable time (''), exercising unknown-time handling."""
    x = number_sessions(_events(spark, d, "error"), ["user_id"], ["timestamp", "event_id"], "t", GAP_4H_US)
    return _session_summary(x)


def q_collapse_turns(spark, d):
    msgs = _msgs(spark, d)
    t = cv.collapse_turns(cv.scan_threads(cv.prepare_messages(msgs, OWNER)), msgs)
    return t.select("source", "thread_id", "session_no", "turn_no",
                    F.when(F.col("is_me"), F.lit("assistant")).otherwise(F.lit("user")).alias("role"),
                    "text")


def q_chunk_turns(spark, d):
    s = SMALL_CHUNKS
    turns = cv.turn_rows(cv.scan_threads(cv.prepare_messages(_msgs(spark, d), s)))
    ch = cv.assign_chunks(sg.keep(turns), s)
    ts = F.array_sort(F.collect_list(F.struct("turn_no", "is_me", "len")))
    g = ch.groupBy("source", "thread_id", "session_no", "chunk_no").agg(ts.alias("ts"))
    last_me = F.element_at("ts", -1)["is_me"]
    return g.select(
        "source", "thread_id", "session_no", F.col("chunk_no").cast("long").alias("chunk_no"),
        F.col("ts")[0]["turn_no"].alias("first_turn"), F.element_at("ts", -1)["turn_no"].alias("last_turn"),
        F.size("ts").cast("long").alias("n_turns"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda a, t: a + t["len"]).alias("n_chars"),
        F.exists("ts", lambda t: t["is_me"]).alias("has_me"),
        (F.size("ts") - F.when(last_me, 0).otherwise(1)).cast("long").alias("n_kept"),
        F.col("ts")[0]["is_me"].alias("starts_with_me"))


def q_thread_others(spark, d):
    prepared = cv.prepare_messages(_msgs(spark, d), OWNER)
    o = cv.thread_others(prepared, limit=None)
    return o.select("source", "thread_id", F.array_join("others", ", ").alias("others"),
                    F.size("others").cast("long").alias("n_others"))


def q_my_threads(spark, d):
    """P4 as the thread scan decides it: the messages of threads in which the owner wrote."""
    scanned = cv.scan_threads(cv.prepare_messages(_msgs(spark, d), OWNER))
    return scanned.groupBy(*cv.KEYS).agg(F.count(F.lit(1)).alias("n_messages"))


def q_system_prompt(spark, d):
    ex = cv.conversation_examples(_msgs(spark, d), OWNER)
    return ex.select("source", F.col("example_key").alias("thread_id"),
                     F.col("priority")["session_no"].alias("session_no"),
                     F.col("priority")["chunk_no"].alias("chunk_no"),
                     F.col("messages")[0]["content"].alias("prompt"))


def q_writing_examples(spark, d):
    w = exm.writing_examples(_docs(spark, d), OWNER)
    return w.select("source", "example_key", F.col("messages")[0]["content"].alias("system"),
                    F.col("messages")[1]["content"].alias("prompt"),
                    F.length(F.col("messages")[2]["content"]).cast("long").alias("n_chars"))


def q_dedup_examples(spark, d):
    w = exm.writing_examples(_docs(spark, d), OWNER)
    return exm.dedup_examples(w).select("source", "example_key", "digest")


def q_hash_split(spark, d):
    docs = _docs(spark, d)
    b = md5_mod_1000(F.concat(F.col("source"), F.lit("/"), F.col("doc_id")))
    return docs.select("source", "doc_id", b.alias("bucket")) \
        .withColumn("split", F.when(F.col("bucket") < 30, F.lit("val")).otherwise(F.lit("train")))


def q_example_counts(spark, d):
    return exm.per_source_counts(sft_examples(spark, d))


def q_train_examples(spark, d):
    """A5: the training split in its seeded order (the oracle compares the rows)."""
    return exm.shuffled_train(sft_examples(spark, d)).select("source", "example_key", "digest")


# --- text operators -----------------------------------------------------------

def secrets_suffix(doc_id):
    """Deterministic secrets appended to each document, kept apart by words."""
    i = doc_id.cast("string")
    last4 = F.lpad((doc_id % 10000).cast("string"), 4, "0")
    return F.concat(
        F.lit("\ncard 4111 1111 1111 "), last4,
        F.lit(" end\niban PL61 1090 1014 0000 0712 1981 "), last4,
        F.lit(" end\nid 9"), F.lpad((doc_id % 10_000_000_000).cast("string"), 10, "0"),
        F.lit(" end\nHasło: x"), i, F.lit(" and pin=9"), i,
        F.lit("\nyour code is "), (F.lit(100000) + doc_id).cast("string"),
        F.lit(" thanks\nkey ghp_"), F.md5(i), F.lit(" end"))


def _redact_input(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.concat(F.col("text"), secrets_suffix(F.col("doc_id"))).alias("text"))


def _redact_query(rule: str | None):
    def q(spark, d):
        x = _redact_input(spark, d)
        out = tx.redact(F.col("text")) if rule is None else tx.redact_one(F.col("text"), rule)
        return x.select("doc_id", out.alias("text"))
    q.__name__ = f"q_redact_{rule or 'all'}"
    return q


def quote_wrapped(doc_id, text):
    i = doc_id.cast("string")
    return F.concat(text, F.lit("\n> inline quote "), i, F.lit("\n  > indented quote\nafter quote "), i,
                    F.lit("\n-- \nSignature "), i,
                    F.lit("\n\nOn Mon, 4 Mar 2019 at 10:00, Ana Nowak <ana@example.com> wrote:\n> old text"))


def q_strip_quotes(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    x = docs.select("doc_id", quote_wrapped(F.col("doc_id"), F.col("text")).alias("text"))
    return x.select("doc_id", tx.strip_quotes(F.col("text")).alias("text"))


def messy(text):
    """CRLF line ends, trailing blanks, NBSPs and blank-line runs around the text."""
    t = F.replace(text, F.lit("\n"), F.lit(" \t\r\n"))
    t = F.replace(t, F.lit(". "), F.lit(".\u00a0"))
    return F.concat(F.lit("  \n"), t, F.lit("\r\n\r\n\r\n\r\nend \t\n\n\n\n"))


def q_normalize_text(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", tx.normalize(messy(F.col("text"))).alias("text"))


def q_fix_mojibake(spark, d):
    """Each document read back as Latin-1 (mojibake) and repaired; the untouched
    text is passed through the repair too (it must come back unchanged)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    broken = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", tx.fix_mojibake(broken).alias("repaired"),
                       tx.fix_mojibake(F.col("text")).alias("untouched"))


# --- lifelog, stats, chat rendering -------------------------------------------

def q_lifelog_daily(spark, d):
    e = table(spark, d, "events")
    feed = e.select(F.substring(iso(F.col("ts").cast("timestamp")), 1, 10).alias("day"), F.col("event_type").alias("kind"),
                    F.col("props").alias("item"), F.col("event_id").alias("seq"))
    return daily_rollup(feed).select("doc_id", "timestamp", "title", "text")


def q_corpus_stats(spark, d):
    return report.corpus_stats(_msgs(spark, d), _docs(spark, d))


def q_my_tokens(spark, d):
    return report.my_tokens(_msgs(spark, d), _docs(spark, d))


def q_unknown_senders(spark, d):
    return report.unknown_senders(_msgs(spark, d)).select(
        "sender", "n_messages", F.col("rank").cast("long").alias("rank"))


def q_render_chat(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
    x = chatml.render_rows(turns, ["conv_id"], ["turn", "role", "content"])
    return x.select("conv_id", "text", F.length("text").cast("long").alias("n_chars"))


def q_loss_spans(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
    sp = chatml.loss_span_rows(turns, ["conv_id"], ["turn", "role", "content"])
    return sp.select("conv_id", "span_no", F.col("start").alias("span_start"), F.col("end").alias("span_end"))


def q_html_text(spark, d):
    from lifecorpus.functions.html import html_to_text
    p = table(spark, d, "pages").select("page_id", "html")
    return p.select("page_id", html_to_text(F.col("html")).alias("text"))
