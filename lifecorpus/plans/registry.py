"""Name -> Spark query and name -> oracle SQL."""
from __future__ import annotations

from lifecorpus.functions.text import REDACTIONS
from lifecorpus.plans import queries as q
from lifecorpus.plans import roundtrip as rt
from lifecorpus.plans.oracle import SQL

QUERIES = {
    "sft_build": q.q_sft_build,
    "example_counts": q.q_example_counts,
    "sessionize": q.q_sessionize,
    "session_unknown_ts": q.q_session_unknown_ts,
    "collapse_turns": q.q_collapse_turns,
    "chunk_turns": q.q_chunk_turns,
    "thread_others": q.q_thread_others,
    "my_threads": q.q_my_threads,
    "system_prompt": q.q_system_prompt,
    "writing_examples": q.q_writing_examples,
    "dedup_examples": q.q_dedup_examples,
    "hash_split": q.q_hash_split,
    **{f"redact_{n}": q._redact_query(n) for n, _, _ in REDACTIONS},
    "redact_all": q._redact_query(None),
    "strip_quotes": q.q_strip_quotes,
    "normalize_text": q.q_normalize_text,
    "fix_mojibake": q.q_fix_mojibake,
    "lifelog_daily": q.q_lifelog_daily,
    "corpus_stats": q.q_corpus_stats,
    "my_tokens": q.q_my_tokens,
    "unknown_senders": q.q_unknown_senders,
    "render_chat": q.q_render_chat,
    "loss_spans": q.q_loss_spans,
    "html_text": q.q_html_text,
    "parse_whatsapp": rt.q_parse_whatsapp,
    "parse_messenger": rt.q_parse_messenger,
    "parse_instagram": rt.q_parse_instagram,
    "parse_telegram": rt.q_parse_telegram,
    "parse_tweets": rt.q_parse_tweets,
    "parse_x_dm": rt.q_parse_x_dm,
    "parse_reddit": rt.q_parse_reddit,
    "parse_facebook": rt.q_parse_facebook,
    "parse_linkedin": rt.q_parse_linkedin,
    "parse_linkedin_shares": rt.q_parse_linkedin_shares,
    "parse_linkedin_profile": rt.q_parse_linkedin_profile,
    "parse_linkedin_positions": rt.q_parse_linkedin_positions,
    "parse_notes": rt.q_parse_notes,
    "parse_drive": rt.q_parse_drive,
    "parse_ics": rt.q_parse_ics,
    "parse_commits": rt.q_parse_commits,
    "parse_lifelog": rt.q_parse_lifelog,
    "parse_mbox": rt.q_parse_mbox,
    "reingest_only": rt.q_reingest_only,
    "ingest_rejects": rt.q_ingest_rejects,
    "sft_sinks": rt.q_sft_sinks,
    "train_examples": q.q_train_examples,
}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
