"""DuckDB oracle SQL for the registered queries (tables are pre-registered views).

These are independent formulations: window functions, ordered string
aggregates and a recursive CTE for chunking, instead of the Spark operators.
DuckDB's regex engine is ASCII-only for \\b \\d \\w \\s, so redactions put
an ASCII letter on both sides of letters beyond ASCII (words then begin and end
at the same places) and take it out afterwards.
"""
from __future__ import annotations

# Fixed values, written out here so that a wrong constant of the engine shows as a difference.
CHAT_SOURCES = ["whatsapp", "messenger", "telegram", "gmail", "instagram", "linkedin", "twitter_dm"]
DOC_SOURCES = ["twitter", "reddit", "facebook", "linkedin", "notes"]
SOURCE_RANK = {
    "gmail": 0, "calendar": 1, "drive": 2, "lifelog": 3, "messenger": 4, "facebook": 5, "instagram": 6,
    "whatsapp": 7, "telegram": 8, "twitter": 9, "twitter_dm": 9, "reddit": 10, "linkedin": 11, "notes": 12, "git": 13,
}
CHANNEL = {
    "gmail": "email", "whatsapp": "WhatsApp", "messenger": "Messenger", "instagram": "Instagram DM",
    "telegram": "Telegram", "linkedin": "LinkedIn messages", "twitter_dm": "X DMs",
}
REPLY_HEADERS = [
    r"^On .{5,200}wrote:\s*$",
    r"^W dniu .{5,200}(napisał|napisała|pisze)\S*:?\s*$",
    r"^\S+ .{0,100}(napisał|napisała)\S*:\s*$",
    r"^-{2,}\s*Original Message\s*-{2,}",
    r"^-{2,}\s*Wiadomość oryginalna\s*-{2,}",
    r"^-{2,}\s*Forwarded message\s*-{2,}",
    r"^-{2,}\s*Przekazana wiadomość\s*-{2,}",
    r"^From: .+$",
    r"^Od: .+$",
    r"^Sent from my \w+",
    r"^Wysłano z (mojego )?\w+",
    r"^_{10,}$",
]
REDACTIONS = [
    ("card", r"\b(?:\d[ -]?){13,19}\b", "[CARD]"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}\b", "[IBAN]"),
    ("pesel", r"\b\d{11}\b", "[PESEL]"),
    ("secret", r"(?i)\b(password|hasło|haslo|pass|pwd|pin)\s*[:=]\s*\S+", "$1: [SECRET]"),
    ("otp", r"(?i)\b(code|kod)\s*(is|to|:)?\s*\d{4,8}\b", "$1 [OTP]"),
    ("api_key", r"\b(sk|pk|ghp|gho|xox[bap])[-_][A-Za-z0-9_-]{16,}\b", "[API_KEY]"),
]
# End of fixed values

NL = "chr(10)"
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
UNI_SPACE = (r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
             r"\x{202f}\x{205f}\x{3000}]")


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _rank_case(col="source"):
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SOURCE_RANK.items())
    return f"CASE {col} {arms} ELSE 99 END"


MSGS = f"""
conv_rows AS (
  SELECT conv_id, turn, role, 0 AS part,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS text
  FROM conversations
  UNION ALL
  SELECT conv_id, turn, role, 1 AS part, substr(text, strpos(text, chr(10)) + 1)
  FROM conversations WHERE strpos(text, chr(10)) > 0),
msgs0 AS (
  SELECT {_list(CHAT_SOURCES)}[conv_id % 7 + 1] AS source,
         CAST(conv_id AS VARCHAR) AS thread_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00'
                  + to_seconds(conv_id * 86400 + turn * 420 + (turn // 3) * 18000 + part * 30), {ISO}) AS timestamp,
         CASE WHEN role = 'assistant' THEN 'Owner' WHEN role = 'system' THEN 'System' WHEN turn % 4 = 0 THEN 'Ana' ELSE 'Ben' END AS sender,
         role = 'assistant' AS is_me, text,
         'Conversation ' || CAST(conv_id AS VARCHAR) AS thread_title,
         conv_id AS ord_block, turn * 2 + part AS ord_pos
  FROM conv_rows),
msgs AS (SELECT *, {_rank_case()} AS ord_rank FROM msgs0)"""

DOCS = f"""
docs0 AS (
  SELECT {_list(DOC_SOURCES)}[CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) % 5 + 1] AS source,
         CAST(doc_id AS VARCHAR) AS doc_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 3600), {ISO}) AS timestamp,
         'Document ' || CAST(doc_id AS VARCHAR) AS title, text, lang <> 'de' AS authored_by_me,
         CASE WHEN doc_id % 2 = 0 THEN 'post' ELSE 'comment' END AS kind, lang AS subreddit,
         doc_id AS ord_pos
  FROM documents),
docs AS (SELECT *, {_rank_case()} AS ord_rank FROM docs0)"""

ORDER = "timestamp, ord_rank, ord_block, ord_pos"
GAP = "CASE WHEN source = 'gmail' THEN 2592000000000 ELSE 14400000000 END"


def _turns_ctes(min_chars=2):
    """Prepared messages, thread flags, sessions and collapsed turns."""
    return f"""{MSGS},
p AS (SELECT *, epoch_us(TRY_CAST(substr(timestamp, 1, 19) AS TIMESTAMP)) AS t
      FROM msgs WHERE length(text) >= {min_chars}),
th AS (SELECT source, thread_id, bool_or(is_me) AS has_me,
              count(DISTINCT CASE WHEN NOT is_me THEN sender END) AS n_oth,
              min(ord_pos) AS first_pos
       FROM p GROUP BY source, thread_id),
q AS (SELECT p.*, th.n_oth > 1 AS grp, th.first_pos FROM p JOIN th USING (source, thread_id) WHERE th.has_me),
o AS (SELECT *,
        last_value(t IGNORE NULLS) OVER (PARTITION BY source, thread_id ORDER BY {ORDER}
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t_prev,
        lag(is_me) OVER (PARTITION BY source, thread_id ORDER BY {ORDER}) AS me_prev
      FROM q),
s AS (SELECT *, CASE WHEN t IS NOT NULL AND t_prev IS NOT NULL AND t - t_prev > {GAP} THEN 1 ELSE 0 END AS new_sess
      FROM o),
u AS (SELECT *, CASE WHEN new_sess = 1 OR me_prev IS NULL OR is_me <> me_prev THEN 1 ELSE 0 END AS new_turn FROM s),
v AS (SELECT *,
        CAST(sum(new_sess) OVER (PARTITION BY source, thread_id ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS session_no,
        CAST(sum(new_turn) OVER (PARTITION BY source, thread_id ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS turn_no
      FROM u),
turns AS (
  SELECT source, thread_id, turn_no, min(session_no) AS session_no, bool_or(is_me) AS is_me,
         string_agg(CASE WHEN grp AND NOT is_me THEN sender || ': ' || text ELSE text END, chr(10)
                    ORDER BY {ORDER}) AS text,
         min(timestamp) AS first_ts, min(thread_title) AS title, min(ord_rank) AS ord_rank,
         min(ord_block) AS ord_block, min(first_pos) AS first_pos
  FROM v GROUP BY source, thread_id, turn_no)"""


def _chunk_ctes(max_turns, max_chars):
    cut = f"((r.n >= {max_turns} OR r.size + t.len > {max_chars}) AND r.is_me)"
    return f""",
tl AS (SELECT *, length(text) AS len,
              min(turn_no) OVER (PARTITION BY source, thread_id, session_no) AS first_turn FROM turns),
rec AS (
  SELECT source, thread_id, session_no, turn_no, is_me, len, 0 AS chunk_no, 1 AS n, len AS size FROM tl
  WHERE turn_no = first_turn
  UNION ALL
  SELECT t.source, t.thread_id, t.session_no, t.turn_no, t.is_me, t.len,
         r.chunk_no + CASE WHEN {cut} THEN 1 ELSE 0 END,
         CASE WHEN {cut} THEN 1 ELSE r.n + 1 END,
         CASE WHEN {cut} THEN t.len ELSE r.size + t.len END
  FROM rec r JOIN tl t ON t.source = r.source AND t.thread_id = r.thread_id
                       AND t.session_no = r.session_no AND t.turn_no = r.turn_no + 1),
chunks AS (
  SELECT r.source, r.thread_id, r.session_no, CAST(r.chunk_no AS BIGINT) AS chunk_no, r.turn_no, r.is_me, r.len,
         tl.text
  FROM rec r JOIN tl USING (source, thread_id, session_no, turn_no))"""


def _channel_case():
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CHANNEL.items())
    return f"CASE source {arms} ELSE source END"


def _conv_examples(max_turns=24, max_chars=6000):
    """Conversation examples as rows: one per chunk with an owner turn."""
    return _turns_ctes() + _chunk_ctes(max_turns, max_chars) + f""",
sess AS (SELECT source, thread_id, session_no, min(first_ts) AS first_ts, min(title) AS title,
                min(ord_rank) AS ord_rank, min(ord_block) AS ord_block, min(first_pos) AS first_pos
         FROM turns GROUP BY source, thread_id, session_no),
oth AS (SELECT source, thread_id, list_sort(list(DISTINCT sender)) AS others FROM p WHERE NOT is_me
        GROUP BY source, thread_id),
cinfo AS (SELECT source, thread_id, session_no, chunk_no,
                 bool_or(is_me) AS has_me, arg_min(is_me, turn_no) AS starts_me, arg_max(is_me, turn_no) AS ends_me,
                 max(turn_no) AS last_turn
          FROM chunks GROUP BY source, thread_id, session_no, chunk_no),
kept AS (SELECT c.* FROM chunks c JOIN cinfo i USING (source, thread_id, session_no, chunk_no)
         WHERE i.has_me AND (i.ends_me OR c.turn_no < i.last_turn)),
cex AS (
  SELECT i.source, i.thread_id AS example_key, i.session_no, i.chunk_no, i.starts_me,
         'You are Owner. Conversation on ' || {_channel_case().replace('source', 'i.source')}
         || CASE WHEN coalesce(len(o.others), 0) > 0 THEN ' with ' || array_to_string(o.others[1:6], ', ') ELSE '' END
         || '. Date: ' || substr(s.first_ts, 1, 10) || '.'
         || CASE WHEN i.source = 'gmail' AND coalesce(s.title, '') <> '' THEN ' Subject: "' || s.title || '"' ELSE '' END
           AS prompt,
         s.ord_rank, s.ord_block, s.first_pos
  FROM cinfo i JOIN sess s USING (source, thread_id, session_no)
  LEFT JOIN oth o USING (source, thread_id)
  WHERE i.has_me),
cbody AS (
  SELECT source, thread_id AS example_key, session_no, chunk_no,
         string_agg(CASE WHEN is_me THEN 'assistant' ELSE 'user' END || ':' || CAST(length(text) AS VARCHAR)
                    || ':' || text, '' ORDER BY turn_no) AS enc,
         string_agg('<|im_start|>' || CASE WHEN is_me THEN 'assistant' ELSE 'user' END || chr(10) || text
                    || '<|im_end|>' || chr(10), '' ORDER BY turn_no) AS rendered,
         count(*) AS n_kept, sum(len) AS n_chars
  FROM kept GROUP BY source, thread_id, session_no, chunk_no)"""


WRITING = f""",
wex AS (
  SELECT source, doc_id AS example_key,
         'You are Owner. Conversation on ' || source || '. Date: ' || substr(timestamp, 1, 10) || '.' AS system,
         CASE source WHEN 'twitter' THEN 'Write a tweet.'
                     WHEN 'reddit' THEN 'Write a Reddit ' || kind || ' in r/' || subreddit || '.'
                     WHEN 'facebook' THEN 'Write a Facebook ' || kind || '.'
                     WHEN 'linkedin' THEN 'Write a LinkedIn post.' END AS prompt,
         text, ord_rank, ord_pos
  FROM docs WHERE authored_by_me AND source IN ('twitter', 'reddit', 'facebook', 'linkedin')
                  AND length(text) >= 20),
wdig AS (
  SELECT *, sha1('user:' || CAST(length(prompt) AS VARCHAR) || ':' || prompt || 'assistant:'
                 || CAST(length(text) AS VARCHAR) || ':' || text) AS digest FROM wex)"""


def _bucket(key):
    h = f"md5({key})"
    acc = "0"
    for i in range(4):
        word = f"CAST('0x' || substr({h}, {1 + 8 * i}, 8) AS BIGINT)"
        acc = f"(({acc}) * 296 + {word}) % 1000"
    return acc


SQL: dict[str, str] = {}

SQL["sessionize"] = f"""
WITH e AS (SELECT user_id, event_id, strftime(ts, {ISO}) AS timestamp FROM events),
e2 AS (SELECT *, epoch_us(TRY_CAST(substr(timestamp, 1, 19) AS TIMESTAMP)) AS t FROM e),
o AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY timestamp, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t_prev FROM e2),
s AS (SELECT *, CAST(sum(CASE WHEN t IS NOT NULL AND t_prev IS NOT NULL AND t - t_prev > 14400000000 THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
                AS session_no FROM o)
SELECT user_id, session_no, count(*) AS n_events,
       first(event_id ORDER BY timestamp, event_id) AS first_event_id,
       first(event_id ORDER BY timestamp DESC, event_id DESC) AS last_event_id,
       min(timestamp) AS started, max(timestamp) AS ended
FROM s GROUP BY user_id, session_no"""

SQL["session_unknown_ts"] = SQL["sessionize"].replace(
    f"strftime(ts, {ISO}) AS timestamp",
    f"CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, {ISO}) END AS timestamp")

SQL["collapse_turns"] = "WITH " + _turns_ctes() + """
SELECT source, thread_id, session_no, turn_no, CASE WHEN is_me THEN 'assistant' ELSE 'user' END AS role, text
FROM turns"""

SQL["chunk_turns"] = "WITH RECURSIVE " + _turns_ctes() + _chunk_ctes(4, 800) + """
SELECT source, thread_id, session_no, chunk_no, min(turn_no) AS first_turn, max(turn_no) AS last_turn,
       count(*) AS n_turns, CAST(sum(len) AS BIGINT) AS n_chars, bool_or(is_me) AS has_me,
       count(*) - CASE WHEN arg_max(is_me, turn_no) THEN 0 ELSE 1 END AS n_kept,
       arg_min(is_me, turn_no) AS starts_with_me
FROM chunks GROUP BY source, thread_id, session_no, chunk_no"""

SQL["thread_others"] = f"""
WITH {MSGS}, p AS (SELECT * FROM msgs WHERE length(text) >= 2)
SELECT source, thread_id, array_to_string(list_sort(list(DISTINCT sender)), ', ') AS others,
       CAST(count(DISTINCT sender) AS BIGINT) AS n_others
FROM p WHERE NOT is_me GROUP BY source, thread_id"""

SQL["my_threads"] = f"""
WITH {MSGS}, p AS (SELECT * FROM msgs WHERE length(text) >= 2)
SELECT source, thread_id, count(*) AS n_messages FROM p GROUP BY source, thread_id HAVING bool_or(is_me)"""

SQL["system_prompt"] = "WITH RECURSIVE " + _conv_examples() + """
SELECT source, example_key AS thread_id, session_no, chunk_no, prompt FROM cex"""

SQL["writing_examples"] = f"WITH {DOCS}" + WRITING + """
SELECT source, example_key, system, prompt, CAST(length(text) AS BIGINT) AS n_chars FROM wex"""

SQL["dedup_examples"] = f"WITH {DOCS}" + WRITING + """
SELECT source, example_key, digest FROM (
  SELECT *, row_number() OVER (PARTITION BY digest ORDER BY ord_rank, ord_pos) AS rn FROM wdig) WHERE rn = 1"""

SQL["hash_split"] = f"""
WITH {DOCS}, b AS (SELECT source, doc_id, CAST({_bucket("source || '/' || doc_id")} AS INTEGER) AS bucket FROM docs)
SELECT source, doc_id, bucket, CASE WHEN bucket < 30 THEN 'val' ELSE 'train' END AS split FROM b"""

SQL["sft_build"] = "WITH RECURSIVE " + _conv_examples() + f",\n{DOCS.strip()}" + WRITING + f""",
conv_ex AS (
  SELECT c.source, c.example_key, 0 AS kind, c.ord_rank, c.ord_block, c.first_pos AS ord_pos, c.session_no,
         c.chunk_no,
         1 + CASE WHEN c.starts_me THEN 1 ELSE 0 END + b.n_kept AS n_messages,
         length(c.prompt) + CASE WHEN c.starts_me THEN 28 ELSE 0 END + b.n_chars AS n_chars,
         sha1(CASE WHEN c.starts_me THEN 'user:28:(you start the conversation)' ELSE '' END || b.enc) AS digest,
         sha1('<|im_start|>system' || chr(10) || c.prompt || '<|im_end|>' || chr(10)
              || CASE WHEN c.starts_me THEN '<|im_start|>user' || chr(10) || '(you start the conversation)'
                                              || '<|im_end|>' || chr(10) ELSE '' END
              || b.rendered) AS render_sha1
  FROM cex c JOIN cbody b USING (source, example_key, session_no, chunk_no)),
wr_ex AS (
  SELECT source, example_key, 1 AS kind, ord_rank, 0 AS ord_block, ord_pos, 0 AS session_no, 0 AS chunk_no,
         3 AS n_messages, length(system) + length(prompt) + length(text) AS n_chars, digest,
         sha1('<|im_start|>system' || chr(10) || system || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
              || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || text || '<|im_end|>'
              || chr(10)) AS render_sha1
  FROM wdig),
allx AS (SELECT * FROM conv_ex UNION ALL SELECT * FROM wr_ex),
kept_ex AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY digest ORDER BY kind, ord_rank, ord_block, ord_pos, session_no, chunk_no)
    AS rn FROM allx) WHERE rn = 1),
bk AS (SELECT *, CAST({_bucket("source || '/' || example_key")} AS INTEGER) AS bucket FROM kept_ex)
SELECT source, example_key, CASE WHEN bucket < 30 THEN 'val' ELSE 'train' END AS split, bucket,
       CAST(n_messages AS BIGINT) AS n_messages, CAST(n_chars AS BIGINT) AS n_chars, digest, render_sha1
FROM bk"""

SQL["example_counts"] = SQL["sft_build"].rsplit("SELECT source, example_key, CASE", 1)[0] + """
SELECT source, count(*) AS n_examples FROM bk GROUP BY source"""


# --- text operators -------------------------------------------------------------

SUFFIX = ("chr(10) || 'card 4111 1111 1111 ' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') "
          "|| ' end' || chr(10) || 'iban PL61 1090 1014 0000 0712 1981 ' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') "
          "|| ' end' || chr(10) || 'id 9' || lpad(CAST(doc_id % 10000000000 AS VARCHAR), 10, '0') "
          "|| ' end' || chr(10) || 'Hasło: x' || CAST(doc_id AS VARCHAR) || ' and pin=9' || CAST(doc_id AS VARCHAR) "
          "|| chr(10) || 'your code is ' || CAST(100000 + doc_id AS VARCHAR) "
          "|| ' thanks' || chr(10) || 'key ghp_' || md5(CAST(doc_id AS VARCHAR)) || ' end'")


def _re2_repl(repl: str) -> str:
    return repl.replace("$1", "\\1")


_LETTERS = r"([^\P{L}\x00-\x7fłŁ]+)"   # letters beyond ASCII, but for the one the patterns spell out


def _redact_chain(expr, rules=None):
    expr = f"regexp_replace({expr}, '{_LETTERS}', 'q' || chr(2) || '\\1' || chr(2) || 'q', 'g')"
    for name, pat, repl in REDACTIONS:
        if rules is None or name in rules:
            expr = f"regexp_replace({expr}, '{pat}', '{_re2_repl(repl)}', 'g')"
    return f"replace(replace({expr}, chr(2) || 'q', ''), 'q' || chr(2), '')"


def _redact_sql(rules):
    expr = _redact_chain("text", rules)
    return f"""
WITH x AS (SELECT doc_id, text || {SUFFIX} AS text FROM documents)
SELECT doc_id, {expr} AS text FROM x"""


for _name, _, _ in REDACTIONS:
    SQL[f"redact_{_name}"] = _redact_sql({_name})
SQL["redact_all"] = _redact_sql({n for n, _, _ in REDACTIONS})

_REPLY = "(?im)(?:" + "|".join(REPLY_HEADERS) + ")(?s:.*)"
_STRIP_CLASS = r"[\s\x0b\x1c-\x1f]"
SQL["strip_quotes"] = f"""
WITH x AS (SELECT doc_id, text || chr(10) || '> inline quote ' || CAST(doc_id AS VARCHAR) || chr(10)
                  || '  > indented quote' || chr(10) || 'after quote ' || CAST(doc_id AS VARCHAR) || chr(10)
                  || '-- ' || chr(10) || 'Signature ' || CAST(doc_id AS VARCHAR) || chr(10) || chr(10)
                  || 'On Mon, 4 Mar 2019 at 10:00, Ana Nowak <ana@example.com> wrote:' || chr(10) || '> old text'
                  AS text FROM documents),
c AS (SELECT doc_id, regexp_replace(regexp_replace(text, '{_REPLY}', ''), '(?m)^-- ?$(?s:.*)', '') AS text FROM x),
l AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]'),
                                 lambda s: NOT regexp_matches(s, '^{_STRIP_CLASS}*>')) AS lines FROM c)
SELECT doc_id, regexp_replace(array_to_string(lines, chr(10)), '^{_STRIP_CLASS}+|{_STRIP_CLASS}+$', '', 'g') AS text
FROM l"""

SQL["normalize_text"] = f"""
WITH x AS (SELECT doc_id, '  ' || chr(10)
                  || replace(replace(text, chr(10), ' ' || chr(9) || chr(13) || chr(10)), '. ', '.' || chr(160))
                  || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10)
                  || 'end ' || chr(9) || chr(10) || chr(10) || chr(10) || chr(10) AS text FROM documents),
n AS (SELECT doc_id, regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(160), ' '),
                     '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM x)
SELECT doc_id, regexp_replace(text, '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g') AS text FROM n"""

SQL["fix_mojibake"] = """
SELECT doc_id, text AS repaired, text AS untouched FROM documents"""

SQL["lifelog_daily"] = """
WITH f AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, props AS item, event_id AS seq FROM events),
d AS (SELECT day, kind, item, min(seq) AS seq FROM f GROUP BY day, kind, item),
r AS (SELECT *, row_number() OVER (PARTITION BY day, kind ORDER BY seq, item) AS rn FROM d),
k AS (SELECT day, kind, min(seq) AS kseq, string_agg(item, '; ' ORDER BY seq) AS items FROM r
      GROUP BY day, kind)
SELECT day AS doc_id, day || 'T00:00:00+00:00' AS timestamp, 'Activity on ' || day AS title,
       string_agg(kind || ': ' || items, chr(10) ORDER BY kseq) AS text
FROM k GROUP BY day"""

_RECORDS = f"""WITH {MSGS},{DOCS.rstrip()},
r AS (SELECT source, is_me AS mine, length(text) AS n FROM msgs
      UNION ALL SELECT source, authored_by_me, length(text) FROM docs)"""

SQL["corpus_stats"] = _RECORDS + """
SELECT source, count(*) AS records,
       CAST(floor(coalesce(sum(CASE WHEN mine THEN n END), 0) / 4) AS BIGINT) AS my_tokens,
       CAST(floor(coalesce(sum(CASE WHEN NOT mine THEN n END), 0) / 4) AS BIGINT) AS other_tokens
FROM r GROUP BY source"""

SQL["my_tokens"] = _RECORDS + """,
t AS (SELECT CAST(floor(coalesce(sum(CASE WHEN mine THEN n END), 0) / 4) AS BIGINT) AS my_tokens FROM r)
SELECT my_tokens, CASE WHEN my_tokens < 200000 THEN 'thin' WHEN my_tokens >= 1000000 THEN 'strong'
                       ELSE 'medium' END AS strength FROM t"""

SQL["unknown_senders"] = f"""
WITH {MSGS},
m AS (SELECT *, row_number() OVER (ORDER BY ord_rank, ord_block, ord_pos) AS seq FROM msgs
      WHERE NOT is_me AND source <> 'gmail'),
c AS (SELECT sender, count(*) AS n_messages, min(seq) AS first_seq FROM m GROUP BY sender)
SELECT sender, n_messages, row_number() OVER (ORDER BY n_messages DESC, first_seq) AS rank
FROM c ORDER BY n_messages DESC, first_seq LIMIT 8"""

SQL["render_chat"] = """
WITH r AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                                       ORDER BY turn) AS text FROM conversations GROUP BY conv_id)
SELECT conv_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM r"""

SQL["loss_spans"] = """
WITH c AS (SELECT conv_id, turn, role, text,
                  length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)) AS plen
           FROM conversations),
o AS (SELECT *, sum(plen) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - plen AS off FROM c)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS span_no,
       CAST(off + 22 AS BIGINT) AS span_start, CAST(off + 22 + length(text) AS BIGINT) AS span_end
FROM o WHERE role = 'assistant'"""


# --- round trips --------------------------------------------------------------

def _normalize(expr):
    e = f"replace(replace({expr}, chr(13) || chr(10), chr(10)), chr(160), ' ')"
    e = f"regexp_replace(regexp_replace({e}, '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({e}, '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g')"


CHAT_TURNS = """
ct AS (SELECT conv_id, turn,
              CASE WHEN role = 'assistant' THEN 'Owner' WHEN role = 'system' THEN 'System' WHEN turn % 4 = 0 THEN 'Ana' ELSE 'Ben' END AS sender,
              TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 86400 + turn * 420 + (turn // 3) * 18000) AS ts,
              text
       FROM conversations)"""

SQL["parse_whatsapp"] = f"""
WITH {CHAT_TURNS.strip()},
parts AS (SELECT conv_id, array_to_string(list_sort(list(DISTINCT sender)), ', ') AS participants
          FROM (SELECT conv_id, sender FROM ct UNION ALL SELECT conv_id, 'Owner' FROM ct WHERE turn = 1)
          GROUP BY conv_id),
m AS (SELECT conv_id, sender, text,
             CASE WHEN conv_id % 3 = 2 AND day(ts) <= 12
                  THEN make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), 0) ELSE ts END AS pts
      FROM ct)
SELECT 'whatsapp' AS source, 'Conv ' || CAST(conv_id AS VARCHAR) AS thread_id,
       strftime(pts, {ISO}) AS timestamp, sender, lower(sender) = 'owner' AS is_me,
       {_normalize(_redact_chain('text'))} AS text,
       'Conv ' || CAST(conv_id AS VARCHAR) AS thread_title, participants
FROM m JOIN parts USING (conv_id)
WHERE NOT (text LIKE '%<Media omitted>%' OR text LIKE '%<Multimedia pominięte>%' OR text LIKE '%image omitted%'
           OR text LIKE '%video omitted%' OR text LIKE '%sticker omitted%' OR text LIKE '%audio omitted%'
           OR text LIKE '%This message was deleted%' OR text LIKE '%Ta wiadomość została usunięta%'
           OR text LIKE '%<attached:%')"""


SQL["parse_messenger"] = f"""
WITH ct AS (SELECT conv_id, turn,
              CASE WHEN role = 'assistant' THEN 'Owner' WHEN role = 'system' THEN 'System' WHEN turn % 4 = 0 THEN 'Ana' ELSE 'Ben' END AS sender,
              TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 86400 + turn * 420 + (turn // 3) * 18000) AS ts,
              text AS text
       FROM conversations),
parts AS (SELECT conv_id, array_to_string(list_sort(list(DISTINCT sender)), ', ') AS participants FROM ct
          GROUP BY conv_id)
SELECT 'messenger' AS source,
       CASE WHEN conv_id % 2 = 0 THEN 'conv_' ELSE 'e2ee/conv_' END || CAST(conv_id AS VARCHAR) AS thread_id,
       strftime(ts, {ISO}) AS timestamp, sender, lower(sender) = 'owner' AS is_me,
       {_normalize(_redact_chain('text'))} AS text,
       'Conv ' || CAST(conv_id AS VARCHAR) AS thread_title, participants
FROM ct JOIN parts USING (conv_id)
WHERE text <> '' AND NOT text LIKE '% sent an attachment.' AND NOT text LIKE '% to your message%'"""


SQL["parse_telegram"] = f"""
WITH {CHAT_TURNS.strip()}
SELECT 'telegram' AS source, CAST(conv_id AS VARCHAR) AS thread_id, strftime(ts, {ISO}) AS timestamp,
       CASE WHEN sender = 'Owner' AND conv_id % 2 = 0 THEN 'Me Alias' ELSE sender END AS sender,
       sender = 'Owner' AS is_me, {_normalize(_redact_chain('text'))} AS text,
       'Conv ' || CAST(conv_id AS VARCHAR) AS thread_title, '' AS participants
FROM ct WHERE text <> ''"""


DOC_ROWS = """
dr AS (SELECT doc_id, lang, text, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 3600) AS ts FROM documents)"""

SQL["parse_tweets"] = f"""
WITH {DOC_ROWS.strip()}
SELECT 'twitter' AS source, CAST(doc_id AS VARCHAR) AS doc_id, strftime(ts, {ISO}) AS timestamp, 'Tweet' AS title,
       {_normalize('text')} AS text, true AS authored_by_me,
       'reply_to=' || CASE WHEN lang = 'de' THEN 'someone' ELSE '<null>' END AS meta
FROM dr WHERE NOT starts_with(text, 'RT @')"""

SQL["parse_x_dm"] = f"""
WITH {CHAT_TURNS.strip()}
SELECT 'twitter_dm' AS source, 'dm-' || CAST(conv_id AS VARCHAR) AS thread_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS timestamp,
       CASE WHEN sender = 'Owner' THEN '42' WHEN sender = 'Ana' THEN '1001' WHEN sender = 'Ben' THEN '1002'
                ELSE '1003' END AS sender,
       sender = 'Owner' AS is_me, {_normalize(_redact_chain('text'))} AS text, '' AS thread_title,
       '' AS participants
FROM ct"""

SQL["parse_reddit"] = f"""
WITH {DOC_ROWS.strip()},
r AS (SELECT doc_id, lang, ts, text AS body,
             CASE WHEN lang = 'en' THEN '' ELSE 'Doc ' || CAST(doc_id AS VARCHAR) END AS title0 FROM dr),
t AS (SELECT *, CASE WHEN title0 <> '' THEN title0
                     ELSE 'r/' || lang || CASE WHEN lang = 'fr' THEN ' post' ELSE ' comment' END END AS title
      FROM r)
SELECT 'reddit' AS source, 't1_' || CAST(doc_id AS VARCHAR) AS doc_id, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS timestamp,
       title, {_normalize("CASE WHEN lang = 'fr' THEN title || chr(10) || chr(10) || body ELSE body END")} AS text,
       true AS authored_by_me,
       'kind=' || CASE WHEN lang = 'fr' THEN 'post' ELSE 'comment' END || ';subreddit=' || lang AS meta
FROM t WHERE lang = 'fr' OR body NOT IN ('', '[deleted]', '[removed]')"""

SQL["parse_facebook"] = f"""
WITH {DOC_ROWS.strip()}
SELECT 'facebook' AS source,
       CASE WHEN doc_id % 2 = 0 THEN 'post-' ELSE 'comment-' END || CAST(epoch(ts) AS BIGINT) AS doc_id,
       strftime(ts, {ISO}) AS timestamp, 'Doc ' || CAST(doc_id AS VARCHAR) AS title, {_normalize('text')} AS text,
       true AS authored_by_me, 'kind=' || CASE WHEN doc_id % 2 = 0 THEN 'post' ELSE 'comment' END AS meta
FROM dr WHERE text <> ''"""

SQL["parse_linkedin"] = f"""
WITH {CHAT_TURNS.strip()}
SELECT 'linkedin' AS source, 'li-' || CAST(conv_id AS VARCHAR) AS thread_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS timestamp, sender, lower(sender) = 'owner' AS is_me,
       {_normalize(_redact_chain('text'))} AS text,
       CASE WHEN conv_id % 2 = 0 THEN 'Conv ' || CAST(conv_id AS VARCHAR) ELSE 'Hello' END AS thread_title,
       '' AS participants
FROM ct"""


SQL["html_text"] = f"""
WITH a AS (SELECT page_id,
             regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
               '(?is)<script\\b[^>]*>.*?</script\\s*>', chr(1), 'g'),
               '(?is)<style\\b[^>]*>.*?</style\\s*>', chr(1), 'g'),
               '(?is)<head\\b[^>]*>.*?</head\\s*>', chr(1), 'g'),
               '(?s)<!--.*?-->|<![^>]*>|<[^>]*>', chr(1), 'g') AS h
           FROM pages),
b AS (SELECT page_id, list_filter(list_transform(string_split(h, chr(1)),
               lambda x: CASE WHEN regexp_full_match(x, '[ \\t\\n\\r\\f]+')
                              THEN CASE WHEN strpos(x, chr(10)) > 0 THEN chr(10) ELSE ' ' END ELSE x END),
               lambda x: x <> '') AS parts FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(array_to_string(parts, chr(10)),
               '&quot;', '"'), '&middot;', chr(183)), '&copy;', chr(169)), '&lt;', '<'), '&gt;', '>'),
               '&amp;', '&') AS t FROM b)
SELECT page_id, regexp_replace(regexp_replace(t, '\\n{{3,}}', chr(10) || chr(10), 'g'),
                               '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g') AS text FROM c"""


def _files_sql(source, authored, prefix_case):
    body = ("CASE WHEN lang = 'de' THEN " + "regexp_replace(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), "
            f"'^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g') ELSE text END")
    return f"""
WITH {DOC_ROWS.strip()},
f AS (SELECT doc_id, lang, ts, {_normalize(_redact_chain(body))} AS text FROM dr)
SELECT '{source}' AS source,
       {prefix_case}lang || '/doc_' || CAST(doc_id AS VARCHAR)
         || CASE lang WHEN 'en' THEN '.md' WHEN 'fr' THEN '.txt' WHEN 'es' THEN '.org' ELSE '.html' END AS doc_id,
       strftime(ts, {ISO}) AS timestamp, 'doc_' || CAST(doc_id AS VARCHAR) AS title, text,
       {authored} AS authored_by_me, '' AS meta
FROM f WHERE length(text) >= 20"""


SQL["parse_notes"] = _files_sql("notes", "true", "")
_PAGE = ("'<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><p>' || "
         "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><!-- end --></body></html>'")
SQL["parse_drive"] = _files_sql("drive", "false", "") + f"""
UNION ALL
SELECT 'drive', 'archive/drive/kept.md', strftime(ts, {ISO}), 'kept', t, false, ''
FROM (SELECT ts, {_normalize(_redact_chain("raw"))} AS t
      FROM (SELECT ts, CASE WHEN lang = 'de' THEN {_PAGE} ELSE text END AS raw FROM dr WHERE doc_id = 0))
WHERE length(t) >= 20"""

SQL["parse_ics"] = f"""
WITH e AS (SELECT event_id, user_id, event_type, props, ts FROM events)
SELECT 'calendar' AS source, 'ev' || CAST(event_id AS VARCHAR) AS doc_id,
       strftime(CASE WHEN event_type = 'view' THEN date_trunc('day', ts) ELSE ts END, {ISO}) AS timestamp,
       CASE WHEN event_type = 'click' THEN 'click, tap ' || props ELSE event_type || ' ' || props END AS title,
       CASE WHEN event_type = 'click' THEN 'click, tap ' || props ELSE event_type || ' ' || props END
       || CASE event_type
            WHEN 'purchase' THEN chr(10) || 'Location: Shop ' || CAST(user_id AS VARCHAR)
            WHEN 'signup' THEN chr(10) || 'Description: Signed up as user ' || CAST(user_id AS VARCHAR)
                               || ' after a long walk through the onboarding flow'
            WHEN 'error' THEN chr(10) || 'With: user' || CAST(user_id AS VARCHAR) || '@example.com, MAILTO:ops@example.com'
            ELSE '' END AS text,
       false AS authored_by_me, 'calendar=user_' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS meta
FROM e"""

SQL["parse_commits"] = f"""
WITH {DOC_ROWS.strip()},
c AS (SELECT doc_id, lang, ts, regexp_replace(text, '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g') AS body FROM dr)
SELECT 'git' AS source, sha1(CAST(doc_id AS VARCHAR)) AS doc_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS timestamp,
       'Commit in repo-' || lang AS title, body AS text, true AS authored_by_me, 'repo=repo-' || lang AS meta
FROM c WHERE body <> ''"""

SQL["parse_lifelog"] = """
WITH e AS (SELECT *, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
                                     WHEN 'signup' THEN 3 ELSE 4 END AS feed,
                  row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS idx
           FROM events),
f AS (SELECT strftime(ts, '%Y-%m-%d') AS day,
             CASE event_type WHEN 'view' THEN 'Watched on YouTube' WHEN 'click' THEN 'Searched YouTube'
                             WHEN 'purchase' THEN 'Browsed' ELSE 'Visited' END AS kind,
             props AS item, feed, user_id, idx FROM e),
d AS (SELECT day, kind, item, min((feed, user_id, idx)) AS seq FROM f GROUP BY day, kind, item),
r AS (SELECT *, row_number() OVER (PARTITION BY day, kind ORDER BY seq, item) AS rn FROM d),
k AS (SELECT day, kind, min(seq) AS kseq, string_agg(item, '; ' ORDER BY seq) AS items FROM r
      GROUP BY day, kind)
SELECT day AS doc_id, day || 'T00:00:00+00:00' AS timestamp, 'Activity on ' || day AS title,
       string_agg(kind || ': ' || items, chr(10) ORDER BY kseq) AS text
FROM k GROUP BY day"""



def _strip_quotes(x):
    lines = (f"regexp_split_to_array(regexp_replace(regexp_replace({x}, '{_REPLY}', ''), '(?m)^-- ?$(?s:.*)', ''), "
             "'\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]')")
    kept = f"list_filter({lines}, lambda s: NOT regexp_matches(s, '^{_STRIP_CLASS}*>'))"
    return f"regexp_replace(array_to_string({kept}, chr(10)), '^{_STRIP_CLASS}+|{_STRIP_CLASS}+$', '', 'g')"


SQL["parse_mbox"] = f"""
WITH {CHAT_TURNS.strip()},
b AS (SELECT *, CASE
        WHEN sender <> 'Owner' THEN text || chr(10) || chr(10)
             || 'On Mon, 1 Jan 2024 at 00:00, Owner <owner@example.com> wrote:' || chr(10) || '> earlier message'
             || chr(10) || '> more'
        WHEN conv_id % 2 = 0 THEN text || chr(10) || '-- ' || chr(10) || 'Owner' || chr(10) || 'Sent with care'
        ELSE regexp_replace(regexp_replace(text, '\\n{{3,}}', chr(10) || chr(10), 'g'),
                            '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g') END AS body
      FROM ct),
m AS (SELECT *, {_normalize(_redact_chain(_strip_quotes('body')))} AS clean FROM b)
SELECT 'gmail' AS source, CAST(conv_id AS VARCHAR) AS thread_id, strftime(ts, {ISO}) AS timestamp, sender,
       sender = 'Owner' AS is_me, clean AS text, 'Conv ' || CAST(conv_id AS VARCHAR) AS thread_title,
       CASE WHEN sender = 'Owner' THEN
              CASE WHEN conv_id % 2 = 0 THEN 'ana@example.com, ben@example.com, owner@example.com'
                   ELSE 'ana@example.com, owner@example.com' END
            WHEN sender = 'Ana' THEN 'ana@example.com, owner@example.com'
            WHEN sender = 'Ben' THEN 'ben@example.com, owner@example.com'
            ELSE 'owner@example.com, system@example.com' END AS participants
FROM m WHERE length(clean) >= 2"""


SQL["reingest_only"] = f"""
WITH {MSGS}
SELECT source, count(*) AS n_messages FROM msgs WHERE source NOT IN ('whatsapp', 'twitter', 'twitter_dm')
GROUP BY source
UNION ALL
SELECT 'whatsapp', count(*) FROM ({SQL["parse_whatsapp"]})"""

def _broken(n):
    return f"({n} % 25 = 2 OR {n} % 5 = 1)"


SQL["ingest_rejects"] = f"""
WITH c AS (SELECT *, {_broken("conv_id")} AS bad FROM conversations),
cs AS (SELECT DISTINCT conv_id FROM c WHERE bad),
d AS (SELECT *, {_broken("doc_id")} AS bad FROM documents),
e AS (SELECT *, {_broken("user_id")} AS bad, lpad(CAST(user_id AS VARCHAR), 12, '0') AS u FROM events)
SELECT 'messenger' AS source, CASE WHEN conv_id % 2 = 0 THEN '/exports/facebook/your_activity/messages/inbox/conv_' || conv_id || '/message_1.json'
                                   ELSE '/exports/facebook/e2ee/conv_' || conv_id || '.json' END AS path,
       'not valid JSON' AS reason, 1::BIGINT AS n FROM cs
UNION ALL SELECT 'telegram', '/exports/telegram/conv_' || conv_id || '/result.json', 'not valid JSON', 1 FROM cs
UNION ALL SELECT 'twitter_dm', '/exports/twitter/data/direct-messages-' || conv_id || '.js', 'not valid JSON', 1 FROM cs
UNION ALL SELECT 'twitter', '/exports/twitter/data/tweets-' || doc_id || s || '.js', 'not valid JSON', 1
          FROM d, (VALUES (''), ('-rt')) x(s) WHERE bad AND (s = '' OR lang = 'es')
UNION ALL SELECT 'facebook', CASE WHEN doc_id % 2 = 0 THEN '/exports/facebook/your_activity/posts/your_posts_'
                                  ELSE '/exports/facebook/your_activity/comments/comments_' END || doc_id || '.json', 'not valid JSON', 1
          FROM d WHERE bad
UNION ALL SELECT 'reddit', 'file=' || doc_id // 100, 'a quote is not closed', 1 FROM (SELECT DISTINCT doc_id // 100 * 100 AS doc_id FROM documents) x
          WHERE doc_id // 100 % 2 = 1
UNION ALL SELECT DISTINCT 'lifelog', CASE event_type
              WHEN 'view' THEN '/exports/google/Takeout/YouTube/watch/' || u || '/watch-history.json'
              WHEN 'click' THEN '/exports/google/Takeout/YouTube/search/' || u || '/search-history.json'
              WHEN 'purchase' THEN '/exports/google/Takeout/Chrome/' || u || '/History.json'
              WHEN 'signup' THEN '/exports/google/Takeout/Timeline/' || u || '/Timeline.json'
              ELSE '/exports/google/Takeout/Location History/Semantic Location History/2024/user_' || u || '.json' END, 'not valid JSON', 1
          FROM e WHERE bad
UNION ALL SELECT 'notes', '/exports/notes/' || lang || '/doc_' || doc_id
              || CASE lang WHEN 'en' THEN '.md' WHEN 'fr' THEN '.txt' WHEN 'es' THEN '.org' ELSE '.html' END
              || CASE WHEN doc_id % 10 = 3 THEN '.docx' ELSE '' END,
              CASE WHEN doc_id % 10 = 3 THEN 'not a readable .docx file' ELSE 'larger than a document can be' END, 1
          FROM d WHERE doc_id % 10 IN (3, 4)
UNION ALL SELECT 'messenger', 'messages', '', count(*) FROM c
          WHERE NOT bad AND text <> '' AND NOT text LIKE '% sent an attachment.' AND NOT text LIKE '% to your message%' HAVING count(*) > 0
UNION ALL SELECT 'telegram', 'messages', '', count(*) FROM c WHERE NOT bad AND text <> '' HAVING count(*) > 0
UNION ALL SELECT 'twitter_dm', 'messages', '', count(*) FROM c WHERE NOT bad HAVING count(*) > 0
UNION ALL SELECT 'twitter', 'docs', '', count(*) FROM d WHERE NOT bad AND NOT starts_with(text, 'RT @') HAVING count(*) > 0
UNION ALL SELECT 'facebook', 'docs', '', count(*) FROM d WHERE NOT bad AND text <> '' HAVING count(*) > 0
UNION ALL SELECT 'reddit', 'docs', '', count(*) FROM d WHERE text NOT IN ('', '[deleted]', '[removed]') HAVING count(*) > 0
UNION ALL SELECT 'lifelog', 'docs', '', count(DISTINCT strftime(ts, '%Y-%m-%d')) FROM e WHERE NOT bad AND props <> '' HAVING count(*) > 0
UNION ALL SELECT 'notes', 'docs', '', count(*) FROM ({SQL["parse_notes"]}) x
          WHERE regexp_extract(doc_id, 'doc_([0-9]+)', 1)::BIGINT % 10 NOT IN (3, 4) HAVING count(*) > 0"""

SQL["parse_instagram"] = SQL["parse_messenger"].replace("SELECT 'messenger'", "SELECT 'instagram'")

SQL["parse_linkedin_shares"] = f"""
WITH {DOC_ROWS.strip()}
SELECT 'linkedin' AS source, 'share/' || CAST(doc_id AS VARCHAR) AS doc_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
       'LinkedIn post' AS title, {_normalize('text')} AS text, true AS authored_by_me, '' AS meta
FROM dr WHERE text <> ''"""

SQL["parse_linkedin_profile"] = """
WITH c AS (SELECT c_custkey, 'First Name: ' || c_name AS n, 'Key: ' || CAST(c_custkey AS VARCHAR) AS k,
                  CASE WHEN c_nationkey > 4 THEN chr(10) || 'Headline: ' || c_mktsegment ELSE '' END AS h FROM customer)
SELECT 'linkedin' AS source, 'profile' AS doc_id, '' AS timestamp, 'LinkedIn profile' AS title,
       CASE WHEN c_custkey % 2 = 0 THEN n || h || chr(10) || k ELSE k || h || chr(10) || n END AS text,
       true AS authored_by_me, '' AS meta
FROM c"""

SQL["parse_linkedin_positions"] = """
SELECT 'linkedin' AS source, 'positions' AS doc_id, '' AS timestamp, 'Career history' AS title,
       string_agg(o_orderpriority || ' at Company ' || CAST(o_custkey AS VARCHAR) || ' ('
                  || strftime(o_orderdate, '%Y-%m-%d') || ' – '
                  || CASE WHEN o_orderstatus = 'O' THEN 'now' ELSE strftime(o_orderdate, '%Y-%m-%d') END
                  || '): order ' || CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey) AS text,
       true AS authored_by_me, '' AS meta
FROM orders GROUP BY o_custkey"""

SQL["train_examples"] = SQL["sft_build"].rsplit("SELECT source, example_key, CASE", 1)[0] + """
SELECT source, example_key, digest FROM bk WHERE bucket >= 30"""

SQL["sft_sinks"] = f"WITH {DOCS}" + WRITING + f""",
w AS (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY ord_rank, ord_pos) AS rn FROM wdig)
SELECT CASE WHEN {_bucket("source || '/' || example_key")} < 30 THEN 'val' ELSE 'train' END AS split, source,
       sha1('system:' || system || '|user:' || prompt || '|assistant:' || text) AS body_sha1
FROM w WHERE rn = 1"""
