"""Telegram exports taken apart by lines give what whole documents give."""
from __future__ import annotations

import json
import random

import pytest

from lifecorpus import Settings
from lifecorpus.schema import MESSAGES, REJECTS, of_kind
from lifecorpus.sources import common, telegram

ME = Settings.make("Ida Nowak", emails=["ida@example.org"], names=["ida"])


def message(r, k):
    if r.random() < 0.1:
        return {"id": k, "type": "service", "action": "pin_message", "text": ""}
    text = r.choice(["plain words", "", "two\nlines", 'quotes "and" {braces}', "     {", "é日本", [], ["a", {"type": "bold", "text": " b"}, " c\n"],
                     [{"type": "link", "text": "https://x.example"}]])
    m = {"id": k, "type": "message", "date": "2024-01-01T10:00:00", "from": r.choice(["Bo", "ida", None, "Ana"]),
         "from_id": r.choice(["user7", "user42", "user5"]), "text": text, "reactions": [{"type": "emoji", "count": 1, "recent": [{"from": "Bo"}]}]}
    if r.random() < 0.8:
        m["date_unixtime"] = str(1_700_000_000 + 60 * k)
    return m


def chat(r, i, n):
    c = {"name": r.choice([f"Chat {i}", None, 'with "quotes"', ""]), "type": "personal_chat", "id": r.choice([i, 10**12 + i]),
         "messages": [message(r, k) for k in range(n)]}
    if r.random() < 0.2:
        del c["name"]
    return c


def export(seed):
    r = random.Random(seed)
    if seed % 3 == 0:
        return chat(r, seed, r.randint(0, 40))
    out = {"about": "Here is the data", "contacts": {"list": [{"first_name": "Bo", "phone_number": "1"}]},
           "chats": {"about": "x", "list": [chat(r, i, r.choice([0, 1, 5, 200])) for i in range(r.randint(1, 5))]},
           "left_chats": {"list": [chat(r, 99, 3)]}}
    if seed % 3 == 1:
        out = {"personal_information": {"user_id": 42, "first_name": "Ida"}, **out}
    return out


def rows(df):
    return sorted((r.source, r.thread_id, r.timestamp, r.sender, r.is_me, r.text, r.thread_title) for r in of_kind(df, MESSAGES).collect())


def order(df):
    """Each file's chats and texts in their order."""
    got = sorted((tuple(r.ord.path), r.ord.block, r.ord.pos, r.thread_id, r.text) for r in of_kind(df, MESSAGES).collect())
    return [(x[0], *x[3:]) for x in got]


@pytest.mark.parametrize("segments", [None, 7])
def test_lines_give_what_documents_give(spark, segments):
    docs = [(f"/t/{k}/result.json", export(k)) for k in range(30)]
    whole = spark.createDataFrame([(p, json.dumps(d)) for p, d in docs], "path string, content string")
    layouts = [1, 1, 1, None, 2]  # Telegram's own, one line, and another tool's
    lines = []
    for k, (p, d) in enumerate(docs):
        text = json.dumps(d, indent=layouts[k % 5], ensure_ascii=False)
        lines += [(p, 0 if n < 300 else 5000, n, v) for n, v in enumerate(text.split("\n"))]
    lines = spark.createDataFrame(lines, common.LINES).repartition(6)
    got, want = telegram.telegram_line_records(lines, ME, segments=segments), telegram.telegram_records(whole, ME)
    assert rows(got) == rows(want) and len(rows(got)) > 500
    assert order(got) == order(want)
    assert of_kind(got, REJECTS).count() == 0


def test_broken_exports(spark, tmp_path):
    full = json.dumps(export(1), indent=1)
    cut = full[:full.index('"left_chats"') - 400]
    bad = full.replace('"type": "message"', '"type": "message" oops', 1)
    files = {"ok": full, "cut": cut, "bad": bad, "empty_list": "[]", "nothing": "{\n}", "compact_cut": json.dumps(export(4))[:500]}
    for name, text in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "result.json").write_text(text)
    job = telegram.telegram_job(spark, str(tmp_path), ME)
    rejected = sorted(r.path.split("/")[-2] for r in of_kind(job, REJECTS).collect())
    assert rejected == ["bad", "compact_cut", "cut", "empty_list"]
    n = {}
    for r in of_kind(job, MESSAGES).collect():
        n[r.ord.path[0]] = n.get(r.ord.path[0], 0) + 1
    assert n["ok"] - 1 <= n["bad"] <= n["ok"] and 0 < n["cut"] < n["ok"] and set(n) == {"ok", "bad", "cut"}


def test_no_export(spark, tmp_path):
    (tmp_path / "other.json").write_text("{}")
    assert telegram.telegram_job(spark, str(tmp_path), ME).count() == 0
