"""Conversation repair against a search over all edits, and its spilled backpointers."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from lifecorpus.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, phase int, digest string, n string, `a.b` int"
TEXTS = ["Yes.", "no", "", " \n\t", "What?", "cut off", "Done!  ", "é…", "Yes.", None]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ux"]


def conversations(n=120, seed=3):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.choice([0, 1, 2, 3, 5, 8, 14])):
            role = r.choice(ROLES) if r.random() < 0.4 else ("user", "assistant")[t % 2]
            text = r.choice(TEXTS) if r.random() < 0.6 else f"turn {t} of {c}{r.choice(['.', '', '?'])}"
            rows.append((c, r.choice([t, t, t + 3, t]), role, text))
    rows += [(None, 1, "user", "no id."), (None, 2, "assistant", "still none."), (500, None, "user", "no turn."),
             (500, None, "user", "no turn."), (500, 1, "assistant", "yes."), (501, -2**63, "user", "far."),
             (501, 2**63 - 1, "assistant", "apart."), (2**60 + 1, 0, "user", "x" * 200_000 + "."), (2**60 + 1, 1, "assistant", "ok."),
             (502, None, None, None)]
    rows += [rows[0]] * 3
    return [(*x, 1, "z", "q", 2) for x in rows]


def key(row):
    c, t, role, text = row
    return (t is not None, t or 0, role, hashlib.sha256(text.encode()).digest())


def expected(rows):
    """By trying every edit of every row: states with (cost, audit, lines), the least kept."""
    rows = sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows), key=key)
    seen, faults = set(), []
    for _, _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))

    def grammar(s):  # the initials so far, shortened to what later edits depend on
        return s if len(s) < 2 else "s" + s[-1] if s[0] == "s" else "?" + s[-1]

    def least(ways):
        best = {}
        for w in ways:
            if w[0] not in best or w[1:3] < best[w[0]][1:3]:
                best[w[0]] = w
        return list(best.values())

    def legal(s, c):
        return c in ("u" if s == "" or s[-1] in "sa" else "a") or (c == "s" and s == "")

    def inserts(ways):
        out = list(ways)
        for _ in range(3):
            ways = [(grammar(s + c), cost + 5, audit + "I", lines + [f"{w}:"]) for s, cost, audit, lines in ways
                    for c, w in (("u", "user"), ("a", "assistant")) if legal(s, c)]
            out += ways
        return out

    ways = [("", 0, "", [])]
    for (_, _, role, text), fault in zip(rows, faults):
        new = []
        for s, cost, audit, lines in inserts(ways):
            new.append((s, cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role and legal(s, role[0]):
                new.append((grammar(s + role[0]), cost + more, audit + "K", lines + [f"{role}:{text}"]))
            for w in ("user", "assistant"):
                if legal(s, w[0]):
                    new.append((grammar(s + w[0]), cost + 1 + more, audit + "R", lines + [f"{w}:{text}"]))
        ways = least(new)
    _, cost, audit, lines = min((w for w in inserts(ways) if w[0] == "" or w[0][-1] == "a"), key=lambda w: w[1:3])
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    marks = [role[:1] for _, _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    return (turn_repair.wrapped(gaps), faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[:4])
    return out


def test_against_all_edits(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = {r[0]: tuple(r)[1:] for r in turn_repair.summary(turn_repair.repair(turns)).collect()}
    assert found == {c: expected(rs) for c, rs in by_conversation(rows).items()}


def test_long_conversation_spills(spark):
    r = random.Random(5)
    rows = [(1, t, r.choice(["user", "user", "assistant", "system"]), f"{t}" + r.choice([".", "", "!"]) if t % 9 else "ok.", 1, "z", "q", 2)
            for t in range(6000)]
    rows += [(1, 7, "user", "same.", 1, "z", "q", 2)] * 3000  # equal rows of one turn
    rows += [(2, 0, "user", "a?", 1, "z", "q", 2), (2, 1, "assistant", "b.", 1, "z", "q", 2)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r[0]: tuple(r)[1:] for r in turn_repair.summary(turn_repair.repair(turns, spool_bytes=512)).collect()}
    assert found == {c: expected(rs) for c, rs in by_conversation(rows).items()}


def test_all_user_rows_keep_two_ways_open(spark):
    rows = [(1, t, "user", f"{t}.", 1, "z", "q", 2) for t in range(2001)]
    found = turn_repair.summary(turn_repair.repair(spark.createDataFrame(rows, SCHEMA), spool_bytes=256)).collect()
    assert tuple(found[0])[1:] == expected([x[:4] for x in rows])


def test_edits_are_real_rows(spark):
    rows = [(1, 0, "user", "a.", 1, "z", "q", 2), (1, 1, "user", " ", 1, "z", "q", 2), (1, 2, "user", "b.", 1, "z", "q", 2)]
    got = [tuple(r)[1:] for r in turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()]
    assert got == [(0, "K", "", 0, "user", "user", "a."), (1, "D", "blank", 1, "user", None, None),
                   (2, "R", "", 2, "user", "assistant", "b.")]


def test_nothing(spark):
    assert turn_repair.summary(turn_repair.repair(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_with_dropped_conversations(spark, tmp_path):
    rows = conversations(80, seed=9)
    dropped = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped + 10**6, None, "user", "x.", 1, "z", "q", 2))
    rows = [x for x in rows if x[0] != dropped] + [(dropped, 0, "user", "gone.", 1, "z", "q", 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    left = {}
    for c, t, role, text, *_ in rows:
        s = [" " if v is None else v for v in (c, t, role, text)]
        fate = zlib.crc32(f"{s[0]}:{s[1]}".encode()) % 20
        left.setdefault(c, [])
        if fate:
            new = (c, t, "user" if fate == 4 else s[2], "" if fate == 1 else re.sub("[.!?]", "", s[3]) if fate == 2 else s[3])
            left[c] += [new] * (2 if fate == 3 else 1)
    want = {c: expected(rs) if rs else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, rs in left.items()}
    out = queries.op11_turn_repair(spark, str(tmp_path))
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == want
    assert out.where(F.col("audit").isNull()).count() == 0
