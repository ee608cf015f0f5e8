"""Conversation structure repair by secondary-sorted streaming.

Rows of a conversation are dealt together, sorted by turn, and streamed through
``mapInPandas``. The cheapest edits that give role initials ``(s?(ua)+)?`` come from a
dynamic program over four grammar states whose costs and ranks are carried from batch to
batch. Every conversation arrives twice in the same stream, first as narrow rows without
texts (the forward pass), then with its texts. Between the two the backpointers are
followed once from the end. They are one number a row, and beyond a bound they lie in a
temporary file of the task, as a sort's spill does, so a conversation of any length needs
bounded memory and its texts are never held.

Edits and costs: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or
assistant turn 5; a truncated row that is not deleted adds 5. Blank rows and duplicates
must be deleted. Of equally cheap edits the ASCII-least string of initials is taken.

Equal rows of one turn are counted before they are dealt, and a row is a duplicate when
its role and text came before, which a window over (conversation, role, digest of the text) tells.

Defined cases: a null role or text is one space; null turns come first; ties of turn go
by role, then by the text's SHA-256; a null conversation id is one conversation; an empty
role has no initial; an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare

#: Grammar states: nothing yet, after s, after u, after a. An inserted turn is the one expected next.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (NOTHING, ASSISTANT)
#: Two inserted turns lead back to the state before them, so more are never cheapest.
MOST_INSERTS = 2
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
FAULTS = ("", "blank", "duplicate", "truncated")

#: Backpointers and decided edits of a conversation that stay in memory, in bytes; more go to a file.
SPOOL_BYTES = 4 << 20
#: Backpointers read back at once.
BLOCK = 1 << 16
#: Texts given out at once, in characters.
OUT_CHARS = 4 << 20

EDITS = "conv_id string, seq long, edit string, fault string, turn string, was string, role string, text string"


def letters(state: int, initial: str, fault: str) -> list[tuple[int, str, int]]:
    """(cost, letter, next state) of every edit of a row in a grammar state."""
    out = [(DELETE, "D", state)]
    if fault in ("blank", "duplicate"):
        return out
    more = TRUNCATED if fault == "truncated" else 0
    if initial == "s" and state == NOTHING:
        out.append((KEEP + more, "K", SYSTEM))
    elif initial in ("u", "a") and EXPECTED[state] == (USER if initial == "u" else ASSISTANT):
        out.append((KEEP + more, "K", EXPECTED[state]))
    out.append((REROLE + more, "R", EXPECTED[state]))
    return out


class Automaton:
    """The program's step as a table that fills as it is used. A vector holds for each
    grammar state (cost above the cheapest, rank of its edits among the states'). Edits
    that end at the same row and differ in state are never prefixes of one another, so
    ranks and the letters of one row order all continuations."""

    def __init__(self) -> None:
        self.steps: dict[tuple, int] = {}
        self.found: list[tuple[tuple, dict[int, tuple[int, int, str]], str]] = []
        self.start = ((0, 0), None, None, None)

    @staticmethod
    def inserted(state: int) -> Iterator[tuple[int, int]]:
        for j in range(MOST_INSERTS + 1):
            yield j, state
            state = EXPECTED[state]

    def step(self, vector: tuple, initial: str, fault: str) -> int:
        """Number of the step from ``vector`` over a row."""
        key = (vector, initial, fault)
        at = self.steps.get(key)
        if at is None:
            best: dict[int, tuple] = {}
            for a, known in enumerate(vector):
                if known is None:
                    continue
                for j, b in self.inserted(a):
                    for cost, letter, to in letters(b, initial, fault):
                        way = (known[0] + INSERT * j + cost, known[1], "I" * j + letter, a, j, letter)
                        if to not in best or way[:3] < best[to][:3]:
                            best[to] = way
            least = min(w[0] for w in best.values())
            rank = {to: k for k, to in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
            after = tuple((best[t][0] - least, rank[t]) if t in best else None for t in range(4))
            at = self.steps[key] = len(self.found)
            self.found.append((after, {t: w[3:] for t, w in best.items()}, fault))
        return at

    def finish(self, vector: tuple) -> tuple[int, int]:
        """(state, inserted turns) of the cheapest end."""
        return min((known[0] + INSERT * j, known[1], "I" * j, a, j)
                   for a, known in enumerate(vector) if known is not None
                   for j, b in self.inserted(a) if b in ENDS)[3:]


class Conversation:
    """Backpointers, then decided edits, of one conversation."""

    def __init__(self, rules: Automaton, spool_bytes: int) -> None:
        self.rules, self.vector, self.rows, self.spool_bytes = rules, rules.start, 0, spool_bytes
        self.steps = tempfile.SpooledTemporaryFile(spool_bytes)
        self.pending = array("I")

    def add(self, initial: str, fault: str) -> None:
        k = self.rules.step(self.vector, initial, fault)
        self.vector = self.rules.found[k][0]
        self.pending.append(k)
        self.rows += 1
        if len(self.pending) >= BLOCK:
            self.flush()

    def flush(self) -> None:
        self.steps.write(self.pending.tobytes())
        self.pending = array("I")

    def decide(self) -> None:
        """Follow the backpointers once; a byte a row says inserted turns, letter and fault."""
        self.flush()
        state, self.tail = self.rules.finish(self.vector)
        self.edits = tempfile.SpooledTemporaryFile(self.spool_bytes)
        end = self.rows
        while end:
            begin = max(0, end - BLOCK)
            self.steps.seek(begin * 4)
            block = array("I")
            block.frombytes(self.steps.read((end - begin) * 4))
            out = bytearray(len(block))
            for i in range(len(block) - 1, -1, -1):
                _, back, fault = self.rules.found[block[i]]
                state, j, letter = back[state]
                out[i] = j << 4 | "KRD".index(letter) << 2 | FAULTS.index(fault)
            self.edits.seek(begin)
            self.edits.write(out)
            end = begin
        self.steps.close()
        self.edits.seek(0)
        self.block, self.at, self.state, self.seq = b"", 0, NOTHING, 0

    def next(self) -> tuple[int, str, str]:
        if self.at == len(self.block):
            self.block, self.at = self.edits.read(BLOCK), 0
        code = self.block[self.at]
        self.at += 1
        return code >> 4, "KRD"[code >> 2 & 3], FAULTS[code & 3]

    def insert(self, conv, out: list) -> None:
        self.state = EXPECTED[self.state]
        out.append((conv, self.seq, "I", "", None, None, ROLE[self.state], ""))
        self.seq += 1

    def apply(self, conv, turn, role: str, text: str, out: list) -> None:
        j, letter, fault = self.next()
        for _ in range(j):
            self.insert(conv, out)
        now = role
        if letter == "R":
            self.state = EXPECTED[self.state]
            now = ROLE[self.state]
        elif letter == "K":
            self.state = SYSTEM if role[:1] == "s" else EXPECTED[self.state]
        gone = letter == "D"
        out.append((conv, self.seq, letter, fault, turn, role, None if gone else now, None if gone else text))
        self.seq += 1

    def close(self, conv, out: list) -> None:
        for _ in range(self.tail):
            self.insert(conv, out)
        self.edits.close()


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def repair(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", spool_bytes: int = SPOOL_BYTES) -> DataFrame:
    """The edits of every conversation, in order within a partition: conv_id, seq, edit (K, R,
    D or I), fault (empty, blank, duplicate or truncated), turn, was (the role before; null for
    inserted turns), role and text after the edit (null for deleted rows)."""
    prepare(turns.sparkSession)
    src = turns.select(col(id_col).alias("conv_id"), col(turn_col).alias("turn"),
                       F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(col(text_col), F.lit(" ")).alias("text"))
    src = src.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    cells = (src.select("conv_id", "turn", "role", "digest", blank(F.col("text")).alias("blank"),
                        truncated(F.col("text")).alias("cut"))
             .groupBy("conv_id", "turn", "role", "digest")
             .agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")))
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    again = F.row_number().over(seen) > 1
    fault = (F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated").otherwise(""))
    narrow = cells.select("conv_id", F.lit(0).alias("phase"), "turn", "role", "digest", "n", fault.alias("fault"),
                          F.lit(None).cast("string").alias("text"))
    whole = src.select("conv_id", F.lit(1).alias("phase"), "turn", "role", "digest", F.lit(1).cast("long").alias("n"),
                       F.lit("").alias("fault"), "text")
    dealt = narrow.unionByName(whole).repartition("conv_id") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "phase", F.col("turn").asc_nulls_first(), "role", "digest")
    # ids and turns travel as strings: pandas turns whole numbers with nulls into fractions
    sent = dealt.select(F.col("conv_id").cast("string").alias("conv_id"), "phase", F.col("turn").cast("string").alias("turn"),
                        "role", "n", "fault", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules = Automaton()
        open_id, now, decided, out, chars = None, None, False, [], 0

        def frame(rows: list) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["conv_id", "seq", "edit", "fault", "turn", "was", "role", "text"])

        for batch in batches:
            for conv, phase, turn, role, n, fault, text in zip(*(batch[c].tolist() for c in batch.columns)):
                conv = None if conv is None or conv != conv else conv
                if phase == 0:
                    if now is None or decided or conv != open_id:
                        if now is not None:
                            now.close(open_id, out)
                        open_id, now, decided = conv, Conversation(rules, spool_bytes), False
                    now.add(role[:1], fault)
                    for _ in range(n - 1):  # copies of the row at the same turn
                        now.add(role[:1], fault if fault == "blank" else "duplicate")
                else:
                    if not decided:
                        now.decide()
                        decided = True
                    now.apply(conv, None if turn is None or turn != turn else turn, role, text, out)
                    chars += len(text)
                    if len(out) >= 1000 or chars >= OUT_CHARS:
                        yield frame(out)
                        out, chars = [], 0
        if now is not None:
            now.close(open_id, out)
        if out:
            yield frame(out)

    edits = sent.mapInPandas(run, EDITS)
    kinds = {f.name: f.dataType for f in src.schema}
    return edits.select(F.col("conv_id").cast(kinds["conv_id"]).alias("conv_id"), "seq", "edit", "fault",
                        F.col("turn").cast(kinds["turn"]).alias("turn"), "was", "role", "text")


def wrapped(n: int) -> int:
    """``n`` as a 64-bit integer."""
    return (n + 2**63) % 2**64 - 2**63


SUMMARY = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def summary(edits: DataFrame) -> DataFrame:
    """One row per conversation, from its edits alone, which must lie together and in order, as
    ``repair`` gives them. Turns are whole numbers."""
    kind = edits.schema["conv_id"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, now = [], None

        def closed() -> tuple:
            turns = wrapped(now["last"] - now["first"] + 1 - now["distinct"]) if now["distinct"] else 0
            f = now["faults"]
            return (now["conv"], turns, f["blank"], f["duplicate"], f["truncated"], now["illegal"], now["cost"],
                    now["audit"].decode(), now["sha"].hexdigest())

        def frame() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY.split(", ")])

        for batch in batches:
            for conv, seq, edit, fault, turn, was, role, text in zip(*(batch[c].tolist() for c in batch.columns)):
                if seq == 0:
                    if now is not None:
                        rows.append(closed())
                    now = {"conv": conv, "first": None, "last": None, "distinct": 0, "illegal": 0, "cost": 0, "audit": bytearray(),
                           "sha": hashlib.sha256(), "lines": 0, "before": None, "faults": dict.fromkeys(FAULTS, 0)}
                now["audit"] += edit.encode()
                now["cost"] += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
                if edit != "I":
                    now["faults"][fault] += 1
                    now["cost"] += TRUNCATED if fault == "truncated" and edit != "D" else 0
                    if now["before"] is not None and now["before"] + was[:1] not in ("su", "ua", "au"):
                        now["illegal"] += 1
                    now["before"] = was[:1]
                    if turn is not None and turn == turn:
                        t = int(turn)
                        if now["last"] is None or t != now["last"]:
                            now["distinct"] += 1
                        now["first"], now["last"] = t if now["first"] is None else now["first"], t
                if edit != "D":
                    now["sha"].update(("\n" if now["lines"] else "").encode() + f"{role}:{text}".encode())
                    now["lines"] += 1
            if len(rows) >= 1000:
                yield frame()
                rows.clear()
        if now is not None:
            rows.append(closed())
        if rows:
            yield frame()

    sent = edits.select(F.col("conv_id").cast("string").alias("conv_id"), "seq", "edit", "fault",
                        F.col("turn").cast("string").alias("turn"), "was", "role", "text")
    return sent.mapInPandas(run, SUMMARY).withColumn("conv_id", F.col("conv_id").cast(kind))
