"""Chat formatting by columnar byte assembly.

A conversation is written turn by turn as ``<|im_start|>role``, a newline, the text,
``<|im_end|>`` and a newline. For a batch of turns the lengths of all segments give
cumulative offsets, these give scatter indices, and headers and contents are copied in
numpy into one buffer that becomes the Arrow output as it is.

A control string inside a text or a role cannot end a turn: every ``<``, backslashes,
``|`` gets one more backslash, which reading takes away again. In roles a backslash and a
newline are escaped first, as the header ends at a newline.

Turns are dealt by ranges of (conversation, turn), sorted and streamed: a conversation with
a third of all rows is escaped and assembled in many tasks, and a task holds one batch. It
comes out in pieces of whole turns, of about ``piece_bytes`` each, ordered by (part, piece).
Only a digest over a whole conversation is sequential: ``read_back`` streams a conversation's
finished pieces through one task.

Defined cases: a null text or role is empty; ties of turn go by role, then text; a null
conversation id is one conversation, null turns come first; an empty table gives none.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare, rows_in

START, END = b"<|im_start|>", b"<|im_end|>"
INSIDE = re.compile(rb"<(\\*)\|")
ESCAPED = re.compile(rb"<\\(\\*)\|")
#: Bytes whose scatter indices exist at once.
BLOCK = 1 << 20


def escape(text: bytes) -> bytes:
    return INSIDE.sub(rb"<\\\1|", text) if b"<" in text else text


def unescape(text: bytes) -> bytes:
    return ESCAPED.sub(rb"<\1|", text) if b"<\\" in text else text


def escape_role(role: bytes) -> bytes:
    return escape(role.replace(b"\\", b"\\\\").replace(b"\n", b"\\n"))


def unescape_role(role: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], unescape(role))


def assemble(roles: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, offset of each turn and the end, offset of each turn's text) of escaped turns."""
    n = len(texts)
    parts = [START, b"\n", END + b"\n"]
    kinds = sorted(set(roles))
    pool = [*parts, *kinds, *texts]
    src = np.frombuffer(b"".join(pool), np.uint8)
    size = np.array([len(p) for p in pool], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])[:-1]
    which = {k: len(parts) + i for i, k in enumerate(kinds)}
    seg = np.empty((n, 5), np.int64)  # the pool's entry of every segment of every turn
    seg[:, 0], seg[:, 2], seg[:, 4] = 0, 1, 2
    seg[:, 1] = [which[r] for r in roles]
    seg[:, 3] = len(parts) + len(kinds) + np.arange(n)
    lens = size[seg].ravel()
    begin = np.concatenate([[0], np.cumsum(lens)])
    out = np.empty(int(begin[-1]), np.uint8)
    origin = at[seg].ravel()
    i = 0
    while i < len(lens):  # blocks of segments; a segment beyond the block size is copied by itself
        j = max(int(np.searchsorted(begin, begin[i] + BLOCK, "right")) - 1, i + 1)
        if j == i + 1:
            out[begin[i]:begin[j]] = src[origin[i]:origin[i] + lens[i]]
        else:
            shift = np.repeat(origin[i:j] - begin[i:j], lens[i:j])
            out[begin[i]:begin[j]] = src[np.arange(begin[i], begin[j]) + shift]
        i = j
    turn = begin[::5]
    return out, turn, begin[:-1].reshape(n, 5)[:, 3] if n else np.empty(0, np.int64)


SCHEMA = "conv_id {0}, part int, piece int, n_turns long, formatted binary, loss array<struct<start:long,length:long>>"


def formatted(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", learn: str = "assistant", piece_bytes: int = 1 << 20) -> DataFrame:
    """One row per conversation, or several pieces of one that is long or lies in several tasks:
    conv_id, part and piece (which order its pieces), n_turns, formatted (UTF-8), loss (byte spans
    of the ``learn`` role's texts)."""
    prepare(turns.sparkSession)
    src = turns.select(col(id_col).alias("conv_id"), col(turn_col).alias("turn"),
                       F.coalesce(col(role_col), F.lit("")).alias("role"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    kind = src.schema["conv_id"].dataType.simpleString()
    dealt = (src.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "role", "text", F.spark_partition_id().alias("part")))
    id_type = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal id_type
        now, number, held, held_bytes, part = None, 0, [], 0, 0  # the open conversation's turns, not yet written

        def write(done: list[tuple[object, int, list[tuple[bytes, bytes]]]]) -> pa.RecordBatch:
            roles = [r for *_, ts in done for r, _ in ts]
            texts = [t for *_, ts in done for _, t in ts]
            buf, turn, text_at = assemble(roles, texts)
            first = np.concatenate([[0], np.cumsum([len(ts) for *_, ts in done])])
            ends = turn[first]
            body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(done),
                                                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buf)])
            loss = [[{"start": int(text_at[i] - ends[k]), "length": len(texts[i])}
                     for i in range(first[k], first[k + 1]) if roles[i] == learn.encode()] for k in range(len(done))]
            return pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], id_type), pa.array([part] * len(done), pa.int32()),
                 pa.array([d[1] for d in done], pa.int32()), pa.array([len(d[2]) for d in done], pa.int64()), body.cast(pa.binary()),
                 pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                ["conv_id", "part", "piece", "n_turns", "formatted", "loss"])

        begun = False
        for b in rows_in(batches, 1000):
            id_type = b.schema.field(0).type
            if b.num_rows:
                part = b.column(3)[0].as_py()
            done = []
            for c, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if begun and c != now:
                    done.append((now, number, held))
                    number, held, held_bytes = 0, [], 0
                elif held_bytes >= piece_bytes:
                    done.append((now, number, held))
                    number, held, held_bytes = number + 1, [], 0
                now, begun = c, True
                held.append((escape_role(r.encode()), escape(t.encode())))
                held_bytes += len(held[-1][1])
            if done:
                yield write(done)
        if begun:
            yield write([(now, number, held)])

    return dealt.mapInArrow(run, SCHEMA.format(kind))


def parse(piece: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn of a formatted piece."""
    out, at = [], 0
    while at < len(piece):
        if not piece.startswith(START, at):
            raise ValueError("a turn starts with its marker")
        line = piece.index(b"\n", at)
        end = piece.index(END, line)
        out.append((unescape_role(piece[at + len(START):line]), unescape(piece[line + 1:end])))
        at = end + len(END) + 1
    return out


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted bytes and loss spans alone, read in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def written(rows: list[tuple]) -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        def ended() -> tuple:
            n, turns, chars, loss, total = now
            return open_id, n, turns.hexdigest(), chars, loss.hexdigest(), total

        now, open_id, id_type = None, None, None
        for b in batches:
            id_type, rows = b.schema.field(0).type, []
            for c, body, spans in zip(*(b.column(k).to_pylist() for k in range(3))):
                if now is None or c != open_id:
                    if now is not None:
                        rows.append(ended())
                    now, open_id = start(), c
                now[4] += len(body.decode("utf-8"))
                for role, text in parse(body):
                    now[0] += 1
                    now[1].update(role + b"\n" + text + b"\n")
                for s in spans:
                    text = unescape(body[s["start"]:s["start"] + s["length"]])
                    now[2] += len(text.decode("utf-8"))
                    now[3].update(text)
            if rows:
                yield written(rows)
        if now is not None:
            yield written([ended()])

    return dealt.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")
