"""Substring dedup: windows of words that also start in an earlier document are removed.

Windows are counted in a count-min sketch first, so that only windows which it estimates
repeated are grouped exactly. A sketch cell is never less than a window's true count, so
none is lost.

The sketch is as wide as the corpus needs (four cells a window and row), so it is never
whole in one place. Documents are dealt into chunks of a few megabytes. Each chunk counts
its windows and sends its cells, cut into blocks of the sketch, delta-coded. A block is
merged from all chunks' cells and answers every chunk with one bit a cell: repeated or not.
The chunk then takes a 128-bit digest of the words of each window whose cells all are
repeated, and sends its distinct digests with the smallest document id of each, cut into
blocks by digest. A block is grouped exactly, and again answers with one bit a digest:
whether an earlier document outside the chunk has it. Each window moves twice at most, as a
byte or two and, if estimated repeated, as a digest. Answers are bits. Nothing is broadcast
or collected, and a window that all documents share is one entry a chunk.

Every pass reads the same exchange of the documents by chunk, which Spark writes once and
reuses. A lost executor's part of it is recomputed; chunks depend on rows' contents only.

Defined cases: a null or empty text has no words; a text shorter than a window has none; a
null id comes after every id; rows of one id are not earlier than each other; rows equal in
id and text share a chunk; an empty table gives none; other columns are not read. A task
holds one chunk, or one text if that is longer, at some 30 bytes a word. A block holds the
windows of the corpus over the number of blocks, which grows with the corpus and with
``chunk_bytes``.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare, word_blocks

#: Sketch rows, and cells of a row for every window (rounded up to a power of two).
ROWS, CELLS_A_WINDOW = 2, 4
#: Cells of a block, as a power of two, while blocks are few.
BLOCK_BITS = 21
#: Bytes of text in a chunk: a millionth of the corpus, within these bounds.
LEAST_CHUNK, MOST_CHUNK = 4 << 20, 64 << 20
#: Bytes for which a word, with the white space after it, is taken when the sketch is sized.
BYTES_A_WORD = 6
#: The id that a null stands for.
LAST = np.iinfo(np.int64).max

ONE = np.uint64(1)
BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
#: Bytes hashed at once, and the length from which a word is hashed by itself.
PIECE, LONG = 1 << 18, 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit spread over all 64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: np.uint64) -> np.uint64:
    """Of an odd number modulo 2^64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


class Chunk:
    """The words of a chunk's texts, in one buffer with a space after each word."""

    def __init__(self, ids: pa.Array, texts: pa.Array, width: int) -> None:
        self.width = width
        self.ids = ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        plain = []
        for t in texts.cast(pa.large_binary()):
            data = t.as_buffer()
            blocks = (b" ".join(ws) for ws in word_blocks(data.to_pybytes())) if data is not None else ()
            plain.append(b" ".join(b for b in blocks if b))
        self.text = b" ".join(plain)
        self.first_byte = np.concatenate([[0], np.cumsum([len(p) + 1 for p in plain], dtype=np.int64)])[:-1]
        self.data = np.frombuffer(self.text, np.uint8)
        gaps = np.flatnonzero(self.data == 0x20)
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(self.data)]])
        real = ends > starts
        self.starts, self.ends = starts[real], ends[real]
        self.doc = np.searchsorted(self.first_byte, self.starts, "right") - 1
        # of documents without words several begin at one byte or at a neighbour's separator: none has a word there
        self.n_words = np.bincount(self.doc, minlength=len(plain))
        n = len(self.starts)
        self.windows = np.flatnonzero(self.doc[:n - width + 1] == self.doc[width - 1:]) if n >= width else np.empty(0, np.int64)

    def word_hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        long = (self.ends - self.starts) >= LONG
        for i in np.flatnonzero(long):
            out[i] = xxhash.xxh64_intdigest(memoryview(self.text)[self.starts[i]:self.ends[i]])
        short = np.flatnonzero(~long)
        power, back = powers(BASE, PIECE + LONG + 1), powers(inverse(BASE), PIECE + LONG + 1)
        at = 0
        while at < len(short):
            origin = self.starts[short[at]]
            to = int(np.searchsorted(self.starts[short], origin + PIECE, "right"))
            some = short[at:to]
            data = self.data[origin:self.ends[some[-1]]]
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + ONE) * power[:len(data)], out=sums[1:])
            s, e = self.starts[some] - origin, self.ends[some] - origin
            out[some] = (sums[e] - sums[s]) * back[s]
            at = to
        return mixed(out + (self.ends - self.starts).astype(np.uint64))

    def window_hashes(self) -> np.ndarray:
        """One hash for every window; equal words give equal hashes."""
        h = self.word_hashes()
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * powers(STEP, len(h)), out=sums[1:])
        w = self.windows
        return mixed((sums[w + self.width] - sums[w]) * powers(inverse(STEP), len(h))[w])

    def digests(self, windows: np.ndarray) -> np.ndarray:
        """128 bits of the words of each window, as two numbers (a row each)."""
        view = memoryview(self.text)
        spans = zip(self.starts[windows].tolist(), self.ends[windows + self.width - 1].tolist())
        return np.frombuffer(b"".join([blake2b(view[s:e], digest_size=16).digest() for s, e in spans]), ">u8").reshape(-1, 2).astype(np.uint64)


def distinct(digests: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct digests, smallest id of each, number of each row's digest)."""
    order = np.lexsort((ids, digests[:, 1], digests[:, 0]))
    d = digests[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]).any(1)
    number = np.empty(len(d), np.int64)
    number[order] = np.cumsum(new) - 1
    return d[new], ids[order][new], number


class Shape:
    """Sizes of the sketch and of its blocks for a corpus of so many bytes."""

    def __init__(self, total: int, chunk_bytes: int | None = None) -> None:
        self.chunk_bytes = chunk_bytes or min(max(total >> 20, LEAST_CHUNK), MOST_CHUNK)
        self.chunks = max(1, math.ceil(total / self.chunk_bytes))
        words = max(1, total // BYTES_A_WORD)
        self.bits = max(10, math.ceil(math.log2(CELLS_A_WINDOW * words)))
        # a chunk has some 64 cells at least in every block
        most = max(0, int(math.log2(max(1, self.chunk_bytes // BYTES_A_WORD // 64))))
        self.log_blocks = min(max(0, self.bits - BLOCK_BITS), most)
        self.block_bits = self.bits - self.log_blocks

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mixed(hashes + np.uint64(row) * BASE) >> np.uint64(64 - self.bits)

    def digest_block(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 0] >> np.uint64(63)) * np.uint64(0) if not self.log_blocks else digests[:, 0] >> np.uint64(64 - self.log_blocks)


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, for the compressor."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def packed(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(payload: bytes) -> bytes:
    return pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)


def unplaned(body: bytes, dtype: str, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8, n * size).reshape(size, n).T).view(dtype).ravel()


def cuts(blocks: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(block, begin, end) of sorted block numbers."""
    at = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - ONE)) if len(blocks) else []
    for b, e in zip(at, [*at[1:], len(blocks)]):
        yield int(blocks[b]), int(b), int(e)


SENT = pa.schema([("chunk", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])
SENT_SQL = "chunk long, block long, n long, payload binary"


def sent(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * 4, SENT)], schema=SENT)


def cell_rows(shape: Shape, chunk: int, hashes: np.ndarray) -> Iterator[tuple]:
    """A chunk's distinct cells, by block of the sketch: (chunk, block, n, cells and which were hit twice)."""
    for row in range(ROWS):
        cells, hits = np.unique(shape.cells(hashes, row), return_counts=True)
        inside = (cells & np.uint64((1 << shape.block_bits) - 1)).astype(np.int64)
        for block, b, e in cuts(cells >> np.uint64(shape.block_bits)):
            steps = np.diff(inside[b:e], prepend=0).astype(np.uint32)
            yield chunk, row << shape.log_blocks | block, e - b, packed(planes(steps) + np.packbits(hits[b:e] > 1).tobytes())


def read_cells(n: int, payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = unpacked(payload)
    return (np.cumsum(unplaned(body, "<u4", n), dtype=np.int64),
            np.unpackbits(np.frombuffer(body, np.uint8, offset=4 * n), count=n).astype(np.uint8))


def merged_cells(shape: Shape, table: pa.Table) -> pa.Table:
    """One block of the sketch from all chunks' counts, and a bit for each of their cells: hit twice or more."""
    count = np.zeros(1 << shape.block_bits, np.uint8)
    rows = list(zip(*(table[c].to_pylist() for c in ("chunk", "block", "n"))))
    for (_, _, n), p in zip(rows, table["payload"]):
        cells, twice = read_cells(n, p.as_py())
        count[cells] = np.minimum(count[cells] + ONE.astype(np.uint8) + twice, 2)
    return sent([(c, b, n, np.packbits(count[read_cells(n, p.as_py())[0]] > 1).tobytes()) for (c, b, n), p in zip(rows, table["payload"])])


def bits(answers: dict[int, tuple[int, bytes]], block: int, n: int) -> np.ndarray:
    count, payload = answers[block]
    if count != n:
        raise ValueError("a chunk was dealt other rows than before")
    return np.unpackbits(np.frombuffer(payload, np.uint8), count=n).astype(bool)


def estimated_repeated(shape: Shape, hashes: np.ndarray, answers: dict[int, tuple[int, bytes]]) -> np.ndarray:
    """Which windows the sketch estimates to occur twice or more."""
    found = []
    for row in range(ROWS):
        cells, number = np.unique(shape.cells(hashes, row), return_inverse=True)
        hit = np.empty(len(cells), bool)
        for block, b, e in cuts(cells >> np.uint64(shape.block_bits)):
            hit[b:e] = bits(answers, row << shape.log_blocks | block, e - b)
        found.append(hit[number])
    return reduce(and_, found)


def digest_rows(shape: Shape, chunk: int, digests: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    for block, b, e in cuts(shape.digest_block(digests)):
        body = np.ascontiguousarray(digests[b:e]).astype("<u8").tobytes() + planes(ids[b:e].astype("<i8"))
        yield chunk, block, e - b, packed(body)


def merged_digests(table: pa.Table) -> pa.Table:
    """Exact groups of one block of digests, and a bit for each: whether a smaller id outside the chunk has it."""
    rows = list(zip(*(table[c].to_pylist() for c in ("chunk", "block", "n"))))
    all_digests, all_ids = [], []
    for (_, _, n), p in zip(rows, table["payload"]):
        body = unpacked(p.as_py())
        all_digests.append(np.frombuffer(body, "<u8", 2 * n).reshape(n, 2))
        all_ids.append(unplaned(body[16 * n:], "<i8", n))
    ids = np.concatenate(all_ids)
    _, least, number = distinct(np.concatenate(all_digests).astype(np.uint64), ids)
    earlier, out, at = least[number] < ids, [], 0
    for c, b, n in rows:
        out.append((c, b, n, np.packbits(earlier[at:at + n]).tobytes()))
        at += n
    return sent(out)


RESULT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
RESULT_SQL = "id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"


def results(c: Chunk, ids: pa.Array, gone: np.ndarray) -> pa.Table:
    """Rows of a chunk, given the windows to remove (numbers of their first words)."""
    edge = np.zeros(len(c.starts) + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + c.width, -1)
    drop = np.cumsum(edge)[:-1] > 0
    first = np.concatenate([[0], np.cumsum(c.n_words)])
    view, rows = memoryview(c.text), []
    for k, n in enumerate(c.n_words.tolist()):
        a = int(first[k])
        d = drop[a:a + n]
        turn = np.flatnonzero(np.diff(np.concatenate([[False], d, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
        bounds = [0, *(x for t in turn for x in t), n]
        kept = [view[c.starts[a + s]:c.ends[a + e - 1]] for s, e in zip(bounds[::2], bounds[1::2]) if e > s]
        rows.append((n, int(d.sum()), [{"start": s, "end": e} for s, e in turn], b" ".join(kept)))
    n_words, n_removed, spans, kept = zip(*rows)
    return pa.table([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, RESULT.field("removed").type),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema=RESULT)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                   chunk_bytes: int | None = None) -> DataFrame:
    """One row per document: id, n_words, n_removed, removed (spans of words, end excluded) and
    kept (the other words joined by one space). A word is removed if a window of ``width`` words that
    covers it also starts in a document with a smaller id."""
    prepare(docs.sparkSession)
    src = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shape = Shape(total, chunk_bytes)
    dealt = src.select(F.pmod(F.xxhash64("id", "text"), F.lit(shape.chunks)).alias("chunk"), "id", "text")

    def chunk_of(t: pa.Table) -> tuple[Chunk, pa.Array]:
        ids = pa.concat_arrays(t["id"].chunks)
        return Chunk(ids, pa.concat_arrays([x.cast(pa.large_binary()) for x in t["text"].chunks]), width), ids

    def answered(t: pa.Table, kind: int) -> dict[int, tuple[int, bytes]]:
        return {b: (n, p) for b, n, p, k in zip(*(t[c].to_pylist() for c in ("block", "n", "payload", "kind"))) if k == kind}

    def repeated(c: Chunk, asked: pa.Table) -> np.ndarray:
        hashes = c.window_hashes()
        return c.windows[estimated_repeated(shape, hashes, answered(asked, 0))] if len(hashes) else c.windows

    def count(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        return sent(list(cell_rows(shape, key[0].as_py(), chunk_of(t)[0].window_hashes())))

    def merge(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        return merged_cells(shape, t)

    def take(key: tuple[pa.Scalar, ...], t: pa.Table, asked: pa.Table) -> pa.Table:
        c, _ = chunk_of(t)
        w = repeated(c, asked)
        if not len(w):
            return sent([])
        digests, least, _ = distinct(c.digests(w), c.ids[c.doc[w]])
        return sent(list(digest_rows(shape, t["chunk"][0].as_py(), digests, least)))

    def group(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        return merged_digests(t)

    def finish(key: tuple[pa.Scalar, ...], t: pa.Table, asked: pa.Table) -> pa.Table:
        c, ids = chunk_of(t)
        w = repeated(c, asked)
        if len(w):
            own = c.ids[c.doc[w]]
            digests, least, number = distinct(c.digests(w), own)
            answers, earlier = answered(asked, 1), np.empty(len(digests), bool)
            for block, b, e in cuts(shape.digest_block(digests)):
                earlier[b:e] = bits(answers, block, e - b)
            w = w[earlier[number] | (least[number] < own)]
        return results(c, ids, w)

    by_chunk = dealt.groupBy("chunk")
    repeats = by_chunk.applyInArrow(count, SENT_SQL).groupBy("block").applyInArrow(merge, SENT_SQL).withColumn("kind", F.lit(0))
    exact = by_chunk.cogroup(repeats.groupBy("chunk")).applyInArrow(take, SENT_SQL) \
        .groupBy("block").applyInArrow(group, SENT_SQL).withColumn("kind", F.lit(1))
    return by_chunk.cogroup(repeats.unionByName(exact).groupBy("chunk")).applyInArrow(finish, RESULT_SQL)
