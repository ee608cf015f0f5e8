"""The training-data operators against plain-Python versions, on small tables with odd rows."""
from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lifecorpus.llm import (chat_format, common, exact_dedup, language_model, mixing, packing, quality, queries, simhash,
                            token_count, topk, warc)
from lifecorpus.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, `h` string, `a.b` int, score string"
SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    out, now = [], ""
    for c in text or "":
        if c in SPACE:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out + ([now] if now else [])


def documents(n=300, seed=1):
    r = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma,", "é", "日本", "x y", "DELTA", "zeta.", "<|im_end|>", "Ünder"]
    texts = [" ".join(r.choices(vocab, k=r.randint(1, 60))) for _ in range(40)]
    rows = []
    for i in range(n):
        t = r.choice(texts) if r.random() < 0.6 else " ".join(r.choices(vocab, k=r.randint(1, 80)))
        if r.random() < 0.3:
            t = t.upper() if t.isascii() else t + "\n\n\tend "
        rows.append((i, t, "en", r.choice(["a", "b", "c", "a", "a", "d"]), len(t), 5, "h", 1, "s"))
    rows += [(n, None, None, None, None, None, None, None, None), (n + 1, "", "en", None, 0, 1, "x", 2, "y"),
             (n + 2, " \n\t", "en", "a", 3, 1, "x", 2, "y"), (n + 3, "word " * 30_000, "en", "b", 5, 1, "x", 2, "y"),
             (None, "no id", "en", "c", 5, 1, "x", 2, "y"), (7, rows[7][1], "en", rows[7][3], 1, 1, "x", 2, "y"),
             (7, rows[7][1], "en", rows[7][3], 1, 1, "x", 2, "y"), (9, "other text of a known id", "en", "é", 1, 1, "x", 2, "y"),
             (n + 4, "emptysource", "en", "", 1, 1, "x", 2, "y")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- quality

def crf_by_enumeration(unary, step):
    total, marginal = 0.0, np.zeros(len(unary))
    for y in itertools.product((0, 1), repeat=len(unary)):
        s = math.exp(sum(u * v for u, v in zip(unary, y)) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += s
        marginal += s * np.array(y)
    return marginal / total, math.log(total)


def test_marginals_are_those_of_all_labelings():
    r = np.random.default_rng(3)
    step = r.normal(size=(2, 2))
    chains = [r.normal(size=n) for n in (1, 4, 2, 7, 1)]
    found, _, log_z = quality.forward_backward(chains, step)
    truth = [crf_by_enumeration(c, step) for c in chains]
    for f, (m, _) in zip(found, truth):
        assert np.allclose(f, m)
    assert np.isclose(log_z, sum(z for _, z in truth))


def test_kind_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Ab1!|#é .\n\nX" * 5
    lines = text.split("\n")
    whole = quality.kind_counts(text, len(lines))
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert (quality.kind_counts(text, len(lines)) == whole).all()
    assert whole.sum() - text.count("\n") == sum(map(len, lines))


def labelled(spark, n=240):
    r = random.Random(5)
    made = []
    for i in range(n):
        good = i % 3 != 0
        line = (lambda: " ".join(r.choices(["one", "two", "three", "four", "five", "six"], k=9)).capitalize() + ".")
        bad = (lambda: " ".join([r.choice(["SPAM!!", "BUY|", "$$$"])] * 12))
        made.append((i, "\n".join((line if good else bad)() for _ in range(r.randint(1, 6))), int(good)))
    return (spark.createDataFrame([(i, t, "en", "a", 1, 1, "h", 1, "s") for i, t, _ in made], SCHEMA),
            spark.createDataFrame([(i, y, None) for i, _, y in made], "doc_id long, quality int, toxic int"), made)


def test_quality_on_held_out_documents(spark):
    d, labels, made = labelled(spark)
    model = quality.train(d, labels)
    out = {x["doc_id"]: x for x in quality.classify(d, model).collect()}
    for i, t, y in made:
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= out[i]["score"] <= 1 and out[i]["predicted"] == int(out[i]["score"] >= 0.7)
    held = [i for i, *_ in made if out[i]["held_out"]]
    assert len(held) > 30 and sum(out[i]["predicted"] == made[i][2] for i in held) >= 0.97 * len(held)
    kept = quality.keep_good(d, model)
    assert kept.columns == d.columns
    assert {x["doc_id"] for x in kept.collect()} == {i for i in out if out[i]["predicted"]}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    d, labels, _ = labelled(spark)
    flip = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    a, b = quality.train(d, labels), quality.train(d, labels.withColumn("quality", flip))
    assert np.array_equal(a.unary, b.unary) and a.curve == b.curve


def test_quality_of_odd_rows(spark, docs, rows, nothing):
    d, labels, _ = labelled(spark)
    model = quality.train(d, labels)
    out = quality.classify(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= x["score"] <= 1 for x in out)
    assert quality.classify(nothing, model).count() == 0 and quality.keep_good(nothing, model).count() == 0
    none = quality.train(d, labels.limit(0))
    assert {x["score"] for x in quality.classify(docs, none).collect()} == {0.5}


# ---- mixing

def mix_by_sorting(rows, weights=(5, 2, 1), budget=1.5, most=2):
    size = {}
    by = defaultdict(list)
    for k, (i, t, _, s, *_) in enumerate(rows):
        h = int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16)
        by[s].append((h, len(words(t))))
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, target, open_ = budget * sum(size.values()), {}, set(order)
    while open_:  # give by weight, stop the full ones, go round again with the rest
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if per * weight[s] >= most * size[s]}
        if not full:
            target |= {s: per * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * size[s])
            left -= target[s]
        open_ -= full
    return size, target, by


def test_mix(docs, rows):
    size, target, by = mix_by_sorting(rows)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    source = {}
    for i, t, _, s, *_ in rows:
        source.setdefault((i, len(words(t))), s)
    for x in out:
        s = source[(x["doc_id"], x["size"])]
        assert x["source_size"] == size[s] and x["target"] == pytest.approx(target[s])
        assert 0 <= x["taken"] <= 2 * x["size"]
        taken[s] += x["taken"]
        largest[s] = max(largest[s], x["size"] * (3 if x["doc_id"] == 7 else 1))  # three rows that share a hash
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mixed_rows_follow_the_mix(docs, nothing):
    plan = Counter()
    for x in mixing.mix(docs).collect():
        plan[x["doc_id"]] += x["copies"]
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    assert Counter(x["doc_id"] for x in got.collect()) == +plan
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_mix_refines_only_the_boundary(spark):
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"),
                                      F.when(F.col("id") % 3 == 0, "big").otherwise("other").alias("source"))
    out = mixing.mix(many, weights=(1, 1), budget=0.5, most=1).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert len(out) >= 1 and all(abs(x["t"] / 3 - x["target"] / 3 * (x["t"] / x["target"])) < 1 for x in out)
    total = sum(x["t"] for x in out)
    assert abs(total - 60_000) <= 6


# ---- exact dedup

@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, rows, keep):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = exact_dedup.resolve(docs, keep=keep).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for x in out:
        by[x["text_sha256"]].append(x)
    assert len(by) == len(groups)
    for text, ids in groups.items():
        mine = by[hashlib.sha256(text.encode()).hexdigest()]
        best = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(best) if best else None
        assert {x["keep_id"] for x in mine} == {best} and {x["group_size"] for x in mine} == {len(ids)}
        assert [x["doc_id"] for x in mine if x["kept"]] == [best]


def test_deduplicated_keeps_one_whole_row_of_each_text(docs, rows, nothing):
    got = exact_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    texts = [(x["text"] or "").translate(LOWER) for x in got.collect()]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(LOWER) for _, t, *_ in rows})
    assert exact_dedup.resolve(nothing).count() == 0 and exact_dedup.deduplicated(nothing).count() == 0


def test_one_text_in_most_rows(spark):
    d = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "Same").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.resolve(d.repartition(9)).groupBy("group_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()
    assert {(x["group_size"], x["n"], x["k"]) for x in out} == {(1, 1500, 1500), (3500, 3500, 1)}


# ---- simhash

def fingerprint_slowly(text, k):
    w = words((text or "").translate(LOWER))
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def closed(pairs, nodes):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_fingerprints(rows, monkeypatch):
    slow = {t: fingerprint_slowly(t, 3) for _, t, *_ in rows[:60] + rows[-9:]}
    for t, fp in slow.items():
        assert simhash.fingerprint(t, 3) == fp
    monkeypatch.setattr(simhash, "BLOCK", 20)
    for t, fp in slow.items():
        assert simhash.fingerprint(t, 3) == fp


def planted_fingerprints():
    r = random.Random(11)
    fps = {r.getrandbits(64) for _ in range(150)} | {0}
    for base in r.sample(sorted(fps), 40):
        for n in (1, 2, 3, 3, 4, 5):
            x = base
            for b in r.sample(range(64), n):
                x ^= 1 << b
            fps.add(x)
    dense = r.getrandbits(64)  # a large group of near copies that share many variants
    for bits in itertools.combinations(range(0, 12), 3):
        fps.add(dense ^ sum(1 << b for b in bits))
    chain = r.getrandbits(64)
    for b in range(0, 60, 3):
        chain ^= 7 << b
        fps.add(chain)
    return sorted(fps)


def test_links_join_what_brute_force_joins(spark):
    fps = planted_fingerprints()
    truth = closed([(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3], fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3)
    pairs = [(int(np.int64(x["a"]).astype(np.uint64)), int(np.int64(x["b"]).astype(np.uint64))) for x in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    assert closed(pairs, fps) == truth


def test_simhash_classes(docs, rows, nothing):
    fp = [fingerprint_slowly(t, 3) if len(t or "") < 5000 else simhash.fingerprint(t, 3) for _, t, *_ in rows]
    nodes = sorted(set(fp))
    root = closed([(a, b) for a, b in itertools.combinations(nodes, 2) if (a ^ b).bit_count() <= 3], nodes)
    first = {}
    for (i, *_), f in zip(rows, fp):
        if i is not None:
            first[root[f]] = min(first.get(root[f], i), i)
    want = Counter((i, f"{f:016x}", first.get(root[f])) for (i, *_), f in zip(rows, fp))
    out = simhash.with_hex(simhash.classes(docs)).collect()
    assert Counter((x["doc_id"], x["fingerprint"], x["component_id"]) for x in out) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in want if c is not None})
    assert ids.count(None) == len({f for _, f, c in want if c is None})  # no two of these are linked
    assert simhash.classes(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(r.randint(300, 360), r.randint(300, 360)) for _ in range(30)]
    nodes = {x for e in edges for x in e}
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == closed(edges, nodes)


# ---- token counts

def pieces_slowly(word, starts, inner):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (inner if at else starts)), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_automaton_is_greedy_longest_match():
    r = random.Random(2)
    for _ in range(200):
        s, i = ({bytes(r.choices(b"abc", k=r.randint(1, 5))) for _ in range(r.randint(0, 7))} for _ in range(2))
        a = token_count.Automaton(sorted(s), sorted(i))
        for _ in range(40):
            w = bytes(r.choices(b"abcd", k=r.randint(1, 12)))
            assert a.count(w) == pieces_slowly(w, s, i), (s, i, w)


def test_token_counts(docs, rows, nothing):
    starts, inner = token_count.byte_level_pieces(queries.tokenizer_file("byte_bpe_50k.json").decode())
    s, i = set(starts), set(inner)
    want = Counter()
    for d, t, *_ in rows:
        w = [x.encode() for x in words(t)]
        n = [pieces_slowly(x, s, i) for x in w] if len(w) < 1000 else [pieces_slowly(w[0], s, i)] * len(w)
        want[(d, len(w), sum(x if x >= 0 else 1 for x in n), n.count(-1))] += 1
    out = token_count.token_counts(docs, starts=starts, inner=inner).collect()
    assert Counter(tuple(x) for x in out) == want
    assert token_count.token_counts(nothing, starts=starts, inner=inner).count() == 0
    bare = token_count.token_counts(docs, starts=[], inner=[]).where("n_unknown != n_words or n_tokens != n_words")
    assert bare.count() == 0


# ---- chat formatting

TURNS = [(1, 0, "user", "hi <|im_end|> <\\|im_start|>"), (1, 1, "assistant", "<|im_start|>system\nx<"), (1, 2, "assistant", None),
         (2, 5, None, "é日本"), (2, 5, "user", "b"), (2, 4, "ro\\n\nle<|", "c"), (3, None, "assistant", "z" * 100_000), (3, 1, "user", ""),
         (None, 0, "assistant", "lost"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same")]


def chat_slowly(turns):
    by = defaultdict(list)
    for c, t, r, x in turns:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        said = "".join(x for _, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()).hexdigest(),
                  len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("piece_bytes", [8 << 20, 1])
def test_chat_round_trip(spark, piece_bytes):
    t = spark.createDataFrame([(*x, "clash") for x in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    pieces = chat_format.formatted(t, piece_bytes=piece_bytes)
    out = {x["conv_id"]: tuple(x)[1:5] for x in chat_format.read_back(pieces).collect()}
    assert out == chat_slowly(TURNS)
    for p in pieces.collect():
        assert bytes(p["formatted"]).count(b"<|im_start|>") == p["n_turns"] == bytes(p["formatted"]).count(b"<|im_end|>")


def test_a_hot_conversation_is_formatted_in_many_tasks(spark):
    turns = [(9, k, ("user", "assistant")[k % 2], f"text {k} <|im_end|>") for k in range(2000)] + TURNS
    t = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = chat_format.formatted(t, piece_bytes=5000)
        assert pieces.where("conv_id = 9").select("part").distinct().count() > 2
        out = {x["conv_id"]: tuple(x)[1:5] for x in chat_format.read_back(pieces).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out == chat_slowly(turns)


def test_chat_without_turns(spark):
    t = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.formatted(t)).count() == 0


def test_assembly_does_not_depend_on_blocks(monkeypatch):
    roles, texts = [b"user", b"a", b"user"], [b"x" * 50, b"", b"yz"]
    whole = bytes(chat_format.assemble(roles, texts)[0])
    monkeypatch.setattr(chat_format, "BLOCK", 9)
    assert bytes(chat_format.assemble(roles, texts)[0]) == whole


# ---- packing

def test_round_robin_serves_each_token_once():
    for totals, shares in (([1000, 500, 7, 0], None), ([100, 900, 50], [5, 1, 3]), ([3], None), ([10**15, 3, 10**9], [1, 1, 1])):
        robin = packing.RoundRobin(totals, shares, 64)
        before = [0] * len(totals)
        for w in range(min(robin.windows, 60)):
            served, total = robin.at(w)
            assert all(a <= b for a, b in zip(before, served)) and total == sum(served)
            assert abs(total - w * 64) <= len(totals)
            before = served
        assert robin.at(robin.windows)[0] == totals
    robin = packing.RoundRobin([100, 900, 50], [5, 1, 3], 64)
    first = robin.at(1)[0]
    assert [abs(x - 64 * s / 9) <= 1 for x, s in zip(first, (5, 1, 3))] == [True] * 3
    seen = set()
    for q, n in enumerate([100, 900, 50]):
        for start, take, seq, off, _ in robin.pieces(q, 0, n, 32, 0):
            seen.update(range(seq * 32 + off, seq * 32 + off + take))
    assert seen == set(range(1050))


def test_ids_are_the_tokenizers_ids(rows):
    from tokenizers import Tokenizer
    import public_tokenizers
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.Encoder(queries.tokenizer_file("byte_bpe_50k.tiktoken"), queries.split_pattern(), queries.special_tokens())
    odd = ["", " ", "  a  b ", "a\n b", "it's 'tis", "　 x", "a b ", "tab\t\tx", "<|endoftext|>", "é\x85 b\x1c c", "don't 12 ,,",
           "a <|endoftext|>  b", "<|endoftext|><|endoftext|>", "x<|endoftext|", " <|endoftext|> \n"]
    r = random.Random(8)
    odd += ["".join(r.choices(["<|endoftext|>", " ", "a", "\n", "<|", "|>", "Ü", "endoftext", "\u2003"], k=r.randint(1, 12))) for _ in range(3000)]
    for t in odd + [x[1] for x in rows[:80] if x[1]]:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == slow.encode(t, add_special_tokens=False).ids, repr(t)


def test_long_runs_of_white_space():
    from tokenizers import Tokenizer
    import public_tokenizers
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.Encoder(queries.tokenizer_file("byte_bpe_50k.tiktoken"), queries.split_pattern(), queries.special_tokens())
    for space in (" ", "\n", "\t", "\u3000", " \n"):
        for text in ("a{}b", "{}x", "a{}", "{}<|endoftext|>{}", "{},{}'s", "{}\x1c{}a"):
            t = text.replace("{}", space * 1500)
            assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == slow.encode(t, add_special_tokens=False).ids, repr((space, text))
    for n, space in ((3_000_000, "\n"), (1_200_000, " ")):
        t = "a" + space * n + "b"
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == slow.encode(t, add_special_tokens=False).ids


def test_many_weighted_queues_are_linear():
    import time
    r = random.Random(6)
    totals, shares = [r.randint(0, 10**6) for _ in range(4096)], [r.randint(1, 9) for _ in range(4096)]
    began = time.process_time()
    robin = packing.RoundRobin(totals, shares, 1 << 17)
    served, total = robin.at(robin.windows // 2)
    assert time.process_time() - began < 5 and abs(total - robin.windows // 2 * (1 << 17)) <= 4096
    assert all(a <= n for a, n in zip(served, totals))


def check_pieces(pieces, rows, length):
    enc = packing.Encoder(queries.tokenizer_file("byte_bpe_50k.tiktoken"), queries.split_pattern(), queries.special_tokens())
    want = Counter((i, tuple(np.frombuffer(enc.encode(t or ""), enc.dtype).tolist() + [1])) for i, t, *_ in rows)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_doc[(p["doc_id"], p["doc_tokens"])].append((p["start"], ids))
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
    total = sum(len(k[1]) * n for k, n in want.items())
    assert sum(len(x) for ps in by_doc.values() for _, x in ps) == total
    for (i, ids), n in want.items():
        if n == 1 and sum(1 for k in want if k[0] == i) == 1:
            assert tuple(x for _, part in sorted(by_doc[(i, len(ids))]) for x in part) == ids
    assert sorted(by_seq) == list(range(-(-total // length)))
    for k, ps in by_seq.items():
        at = 0
        for off, n in sorted(ps):
            assert off == at
            at += n
        assert at == length or k == max(by_seq) and at == total - k * length


def test_packing(docs, rows, nothing):
    how = dict(ranks=queries.tokenizer_file("byte_bpe_50k.tiktoken"), pattern=queries.split_pattern(), special=queries.special_tokens(), length=128, window=4)
    pieces = packing.pack(docs, **how).collect()
    check_pieces(pieces, rows, 128)
    source = {(i): s for i, _, _, s, *_ in rows}
    share, windows = Counter(), defaultdict(Counter)
    for p in pieces:
        share[source[p["doc_id"]]] += p["length"]
        windows[p["window_id"]][source[p["doc_id"]]] += p["length"]
    total = sum(share.values())
    for w, got in windows.items():
        n = sum(got.values())
        assert all(abs(got[s] - n * share[s] / total) <= len(share) + 2 for s in share if s not in ("a", "b", "é"))
    weighted = packing.pack(docs, weights={"a": 3, "b": 1, None: 2}, **how).collect()
    check_pieces(weighted, rows, 128)
    assert packing.pack(nothing, **how).count() == 0
    assert packing.sequences(packing.pack(nothing, **how)).count() == 0


def test_sequences_are_padded_but_at_powers_of_two(spark):
    p = spark.createDataFrame([(0, 2, 2, bytes(8)), (0, 0, 2, b"\1\0\0\0\2\0\0\0"), (1, 0, 3, bytes(12))],
                              "sequence_id long, offset long, length long, ids binary")
    out = {x["sequence_id"]: bytes(x["ids"]) for x in packing.sequences(p, length=8, pad_id=9).collect()}
    assert out[0] == b"\1\0\0\0\2\0\0\0" + bytes(8) and out[1] == bytes(12) + b"\x09\0\0\0" * 5


def test_many_sources_share_queues(docs, rows, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 2)
    how = dict(ranks=queries.tokenizer_file("byte_bpe_50k.tiktoken"), pattern=queries.split_pattern(), special=queries.special_tokens(), length=128, window=4)
    check_pieces(packing.pack(docs, **how).collect(), rows, 128)


def test_weighted_and_large_sources_keep_queues_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 6)
    many = [(i, "one two three four five", f"{i % 12}") for i in range(240)]
    many += [(1000 + i, "one two three four five", s) for i in range(240) for s in ("big", None)]
    d = spark.createDataFrame(many, "doc_id long, text string, source string").repartition(3)
    queue, weight = packing.queues_of(d, "source", {"5": 40, "gone": 9})
    of = {r["source"]: r["queue"] for r in d.select("source", queue.alias("queue")).distinct().collect()}
    assert of["5"] == "+5" and of["big"] == "+big" and weight["+5"] == 40
    shared = Counter(q for q in of.values() if q.startswith("#"))
    assert len(set(of.values())) <= 6 and sum(shared.values()) == 12 and {q: weight[q] for q in shared} == dict(shared)
    how = dict(ranks=queries.tokenizer_file("byte_bpe_50k.tiktoken"), pattern=queries.split_pattern(), special=queries.special_tokens(), length=16, window=4)
    pieces = packing.pack(d, weights={"5": 40, "gone": 9}, **how).collect()
    check_pieces(pieces, many, 16)
    first = Counter()
    for p in pieces:
        if p["window_id"] == 0:
            first[dict((i, s) for i, _, s in many)[p["doc_id"]]] += p["length"]
    # of weights 40 to 13 others of 1 (12 of them behind shared queues), source 5 has 40 of 53 shares
    assert abs(first["5"] - 64 * 40 / 53) <= 2


# ---- search

def topk_slowly(vectors, k, every):
    ok = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in ok:
        if i % every == 0 and (i not in asked or tuple(v) < tuple(asked[i])):
            asked[i] = v
    out = set()
    for q, a in asked.items():
        best = sorted((-int(a @ v), i) for i, v in ok if i != q and len(v) == len(a))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("dim", [64, 6, 7])
def test_topk(spark, dim):
    r = np.random.default_rng(dim)
    centre = r.normal(size=(5, dim))
    vs = [(i, [float(np.float32(x)) for x in centre[i % 5] + 0.2 * r.normal(size=dim)]) for i in range(400)]
    vs += [(400, None), (401, [1.0] * (dim - 1) + [None]), (450, [float("nan")] * dim), (402, [float("inf")] * dim), (500, [0.5] * 3),
           (501, [0.5] * 3), (None, vs[3][1]), (100, vs[7][1]), (403, vs[3][1]), (404, vs[3][1]), (550, []), (551, [])]
    d = spark.createDataFrame([(i, v, 1, "x") for i, v in vs], "vec_id long, embedding array<float>, label int, score string").repartition(3)
    got = {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in topk.search(d, groups=3).collect()}
    vs = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vs]
    assert got == topk_slowly(vs, 5, 50)
    assert topk.search(d.limit(0)).count() == 0


def test_vectors_beyond_64_bits_are_refused(spark):
    for v in ([1e30, 0.0], [0.0, -4e16], [float(2**31) / 256, 1.0]):
        d = spark.createDataFrame([(0, v), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="64-bit"):
            topk.search(d, groups=2).collect()
    far = float(2**22)
    d = spark.createDataFrame([(0, [far, far]), (1, [-far, far]), (2, [far, far - 1])], "vec_id long, embedding array<double>")
    got = [(x["vec_id"], x["score"]) for x in topk.search(d, groups=2).collect()]
    assert sorted(got) == [(1, 0), (2, 2**60 + 2**30 * (2**30 - 256))]


def test_bounds_hold():
    r = np.random.default_rng(1)
    q, x = r.normal(size=(20, 32)), r.normal(size=(30, 32)) + 1
    levels = list(zip(topk.segment_statistics(q), topk.segment_statistics(x)))
    assert len(levels) >= 3
    for a, b in levels:
        assert (topk.bound(a, b) + 1e-9 >= q @ x.T).all()


def test_ties_and_pruning_over_blocks():
    r = np.random.default_rng(4)
    x = r.integers(-2, 3, size=(900, 8))
    ids = r.permutation(900)
    q, q_ids = x[:40], ids[:40]
    best = topk.Best(len(q), 5)
    for s in range(0, 900, 130):
        topk.search_block(best, q_ids, q, ids[s:s + 130], x[s:s + 130])
    for n in range(len(q)):
        want = sorted((-int(q[n] @ x[j]), ids[j]) for j in range(900) if ids[j] != q_ids[n])[:5]
        assert [(-s, i) for s, i in zip(best.score[n], best.id[n])] == want


# ---- language model

def test_base_scores_and_counts(docs, rows, nothing):
    def tokens(t):
        return [w.encode() for w in words((t or "").translate(LOWER))] + [b" "]
    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t, *_ in rows:
        w = tokens(t)
        want[(i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 5))] += 1
    out = language_model.scored(docs).collect()
    assert Counter((x["doc_id"], x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 5)) for x in out) == want
    assert all(x["score"] < 0 for x in out)
    mine = [x for x in out if x["held_out"]]
    assert sum(x["score"] for x in mine) > sum(x["base_score"] for x in mine)
    assert language_model.scored(nothing).count() == 0


def test_counts_beyond_the_common_words_are_joined(docs, rows, monkeypatch):
    whole = {(x["doc_id"], x["n_tokens"]): (x["n_known"], x["base_score"]) for x in language_model.scored(docs).collect()}
    monkeypatch.setattr(language_model, "COMMON", 3)
    few = {(x["doc_id"], x["n_tokens"]): (x["n_known"], x["base_score"]) for x in language_model.scored(docs).collect()}
    assert whole.keys() == few.keys()
    for k in whole:
        assert whole[k][0] == few[k][0] and whole[k][1] == pytest.approx(few[k][1])


def test_training_reads_every_document(spark):
    rows = [(i, f"w{i} w{i}") for i in range(300)] + [(300, " ".join(f"v{i}" for i in range(500)))]
    _, v, m = language_model.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    moved = np.abs(m.x - language_model.Model.first(v).x).max(1)[:len(v.words)]
    assert len(v.words) == 801 and (moved > 1e-6).all()  # a word no window holds keeps its first weights


def test_lanes_deal_every_token_once():
    r = np.random.default_rng(5)
    docs = [np.r_[r.integers(1, 50, n), 0].astype(np.uint16) for n in (0, 3, 200, 70, 31, 32, 33, 500, 1) * 3]
    got = list(language_model.dealt(iter(docs), 4))
    x, y = (np.vstack([w[i] for w in got]) for i in (0, 1))
    found = Counter()
    for k in range(4):
        mine = y[:, k][y[:, k] != language_model.NONE]
        assert (x[:len(mine), k] == np.r_[0, mine[:-1]]).all()
        found.update(tuple(d) for d in np.split(mine, np.flatnonzero(mine == 0) + 1)[:-1])
    assert found == Counter(tuple(d) for d in docs)


def test_lanes_end_together():
    docs = [np.r_[np.ones(n), 0].astype(np.uint16) for n in [100] * 200 + [900]]  # a long one comes last
    got = list(language_model.dealt(iter(docs), 4))
    assert len(got) <= sum(map(len, docs)) / 4 / language_model.STEPS + 5  # a short one takes over 3 windows


def test_weights_move_by_tokens_not_by_windows(monkeypatch):
    v, m = small_model()
    counts, update = [], language_model.Adam.update
    monkeypatch.setattr(language_model.Adam, "update", lambda self, g, n, share: (counts.append((n, share)), update(self, g, n, share)))
    docs = [np.r_[np.ones(n), 0].astype(np.uint16) for n in [3200] + [31] * 12]  # most windows have one lane
    seen, _ = language_model.learn(m, iter(docs), 4, 0.01)
    full = 4 * language_model.STEPS * 4
    assert sum(n for n, _ in counts) == seen == sum(map(len, docs))
    assert len(counts) <= 2 * seen / full + 1 and all(s == min(n / full, 1) for n, s in counts)


def test_pieces_hold_the_words_of_python(monkeypatch):
    r = random.Random(2)
    some = ["a", "B", "\u00e9", "\u0130", " ", "  ", *"\t\n\v\f\r\x1c\x1f\x85\xa0\0.?", "\U0001f600"]
    texts = [None, "", " ", "\n\n", *("".join(r.choices(some, k=r.randrange(60))) for _ in range(500)), None]
    want = [[w.encode() for w in words((t or "").translate(LOWER))] for t in texts]
    for size in (1 << 22, 50, 7):
        monkeypatch.setattr(language_model, "PIECE", size)
        for at in (0, 3):
            got = [[] for _ in texts]
            for row, n, found in language_model.pieces(pa.array(texts).slice(at)):
                assert language_model.shapes(found).tolist() == [language_model.shape(w) for w in found.to_pylist()]
                found = iter(found.to_pylist())
                for k, c in zip(row, n):
                    got[at + k] += [next(found) for _ in range(c)]
            assert got[at:] == want[at:]
    assert [language_model.shape(w) for w in (b"abcd", b"abcde", b"abcdefg!", b"twelve_bytes", "\u00e9.".encode())] == [0, 1, 6, 3, 12]


def test_classes_of_all_sizes_are_scored_alone():
    r, size = np.random.default_rng(6), 5 * language_model.CLASS_SIZE
    m = language_model.Model(size)
    m.flat = r.normal(0, 0.5, len(m.flat))
    m = language_model.Model(size, m.flat)
    targets = np.r_[r.integers(0, 40, 90), r.integers(64, 128, 20), [130, 200, 201], r.integers(size, size + language_model.TAILS, 30)]
    r.shuffle(targets)
    states = r.uniform(-1, 1, (len(targets), language_model.HIDDEN))
    g = language_model.Model(size, np.zeros_like(m.flat))
    logp, d = m.outputs(states, targets, g)
    want, slope = language_model.Model(size, np.zeros_like(m.flat)), np.zeros_like(states)
    for k, (h, t) in enumerate(zip(states, targets)):
        c = t // language_model.CLASS_SIZE if t < size else t - size + m.classes
        p = np.exp(h @ m.wc + m.bc)
        p /= p.sum()
        total, e = np.log(p[c]), p - np.eye(len(p))[c]
        want.wc[:] += np.outer(h, e)
        want.bc[:] += e
        slope[k] += m.wc @ e
        if t < size:
            q = np.exp(h @ m.ww[c] + m.bw[c])
            q /= q.sum()
            total, e = total + np.log(q[t % language_model.CLASS_SIZE]), q - np.eye(len(q))[t % language_model.CLASS_SIZE]
            want.ww[c] += np.outer(h, e)
            want.bw[c] += e
            slope[k] += m.ww[c] @ e
        assert logp[k] == pytest.approx(total)
    assert np.allclose(g.flat, want.flat) and np.allclose(d, slope)


def small_model():
    c = np.array([50, 30, 20, 5, 1] + [-1] * (language_model.CLASS_SIZE - 5))
    v = language_model.Vocabulary([language_model.END, b"a", b"b", b"c", b"d"], c, {}, np.arange(16.0), np.arange(16.0), 300, 30)
    m = language_model.Model.first(v)
    m.flat += np.random.default_rng(0).normal(0, 0.1, len(m.flat)).astype(np.float32)
    return v, m


def test_next_word_probabilities_sum_to_one():
    v, m = small_model()
    h = np.random.default_rng(1).uniform(-1, 1, (1, language_model.HIDDEN)).astype(np.float32)
    n = m.size + language_model.TAILS
    logp, _ = m.outputs(np.repeat(h, n, 0), np.arange(n))
    assert np.exp(logp).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_over_windows_and_lanes():
    v, m = small_model()
    r = np.random.default_rng(2)
    docs = [np.concatenate([r.integers(1, 5, n), [0]]).astype(np.int32) for n in (0, 3, 200, 70, 31, 32, 33)] * 3
    got = language_model.lane_log_likelihood(m, docs)
    for d, x in zip(docs, got):
        h, total = np.zeros((1, language_model.HIDDEN), np.float32), 0.0
        for before, now in zip([0, *d[:-1]], d):
            h = m.step(np.array([before]), h)[0]
            total += m.outputs(h, np.array([now]))[0][0]
        assert x == pytest.approx(total, rel=1e-4)


def test_training_carries_the_state_as_scoring_does():
    v, m = small_model()
    r = np.random.default_rng(4)
    docs = [np.concatenate([r.integers(1, 5, n), [0]]).astype(np.uint16) for n in (0, 3, 200, 70, 31, 32, 33, 400)]
    want = language_model.lane_log_likelihood(m, [d.astype(np.int32) for d in docs]).sum()
    seen, loss = language_model.learn(m, iter(docs), 3, 0.0)
    assert seen == sum(map(len, docs)) and -loss == pytest.approx(want, rel=1e-5)


def test_gradient_is_the_loss_slope():
    v, m = small_model()
    m = language_model.Model(m.size, m.flat.astype(np.float64))
    r = np.random.default_rng(3)
    x, y = r.integers(0, 5, (6, 3)), r.integers(0, 5, (6, 3))
    y[5, 1], y[2, 2] = language_model.NONE, m.size + 3
    g = language_model.Model(m.size, np.zeros_like(m.flat))
    m.gradient(x, y, g)
    for i in np.argsort(-np.abs(g.flat))[[0, 5, 50, 200, 400]]:
        old, e = m.flat[i], 1e-3
        m.flat[i] = old + e
        up = m.gradient(x, y, language_model.Model(m.size, np.zeros_like(m.flat)))
        m.flat[i] = old - e
        down = m.gradient(x, y, language_model.Model(m.size, np.zeros_like(m.flat)))
        m.flat[i] = old
        assert g.flat[i] == pytest.approx((up - down) / 2 / e, rel=2e-2, abs=1e-5)


# ---- revisits

def test_canonical_urls(spark):
    same = ["http://www.Example.com/a/?utm_source=x#top", "https://m.example.com/a", " HTTPS://example.com:443/a/?ref=1&fbclid=2"]
    other = ["http://example.com/a?page=2&b=1", "http://example.com/A", "http://example.com/a?b=1&page=2&utm_medium=z"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in same + other], "u string").select(warc.canonical_url(F.col("u"))).collect()]
    assert got == ["example.com/a"] * 3 + ["example.com/a?b=1&page=2", "example.com/A", "example.com/a?b=1&page=2"]


def revisits_slowly(rows):
    out = Counter()
    pages = [r for r in rows if r[3] == "response" and r[1] is not None and r[2] is not None]
    for i, url, time, kind, headers, digest in rows:
        if kind != "revisit":
            continue
        old = [p for p in pages if url is not None and time is not None and p[1] == url and (p[2], -1 if p[0] is None else p[0]) < (time, -1 if i is None else i)]
        new = {k.lower(): v for k, v in (headers or {}).items()}
        if not old:
            out[(i, "no_response", None, None)] += 1
            continue
        o = max(old, key=lambda p: (p[2], -1 if p[0] is None else p[0], p[5] is not None, p[5] or "",
                                    sorted((k.lower(), v) for k, v in (p[4] or {}).items())))
        have = {k.lower(): v for k, v in (o[4] or {}).items()}
        if "etag" in have and "etag" in new:
            status = "resolved" if have["etag"].removeprefix("W/") == new["etag"].removeprefix("W/") else "validator_mismatch"
        elif "last-modified" in have and "last-modified" in new:
            status = "resolved" if have["last-modified"] == new["last-modified"] else "validator_mismatch"
        elif digest is not None and o[5] is not None:
            status = "resolved" if digest == o[5] else "validator_mismatch"
        else:
            status = "unverified"
        if status == "validator_mismatch":
            out[(i, status, None, None)] += 1
        else:
            out[(i, status, o[0], tuple(sorted({**have, **{k: v for k, v in new.items() if k in warc.PERMITTED}}.items())))] += 1
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_revisits(spark, partitions):
    r = random.Random(8)
    rows = []
    for i in range(400):
        h = {k: f"{k}{r.randint(0, 1)}" for k in ("ETag", "Last-Modified", "Date", "Expires", "Content-Length", "Server") if r.random() < 0.6}
        rows.append((i if r.random() < 0.98 else None, "hot/x" if r.random() < 0.5 else f"h/{r.randint(0, 9)}" if r.random() < 0.95 else None,
                     r.randint(0, 60) if r.random() < 0.97 else None, r.choice(["response", "revisit", "revisit", "request"]),
                     h if r.random() < 0.9 else None, r.choice(["d1", "d2", None])))
    rows = [x for k, x in enumerate(rows) if x[0] is not None or k < 60] + [rows[1]]
    rows += [(None, "tie/a", 5, "response", {"ETag": "e", "Server": s}, d) for s, d in (("one", "d1"), ("two", "d1"), ("zwei", None))]
    rows += [(7, "tie/b", 5, "response", {"Server": s}, None) for s in ("one", "two")] + [(7, "tie/b", 5, "revisit", {}, None)]
    rows += [(1000 + k, u, 6, "revisit", {"etag": "e"} if u == "tie/a" else {}, None) for k, u in enumerate(["tie/a", "tie/b"] * 2)]
    r.shuffle(rows)
    d = spark.createDataFrame([(*x, "clash") for x in rows], "record_id long, url string, time long, kind string, "
                              "headers map<string,string>, digest string, status string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = Counter((x["record_id"], x["status"], x["refers_to"], tuple(sorted(x["headers"].items())) if x["headers"] is not None else None)
                      for x in warc.resolve(d).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == revisits_slowly(rows)
    assert warc.resolve(d.limit(0)).count() == 0


# ---- shared pieces

def test_word_blocks_cut_no_word():
    data = b" aa bbb\x0bcc\x1cd  " + b"e" * 50 + b" f"
    for size in (1, 3, 10, 1000):
        assert [w for b in common.word_blocks(data, size) for w in b] == [w.encode() for w in words(data.decode())]


@pytest.mark.parametrize("cut_again", [2, 1000])
def test_large_variants_are_cut_again(spark, monkeypatch, cut_again):
    monkeypatch.setattr(simhash, "CUT_AGAIN", cut_again)
    test_links_join_what_brute_force_joins(spark)
