"""W5 without a single-session task: chunking as a segmented finite automaton, in the JVM.

Within a session roles alternate, so a cut can only come before a user turn,
and a chunk never grows past ``max_turns + 1`` turns. The fold's whole state is
therefore the length n of the open chunk (0 = nothing yet, 1..max_turns+1);
its character size is the sum of the last n turn lengths. Turns are range-
segmented by (session, turn_no), and those of one (segment, session) become one row with
an array of (turn, side, length), no longer than a segment:

1. for sessions that lie in several segments, each part's transfer (end state and number of
   cuts, for every possible start state) is folded from its turns and the lengths
   just before it (its halo);
2. transfers are composed along the session, one fold over a row per segment;
3. every part is then folded once from its known start state. The fold gives only the
   positions of its cuts; the turns between two cuts are sliced out and numbered.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.operators import segmented as sg
from lifecorpus.settings import Settings

GROUP = ["source", "thread_id", "session_no"]


def _long(v) -> Column:
    return F.lit(v).cast("long")


def _last_sum(lens: Column, n: Column) -> Column:
    """Sum of the last n entries."""
    tail = F.slice(lens, F.greatest(F.size(lens) - n + 1, F.lit(1)).cast("int"), F.greatest(n, F.lit(0)).cast("int"))
    return F.aggregate(tail, _long(0), lambda a, b: a + b)


def _cuts(n: Column, size: Column, turn: Column, max_turns: int, max_chars: int) -> Column:
    """Whether a chunk of n turns and ``size`` characters ends before this turn."""
    return (n > 0) & ~turn["is_me"] & ((n >= max_turns) | (size + turn["len"] > max_chars))


def _transfer(turns: Column, halo: Column, max_turns: int, max_chars: int) -> Column:
    """For every start state 0..max_turns+1 the (n, cuts) after the turns."""
    begin = F.transform(F.sequence(F.lit(0), F.lit(max_turns + 1)), lambda k: F.struct(
        k.cast("long").alias("n"), _last_sum(halo, k).alias("size"), _long(0).alias("cuts")))

    def step(states: Column, turn: Column) -> Column:
        def one(s: Column) -> Column:
            cut = _cuts(s["n"], s["size"], turn, max_turns, max_chars)
            return F.struct(F.when(cut, _long(1)).otherwise(s["n"] + 1).alias("n"),
                            F.when(cut, turn["len"]).otherwise(s["size"] + turn["len"]).alias("size"),
                            (s["cuts"] + cut.cast("long")).alias("cuts"))
        return F.transform(states, one)

    return F.aggregate(turns, begin, step, lambda states: F.transform(states, lambda s: F.struct(s["n"], s["cuts"])))


def _composed(parts: Column) -> Column:
    """Of a session's (segment, transfer) in order: the (segment, state, cuts) with which each begins."""
    start = F.struct(_long(0).alias("n"), _long(0).alias("cuts"),
                     F.array().cast(f"array<struct<seg:int,state:bigint,cuts:bigint>>").alias("out"))

    def step(at: Column, part: Column) -> Column:
        after = F.element_at(part["transfer"], (at["n"] + 1).cast("int"))
        here = F.struct(part[sg.SEG].alias("seg"), at["n"].alias("state"), at["cuts"].alias("cuts"))
        return F.struct(after["n"].alias("n"), (at["cuts"] + after["cuts"]).alias("cuts"),
                        F.concat(at["out"], F.array(here)).alias("out"))
    return F.aggregate(parts, start, step, lambda at: at["out"])


def _cut_positions(turns: Column, n: Column, size: Column, max_turns: int, max_chars: int) -> Column:
    """1-based positions of the turns before which a chunk ends, starting with one of n turns."""
    start = F.struct(n.alias("n"), size.alias("size"), F.lit(1).alias("i"), F.array().cast("array<int>").alias("out"))

    def step(at: Column, turn: Column) -> Column:
        cut = _cuts(at["n"], at["size"], turn, max_turns, max_chars)
        return F.struct(F.when(cut, _long(1)).otherwise(at["n"] + 1).alias("n"),
                        F.when(cut, turn["len"]).otherwise(at["size"] + turn["len"]).alias("size"), (at["i"] + 1).alias("i"),
                        F.when(cut, F.concat(at["out"], F.array(at["i"]))).otherwise(at["out"]).alias("out"))
    return F.aggregate(turns, start, step, lambda at: at["out"])


def assign_chunk_numbers(turns: DataFrame, s: Settings, segments: int | None = None) -> DataFrame:
    """(source, thread_id, session_no, turn_no, is_me, chunk_no) for every turn;
    ``turns`` needs is_me and len (or text)."""
    M, X = s.max_turns, s.max_chars_per_example
    H = M + 1
    lens = F.col("len") if "len" in turns.columns else F.length("text")
    compact = turns.select(*GROUP, "turn_no", "is_me", lens.cast("long").alias("len"))
    order = [*GROUP, "turn_no"]
    ranged = compact.repartitionByRange(segments, *order) if segments else compact.repartitionByRange(*order)
    parts = sg.keep(ranged.withColumn(sg.SEG, F.spark_partition_id()).groupBy(sg.SEG, *GROUP).agg(
        F.sort_array(F.collect_list(F.struct("turn_no", "is_me", "len"))).alias("ts")))

    # parts of sessions that lie in several segments: at most two per segment
    key = F.struct(*GROUP)
    bounds = parts.groupBy(F.col(sg.SEG).alias("_s")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    edge = parts.join(bounds, F.col(sg.SEG) == F.col("_s")).where((key == F.col("lo")) | (key == F.col("hi"))).drop("_s", "lo", "hi")
    tail = F.transform(F.slice("ts", F.greatest(F.size("ts") - H + 1, F.lit(1)), H), lambda t: t["len"])
    # halo = last H lengths of the session before this segment: every segment of a session holds at
    # least one of its turns, so the H segments before are enough
    near = Window.partitionBy(*GROUP).orderBy(sg.SEG).rowsBetween(-H, -1)
    whole = Window.partitionBy(*GROUP)
    flat = F.flatten(F.collect_list("tail").over(near))
    halos = (edge.select(sg.SEG, *GROUP, tail.alias("tail")).withColumn("several", F.count(F.lit(1)).over(whole) > 1)
             .withColumn("halo", F.slice(flat, F.greatest(F.size(flat) - H + 1, F.lit(1)), H)).where("several")
             .select(sg.SEG, *GROUP, "halo"))

    # 1. and 2. transfers, composed along the session
    moved = sg.keep(parts.join(halos, [sg.SEG, *GROUP]).select(sg.SEG, *GROUP, "halo", _transfer(F.col("ts"), F.col("halo"), M, X).alias("transfer")))
    starts = (moved.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct(sg.SEG, "transfer"))).alias("parts"))
              .select(*GROUP, F.explode(_composed(F.col("parts"))).alias("c"))
              .select(F.col("c.seg").alias(sg.SEG), *GROUP, F.col("c.state").alias("state"), F.col("c.cuts").alias("before")))
    carry = starts.join(moved.select(sg.SEG, *GROUP, "halo"), [sg.SEG, *GROUP]) \
        .select(sg.SEG, *GROUP, "state", "before", _last_sum(F.col("halo"), F.col("state")).alias("size"))

    # 3. one fold over every part from its start state
    runs = parts.join(carry, [sg.SEG, *GROUP], "left")
    cuts = _cut_positions(F.col("ts"), F.coalesce("state", _long(0)), F.coalesce("size", _long(0)), M, X)
    runs = runs.select(*GROUP, "ts", F.coalesce("before", _long(0)).alias("before"), cuts.alias("cuts"))
    first = F.when(F.coalesce(F.get("cuts", F.lit(0)), F.lit(0)) != 1, F.array(F.struct(F.lit(1).alias("at"), _long(0).alias("k")))) \
        .otherwise(F.array().cast("array<struct<at:int,k:bigint>>"))
    begins = F.concat(first, F.transform("cuts", lambda p, i: F.struct(p.alias("at"), (i + 1).cast("long").alias("k"))))
    runs = runs.withColumn("begins", begins)
    # the turns of each chunk are sliced out before rows are made of them, so no row carries the whole array
    chunks = F.transform("begins", lambda b, i: F.struct(
        (F.col("before") + b["k"]).alias("chunk_no"),
        F.slice("ts", b["at"], F.coalesce(F.get("begins", i + 1)["at"], F.size("ts") + 1) - b["at"]).alias("turns")))
    rows = runs.select(*GROUP, F.explode(chunks).alias("c")).select(*GROUP, F.col("c.chunk_no").alias("chunk_no"), F.explode("c.turns").alias("t"))
    return rows.select(*GROUP, F.col("t.turn_no").alias("turn_no"), F.col("t.is_me").alias("is_me"), "chunk_no")
