"""Training hand-off on the data side: render examples to one chat-template
text (A17) and locate the assistant spans that carry the loss (A18)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.operators import segmented as sg

# ---------------------------------------------------------------------------
# FIXED VALUES (chat template markers used by the trainer)
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
# End of fixed values
# ---------------------------------------------------------------------------


def _piece(m) -> Column:
    return F.concat(F.lit(IM_START), m["role"], F.lit("\n"), m["content"], F.lit(IM_END + "\n"))


def render(messages: Column) -> Column:
    """Concatenated '<|im_start|>role\\ncontent<|im_end|>\\n' pieces."""
    return F.array_join(F.transform(messages, _piece), "")


def loss_span_rows(turns: DataFrame, keys: list[str], order: list[str], segments: int | None = None) -> DataFrame:
    """A18 over rows (role, content) that make one text per group: (keys..., span_no, start, end) of
    every assistant row. Lengths and spans are summed per segment plus the carried prefix."""
    m = {"role": F.col("role"), "content": F.col("content")}
    x = turns.withColumn("_len", F.length(_piece(m)).cast("long")) \
        .withColumn("_mine", F.coalesce((F.col("role") == "assistant").cast("long"), F.lit(0)))
    x = sg.add_segments(x, keys, order, segments)
    w = sg.local_window(keys, [sg.POS]).rowsBetween(Window.unboundedPreceding, 0)
    c = sg.boundary_carry(x, keys, [F.sum("_len").alias("_l"), F.sum("_mine").alias("_m")],
                          {"_cl": lambda prev, all_: F.sum("_l").over(prev),
                           "_cm": lambda prev, all_: F.sum("_m").over(prev)})
    x = x.select(sg.SEG, *keys, "_mine", "_len", F.length("content").alias("_n"),
                 F.length(F.concat(F.lit(IM_START), "role", F.lit("\n"))).alias("_head"),
                 F.sum("_len").over(w).alias("_upto"), F.sum("_mine").over(w).alias("_no"))
    x = sg.attach_carry(x, c, keys).where(F.col("_mine") == 1)
    start = F.col("_upto") + F.coalesce("_cl", F.lit(0)) - F.col("_len") + F.col("_head")
    return x.select(*keys, (F.col("_no") + F.coalesce("_cm", F.lit(0)) - 1).cast("long").alias("span_no"),
                    start.cast("long").alias("start"), (start + F.col("_n")).cast("long").alias("end"))


def render_rows(turns: DataFrame, keys: list[str], order: list[str], segments: int | None = None) -> DataFrame:
    """A17 over rows (role, content): (keys..., text, n_turns). Turns are rendered and joined per
    range segment, then the segments' parts, so no list is longer than a segment or than the
    number of segments."""
    x = sg.add_segments(turns.select(*keys, *[c for c in order if c not in keys], "role", "content"), keys, order, segments)
    piece = _piece({"role": F.col("role"), "content": F.col("content")})
    parts = x.groupBy(*keys, sg.SEG).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(sg.POS), piece.alias("p")))), lambda e: e["p"]), "").alias("p"),
        F.count(F.lit(1)).alias("n"))
    whole = F.array_sort(F.collect_list(F.struct(F.col(sg.SEG), "p")))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(whole, lambda e: e["p"]), "").alias("text"), F.sum("n").alias("n_turns"))
