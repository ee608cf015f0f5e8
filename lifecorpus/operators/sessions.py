"""W1/W2 as a standalone operator: number sessions inside ordered groups.

A session starts when both the row's time and the last known earlier time
exist and are more than ``gap`` apart; unknown times never split and do not
reset the last known time. Groups are range-segmented (see ``segmented``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.operators import segmented as sg


def number_sessions(df: DataFrame, keys: list[str], order: list[str], t: str,
                    gap_us: Column | int, segments: int | None = None) -> DataFrame:
    """Adds ``session_no`` (0-based within each group). ``t`` holds epoch
    microseconds or null; ``order`` gives the group's row order.

    One scan per segment and one carry table: earlier segments only matter
    through the last known time, which can only turn the segment's first
    known-time row into a session start; the segment total is corrected on the
    carry table."""
    gap = gap_us if isinstance(gap_us, Column) else F.lit(gap_us)
    tc = F.col(t)
    x = sg.add_segments(df, keys, order, segments)
    w = sg.local_window(keys, [sg.POS])
    x = x.withColumn("_t_prev", F.last(t, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    new = tc.isNotNull() & F.col("_t_prev").isNotNull() & ((tc - F.col("_t_prev")) > gap)
    x = (x.withColumn("_new", F.coalesce(new, F.lit(False)).cast("int"))
         .withColumn("_fk", (tc.isNotNull() & F.col("_t_prev").isNull()).cast("int")))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_S", F.sum("_new").over(run)).withColumn("_K", F.max("_fk").over(run))
    edge = sg.boundary_summaries(x, keys, [
        F.max(F.struct(F.when(tc.isNotNull(), F.col(sg.POS)).alias("p"), tc.alias("v")))["v"].alias("last_t"),
        F.min(F.struct(F.coalesce(F.when(tc.isNotNull(), F.col(sg.POS)), F.lit(1 << 62)).alias("p"),
                       tc.alias("v")))["v"].alias("fk_t"),
        F.sum("_new").alias("s_loc"), F.first(gap).alias("gap")])
    prev, _ = sg.carry_windows(keys)
    c = edge.withColumn("c_t", F.last("last_t", ignorenulls=True).over(prev))
    corr = F.coalesce(F.col("fk_t").isNotNull() & F.col("c_t").isNotNull()
                      & ((F.col("fk_t") - F.col("c_t")) > F.col("gap")), F.lit(False)).cast("int")
    c = c.withColumn("corr", corr).withColumn("c_n", F.sum(F.col("s_loc") + F.col("corr")).over(prev))
    x = sg.attach_carry(x, c.select(sg.SEG, *keys, "corr", "c_n"), keys)
    z = F.lit(0)
    sess = (F.coalesce(F.col("c_n"), z) + F.col("_S")
            + F.when(F.col("_K") == 1, F.coalesce(F.col("corr"), z)).otherwise(z))
    return x.withColumn("session_no", sess.cast("long")).drop("_t_prev", "_new", "_fk", "_S", "_K", "corr", "c_n")
