"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion (a full write to a no-op sink), median of
$BENCH_RUNS warm runs after one warm-up. The given tables have one row group each, which one
task reads; with $BENCH_ROW_GROUPS the run is on a copy with that many row groups a table, as
larger tables have."""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lifecorpus.operators import segmented  # noqa: E402
from lifecorpus.plans.registry import QUERIES  # noqa: E402
from lifecorpus.session import get_spark  # noqa: E402

# redactions, html_text, corpus_stats) plus the other heavy operators.
HEADLINE = ["sft_build", "sessionize", "lifelog_daily", "redact_all", "html_text", "corpus_stats",
            "strip_quotes", "collapse_turns", "chunk_turns", "dedup_examples", "parse_mbox", "parse_whatsapp"]


def with_row_groups(sf_dir: str, groups: int) -> str:
    """A copy of the tables with ``groups`` row groups each, in a new scratch folder."""
    import tempfile

    import pyarrow.parquet as pq
    out = tempfile.mkdtemp(prefix="lifecorpus-bench-")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            table = pq.read_table(os.path.join(sf_dir, name))
            pq.write_table(table, os.path.join(out, name), row_group_size=max(1, -(-table.num_rows // groups)))
    return out


def run_once(spark, fn, sf_dir):
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t0
    segmented.release()
    return dt


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    groups = int(os.environ.get("BENCH_ROW_GROUPS", "0"))
    data = with_row_groups(sf_dir, groups) if groups else sf_dir
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    out = {}
    for n in names:
        run_once(spark, QUERIES[n], data)
        out[n] = round(statistics.median(run_once(spark, QUERIES[n], data) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "runs": runs, "row_groups": groups or None}))


if __name__ == "__main__":
    main()
