"""Write PLANS.md: for each headline query, the shuffles, broadcasts, scans
(read schema, pushed filters), Python stages and cached tables of its executed
(adaptive) plan, from `explain("formatted")`."""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lifecorpus.operators import segmented  # noqa: E402
from lifecorpus.operators import conversations  # noqa: E402
from lifecorpus.plans.adapters import OWNER, conversation_messages  # noqa: E402
from lifecorpus.plans.registry import QUERIES  # noqa: E402
from lifecorpus.plans.tables import table  # noqa: E402
from lifecorpus.session import get_spark  # noqa: E402

# sft_build writes its examples once, then reads them: their plan stands apart
EXAMPLES = "conversation examples, as sft_build writes them"
PLANS = {**QUERIES, EXAMPLES: lambda spark, d: conversations.conversation_examples(conversation_messages(table(spark, d, "conversations")), OWNER)}
HEADLINE = [EXAMPLES, "sft_build", "sessionize", "collapse_turns", "chunk_turns", "lifelog_daily", "redact_all", "html_text",
            "corpus_stats", "dedup_examples", "unknown_senders", "parse_mbox", "parse_whatsapp", "parse_telegram"]


def details(txt: str) -> list[tuple[str, str, dict]]:
    """(id, node name, {field: value}) from the detail section, first occurrence per id."""
    out, seen = [], set()
    for block in re.split(r"\n(?=\(\d+\) )", txt):
        m = re.match(r"\((\d+)\) ([^\n]+)", block)
        if not m or m.group(1) in seen:
            continue
        seen.add(m.group(1))
        fields = dict(re.findall(r"^(\w[\w ]*?): (.*)$", block, re.M))
        out.append((m.group(1), m.group(2).strip(), fields))
    return out


def _tree(txt: str) -> list[str]:
    return txt.split("== Physical Plan ==", 1)[-1].split("\n\n", 1)[0].split("\n")


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def subtree_ids(txt: str, marker: str) -> set[str]:
    """Ids of nodes printed below lines containing ``marker``."""
    ids, depth = set(), None
    for line in _tree(txt):
        ind = _indent(line)
        if depth is not None and ind <= depth:
            depth = None
        if marker in line and depth is None:
            depth = ind
            continue
        if depth is not None:
            ids.update(re.findall(r"\((\d+)\)", line))
    return ids


def _args(f: dict) -> str:
    return re.sub(r"#\d+L?", "", f.get("Arguments", "")).split(", [plan_id")[0]


def summarize(name: str, txt: str) -> list[str]:
    initial = subtree_ids(txt, "== Initial Plan ==")
    cached = subtree_ids(txt, "InMemoryRelation")
    nodes = [n for n in details(txt) if n[0] not in initial]
    own = [_args(f) for i, n, f in nodes if n.startswith("Exchange") and i not in cached]
    inner = list(dict.fromkeys(_args(f) for i, n, f in nodes if n.startswith("Exchange") and i in cached))
    lines = [f"### {name}", ""]
    lines.append(f"- shuffles of the query ({len(own)}): " + "; ".join(f"`{a[:100]}`" for a in own))
    if inner:
        lines.append(f"- shuffles building cached tables ({len(inner)}, computed once): "
                     + "; ".join(f"`{a[:100]}`" for a in inner))
    nb = sum(1 for _, n, _ in nodes if n.startswith("BroadcastExchange"))
    lines.append(f"- broadcasts: {nb} (chosen by Spark from measured sizes)" if nb else "- broadcasts: 0")
    for i, n, f in nodes:
        if n.startswith("Scan") and i not in cached:
            lines.append(f"- scan `{f.get('ReadSchema', '')[:150]}`, pushed filters `{f.get('PushedFilters', '[]')[:150]}`")
    scans_cached = {(f.get("ReadSchema", ""), f.get("PushedFilters", "[]")) for i, n, f in nodes
                    if n.startswith("Scan") and i in cached}
    for rs, pf in scans_cached:
        lines.append(f"- scan (into cache) `{rs[:150]}`, pushed filters `{pf[:150]}`")
    py = [n for _, n, _ in nodes if re.match(r"(ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|BatchEvalPython)", n)]
    lines.append(f"- Python stages: {', '.join(py) if py else 'none'}")
    lines.append("")
    return lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = ["# Executed plans of the headline queries", "",
           f"Generated by `python tools/plan_report.py` on `{sf}` (adaptive final plans after execution).", ""]
    for name in HEADLINE:
        df = PLANS[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        out += summarize(name, df._jdf.queryExecution().explainString(mode))
        segmented.release()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
