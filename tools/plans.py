"""Write PLANS.md: the final physical plan (after AQE re-planning) of each
headline query, as an operator tree, with the columns and pushed filters of
each parquet scan.  Scans of persisted tables are shown as leaves.
Usage: python tools/plans.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinity.plans.catalog import registry  # noqa: E402
from affinity.session import build_session  # noqa: E402
from bench import HEADLINE  # noqa: E402

WIDTH = 140


def clean(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    if text.startswith("FileScan parquet"):
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", text)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", text)
        table = re.search(r"/([a-z]+)\.parquet", text)
        text = (f"Scan {table.group(1) if table else '?'} {schema.group(1) if schema else ''} "
                f"pushed={pushed.group(1) if pushed else '[]'}")
    return text if len(text) <= WIDTH else text[: WIDTH - 3] + "..."


def walk(node, depth: int, out: list[str], expand_cache: bool = False) -> None:
    cls = node.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        return walk(node.executedPlan(), depth, out, expand_cache)
    if cls.endswith("QueryStageExec") or cls == "ResultQueryStageExec":
        return walk(node.plan(), depth, out, expand_cache)
    if cls in ("WholeStageCodegenExec", "InputAdapter", "ColumnarToRowExec"):
        return walk(node.child(), depth, out, expand_cache)
    out.append("  " * depth + clean(node.simpleString(20)))
    if cls == "InMemoryTableScanExec" and expand_cache and depth == 0:
        return walk(node.relation().cachedPlan(), depth + 1, out, False)
    if cls in ("InMemoryTableScanExec", "ReusedExchangeExec"):
        return
    kids = node.children()
    for i in range(kids.size()):
        walk(kids.apply(i), depth + 1, out, expand_cache)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    reg = registry()
    print(f"# Physical plans ({os.path.basename(sf)}, local[8], final plans after AQE)\n")
    print("Generated by `python tools/plans.py`. One line per operator, children indented; "
          "`InMemoryTableScan` reads a persisted relation (index or unit table) built by an "
          "earlier query of the session.\n")
    for name in HEADLINE:
        df = reg[name](spark, sf)
        df.collect()  # execute the DataFrame's own plan, so the final plan is available
        lines: list[str] = []
        # a query that returns a persisted relation shows how it is built
        walk(df._jdf.queryExecution().executedPlan(), 0, lines, expand_cache=True)
        print(f"## {name}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
