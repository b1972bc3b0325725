"""Summarise the physical plan of every registered query into PLANS.md:
shuffles, join strategies, scans with their pushed filters and read
columns, subqueries, sorts and top-k operators.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    tree = text.split("\n\n\n")[0]
    ops = re.findall(r"[+:\- ]*([A-Z][A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", tree)
    scans = []
    for block in re.findall(r"\n\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\n|\Z)", text, re.S):
        cols = re.search(r"ReadSchema: struct<([^>]*)>", block)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", block)
        scans.append((len(cols.group(1).split(",")) if cols and cols.group(1) else 0,
                       pushed.group(1) if pushed and pushed.group(1) else ""))
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct) (\w+)", tree)
    return {
        "exchanges": len(re.findall(r"^[\s+:\-]*Exchange \(\d+\)", text, re.M)),
        "joins": sorted({f"{a} {b}" for a, b in joins} | set(re.findall(
            r"^[\s+:\-]*(BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin) \w+", text, re.M))),
        "subqueries": text.count("Subquery:"),
        "topk": "TakeOrderedAndProject" in tree,
        "windows": tree.count("Window ("),
        "scans": scans,
        "python": any(op in tree for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")),
    }


def main() -> None:
    from tablescope.session import build_session
    from tablescope import catalog

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{os.path.basename(sf)}` (initial adaptive plans;"
          " AQE may coalesce partitions or switch joins at run time). Exchanges count shuffles"
          " including those inside scalar subqueries; scans list (columns read, filters pushed"
          " into the Parquet reader). No query runs Python on rows.\n")
    print("| Query | Exchanges | Joins | Subqueries | Top-k | Windows | Scans (cols read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for key, fn in catalog.QUERIES.items():
        s = summarise(formatted(fn(spark, sf)))
        assert not s["python"], key
        scans = "; ".join(f"{n} cols" + (f", `{p[:60]}{'...' if len(p) > 60 else ''}`" if p else "")
                          for n, p in s["scans"])
        print(f"| `{key}` | {s['exchanges']} | {', '.join(s['joins']) or '-'} | {s['subqueries']} | "
              f"{'yes' if s['topk'] else '-'} | {s['windows'] or '-'} | {scans} |")


if __name__ == "__main__":
    main()
