"""Print a markdown table of plan shapes, one row per registered query, read
from ``explain("formatted")``: scans, shuffles, broadcast and sort-merge joins,
and whether any Expand, cartesian product or nested-loop join appears.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from basketlens.plans import catalog as entry  # noqa: E402
from basketlens.session import build_session  # noqa: E402



def shape(plan: str) -> dict[str, int]:
    ops = re.findall(r"^\(\d+\) (.+?)(?: \[.*)?$", plan, flags=re.M)
    ops = [o.strip() for o in ops]
    return {
        "scans": sum(o.startswith("Scan parquet") for o in ops),
        "shuffles": sum(o == "Exchange" for o in ops),
        "broadcast joins": sum(o.startswith("BroadcastHashJoin") for o in ops),
        "sort-merge joins": sum(o.startswith("SortMergeJoin") for o in ops),
        "expand": sum(o == "Expand" for o in ops),
        "cartesian / nested-loop": sum(o.startswith(("CartesianProduct",
                                                     "BroadcastNestedLoopJoin")) for o in ops),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    cols = None
    print(f"# Plan shapes at {os.path.basename(sf_dir)} (initial AQE plan, before runtime re-plan)\n")
    for key, fn in sorted(entry.queries().items()):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        s = shape(buf.getvalue())
        if cols is None:
            cols = list(s)
            print("| key | " + " | ".join(cols) + " |")
            print("|---" * (len(cols) + 1) + "|")
        print(f"| `{key}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
