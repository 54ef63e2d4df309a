"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Counts per query: shuffle exchanges, broadcast exchanges, join strategies,
windows, parquet scans and scans with pushed filters, from ``explain("formatted")``
with AQE's initial plan.  Nested-loop or cartesian joins would show up here.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

SKIP = {"guarded_writes", "reject_counts_written"}  # their result is a few rows made on the driver after the writes


def summarise(plan: str) -> dict[str, int]:
    tree = plan.split("\n\n")[0]

    def n(pat: str) -> int:
        return len(re.findall(pat, tree))

    return {
        "shuffles": n(r"\bExchange \("),  # plain Exchange: Broadcast/Reused ones do not match \b
        "broadcasts": n(r"BroadcastExchange \("),
        "bhj": n(r"BroadcastHashJoin"),
        "smj": n(r"SortMergeJoin"),
        "shj": n(r"ShuffledHashJoin"),
        "nested_loop": n(r"BroadcastNestedLoopJoin"),
        "cartesian": n(r"CartesianProduct"),
        "windows": n(r"\bWindow \("),
        "scans": n(r"Scan parquet"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
    }


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    cols = ["shuffles", "broadcasts", "bhj", "smj", "shj", "nested_loop", "cartesian", "windows", "scans", "pushed"]
    print(f"# Plan shapes ({os.path.basename(root)}, initial AQE plans)\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for k, q in QUERIES.items():
        if k in SKIP:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, root).explain("formatted")
        s = summarise(buf.getvalue())
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
