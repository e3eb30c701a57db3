"""Physical-plan summary of every registered query (before AQE re-plans).

Usage: python tools/plan_report.py [sf_dir]
Prints a markdown table: shuffles by kind, joins by kind, windows, scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash_shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "round_robin": r"Exchange RoundRobinPartitioning",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow \[",
    "python_udf": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(text: str) -> dict[str, int]:
    return {k: len(re.findall(p, text)) for k, p in PATTERNS.items()}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from reviewlake.plans.registry import QUERIES
    from reviewlake.session import get_session
    spark = get_session(shuffle_partitions=8)
    keys = list(PATTERNS)
    print("| query | " + " | ".join(keys) + " |")
    print("| --- " * (len(keys) + 1) + "|")
    for name, fn in QUERIES.items():
        s = summarize(plan_text(fn(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")


if __name__ == "__main__":
    main()
