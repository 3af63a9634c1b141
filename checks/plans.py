"""Tabulate the executed (final AQE) physical plan of every read-only query.

Usage: python -m checks.plans [sf_dir] [broadcast_threshold_bytes]

With a small threshold (e.g. 600 bytes at sf 0.01) only the region and nation
lookups can be proven small, which reproduces the plan shape of a 100 TB run
where orders, customer, supplier and part all exceed the threshold.

Counts the operators that matter at scale: shuffles (hash / single
partition), broadcasts, join strategies, aggregate strategies, windows,
codegen stages, and whether scans report pushed filters.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelwise.plans.registry import QUERIES  # noqa: E402
from parcelwise.session import build_session  # noqa: E402

SIDE_EFFECTS = ("roundtrip", "landing", "overwrite", "table_read", "stream", "json", "quality", "summary",
                "preference", "incremental", "inferred", "csv_foreign", "daily", "published", "stamp", "clean_counts")

COUNTS = [
    ("hash exchanges", r"Exchange hashpartitioning"),
    ("single-partition exchanges", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("broadcast joins", r"BroadcastHashJoin"),
    ("sort-merge joins", r"SortMergeJoin"),
    ("nested-loop / cartesian", r"BroadcastNestedLoopJoin|CartesianProduct"),
    ("hash aggregates", r"HashAggregate"),
    ("sort aggregates", r"SortAggregate"),
    ("windows", r"\bWindow\b"),
    ("top-k", r"TakeOrderedAndProject"),
    ("operators in codegen", r"\*\(\d+\)"),
]


def final_plan(df) -> str:
    df.collect()        # run this frame's own plan so explain() shows the final adaptive plan
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session()
    if len(argv) > 1:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", argv[1])
    rows = []
    for key, fn in sorted(QUERIES.items()):
        if any(s in key for s in SIDE_EFFECTS):
            continue
        text = final_plan(fn(spark, sf_dir))
        tree = text.split("\n\n")[0]
        if "== Final Plan ==" in tree:
            tree = tree.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        rows.append([key] + [str(len(re.findall(p, tree))) for _, p in COUNTS])
    spark.stop()
    print("| query | " + " | ".join(name for name, _ in COUNTS) + " |")
    print("|---" * (len(COUNTS) + 1) + "|")
    for r in rows:
        print("| " + " | ".join(r) + " |")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
