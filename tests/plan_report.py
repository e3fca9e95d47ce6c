"""Print the physical-plan shape of registered queries: shuffles, joins,
windows and what reaches each Parquet scan.

    python tests/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def report(spark, name: str, sf_dir: str) -> str:
    from __spark_entry__ import queries
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    lines = [f"{name}: exchanges={plan.count('Exchange ')} smj={plan.count('SortMergeJoin')} "
             f"bhj={plan.count('BroadcastHashJoin')} windows={plan.count('Window [')} "
             f"group_limits={plan.count('WindowGroupLimit')}"]
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        lines.append(f"  scan pushed={pushed.group(1) if pushed else '[]'} "
                     f"read={schema.group(1) if schema else '?'}")
    return "\n".join(lines)


if __name__ == "__main__":
    from tidemark.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    from __spark_entry__ import queries
    for n in sys.argv[2:] or [q for q in queries() if not q.startswith("stream_")]:
        print(report(spark, n, sf), flush=True)
