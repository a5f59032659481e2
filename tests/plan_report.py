"""Write PLANS.md: condensed final physical plans of every registered query.

Usage: python tests/plan_report.py [sf_dir]  (default /root/testdata/sf0.1)
Keeps the operators that matter for scale (exchanges, joins, windows,
aggregates, sorts, scans with pushed filters and read schema).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(
    r"Exchange|Join|Window \[|HashAggregate|SortAggregate|Sort \[|Scan parquet|FileScan|Subquery|Expand|Union|TakeOrdered|CollectLimit"
)


def condense(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", lambda m: "Location: " + os.path.basename(m.group(1)), line)
        line = re.sub(r"windowspecdefinition\([^)]*\)\)?", "w(...)", line)
        if "FileScan" in line:
            keep = re.findall(r"(FileScan parquet \[[^\]]*\]|PushedFilters: \[[^\]]*\]|PartitionFilters: \[[^\]]*\]|Location: \S+)", line)
            line = line[: line.index("FileScan")] + " ".join(keep)
        out.append(line.rstrip()[:220])
    return out


def main() -> None:
    import __spark_entry__ as E
    from propensia.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("plan-report")
    parts = [
        "# PLANS",
        "",
        f"Final physical plans (after adaptive execution) of the registered queries on `{sf_dir}`,",
        "condensed to exchanges, joins, windows, aggregates, sorts and scans. Regenerate with",
        "`python tests/plan_report.py`.",
        "",
    ]
    for name, fn in E.queries().items():
        if name == "model_scores":
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "```", *condense(plan), "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
