"""Write PLANS.md: the physical shape of every registered query (sf0.01 plans).

Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODE = re.compile(r"^[\s:+\-*]*(\w+)")


def shape(plan: str) -> dict:
    nodes = [m.group(1) for line in plan.splitlines() if (m := NODE.match(line))]
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    pushed = sorted({f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f})
    return {
        "shuffles": ", ".join(f"{ex.count(k)}×{k}" for k in dict.fromkeys(ex)) or "none",
        "joins": ", ".join(sorted({n for n in nodes if n.endswith("Join")})) or "–",
        "windows": nodes.count("Window"),
        "scans": nodes.count("FileScan") + nodes.count("Scan"),
        "python": any("Python" in n or "Arrow" in n or "Pandas" in n for n in nodes),
        "pushed": "; ".join(pushed)[:80] or "–",
    }


def main() -> None:
    from pyspark.sql.readwriter import DataFrameWriter

    from __spark_entry__ import queries
    from churnlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    rows, written, write = [], [], DataFrameWriter.parquet

    def recorded(self, *args, **kw):  # the plans of the tables that a query writes on its way
        written.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kw)
    DataFrameWriter.parquet = recorded
    for name, query in sorted(queries().items()):
        written.clear()
        s = shape(query(spark, sf)._jdf.queryExecution().executedPlan().toString())
        eager = [shape(p) for p in written]
        moved = sum(int(n) for e in eager for n in re.findall(r"(\d+)×", e["shuffles"]))
        rows.append(f"| {name} | {len(eager)} / {moved} / {sum(e['scans'] for e in eager)} | {s['shuffles']} | {s['joins']} | "
                    f"{s['windows']} | {s['scans']} | {'yes' if s['python'] or any(e['python'] for e in eager) else 'no'} | {s['pushed']} |")
    DataFrameWriter.parquet = write
    head = [
        "# Physical plans of the registered queries",
        "",
        "Generated by `python tests/plan_report.py` from `executedPlan` at sf0.01 (AQE initial",
        "plans, before runtime re-optimisation). Inputs are the adapted `events` table, so",
        "scans of `events.parquet` show no pushed page filters (the adapter computes `page`);",
        "on the parquet hand-offs of the real jobs the filters reach the scan (see",
        "`tests/test_plan_shapes.py`). Scans of written intermediate tables (size-checked",
        "small sides, the (user, session, page) base, feature tables) count as scans.",
        "The second column has the tables written on the way: how many, and the shuffles and",
        "scans of the jobs that write them. Jobs of model fits are not listed.",
        "",
        "| query | written / shuffles / scans | shuffles | joins | windows | scans | python | pushed filters |",
        "|---|---|---|---|---|---|---|---|",
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(head + rows) + "\n")
    print(f"{len(rows)} plans written")


if __name__ == "__main__":
    main()
