"""Write PLANS.md: the physical plan tree of each headline query.

    python scripts/explain_plans.py [sf_dir]

Only the operator tree of ``explain("formatted")`` is kept, plus the scan
lines (pushed filters, read schema), so the plan shape can be reviewed.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tutorlens.plans import queries as Q  # noqa: E402
from tutorlens.session import local_session  # noqa: E402

HEADLINE = [
    "master_whole_course",
    "early_engagement",
    "early_assessment",
    "stratified_split",
    "score_by_result",
    "box_score_by_result",
]


def plan_text(df) -> str:
    df.collect()  # the plan then is the one that ran, after adaptive re-planning
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    lines = text.splitlines()
    tree, details, in_tree = [], [], True
    scan = None
    for line in lines:
        if in_tree:
            if line.strip() == "+- == Initial Plan ==" and len(line) - len(line.lstrip()) <= 3:
                in_tree = False
                continue
            if line.strip() == "" and tree:
                in_tree = False
                continue
            tree.append(line)
            continue
        if line.startswith("(") and "Scan" in line:
            scan = [line]
        elif scan is not None:
            if line.startswith(("PushedFilters", "ReadSchema", "Location")):
                scan.append("  " + line.replace("file:" + ROOT, ""))
            if line.strip() == "":
                details.extend(scan)
                scan = None
    return "\n".join(tree + [""] + details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    out = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `scripts/explain_plans.py` at `{sf_dir}` on local Spark {spark.version} with AQE on,",
        "after running each query (the final plan; scans below it).",
        "",
    ]
    for name in HEADLINE:
        df = Q.QUERIES[name](spark, sf_dir)
        out += [f"## {name}", "", "```", summarize(plan_text(df)), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
