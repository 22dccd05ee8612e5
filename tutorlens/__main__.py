"""Run a flow as a Spark job.

    spark-submit -m tutorlens early   --input /data/oulad --output /out/early --cutoff 90
    python -m tutorlens whole         --input /data/oulad --format parquet --output /out/whole
    python -m tutorlens explore       --input /data/oulad --output /out/explore

``--input`` holds the course tables under their published file names
(studentInfo, courses, assessments, studentAssessment, studentRegistration,
studentVle, vle); every output is written as Parquet under ``--output``,
intermediate tables under ``--output``/tables.  ``--levels`` is a JSON file with
the categories of each encoded column.  ``--bad-rows`` names a folder for the bad
lines of CSV files, which else end the job; their counts are written and shown.  On a
cluster the session comes from the platform; run
locally, a local session is started.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from tutorlens.plans import flows
from tutorlens.session import configure
from tutorlens.sources import bad_row_report, load_tables, write_table


def _session(local: bool) -> SparkSession:
    if local:
        from tutorlens.session import local_session

        return local_session()
    return configure(SparkSession.builder.getOrCreate())


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tutorlens")
    ap.add_argument("flow", choices=["whole", "early", "explore"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--output", required=True)
    ap.add_argument("--cutoff", type=int, default=90)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--na-token", action="append", default=[], help="extra text read as missing, e.g. '?'")
    ap.add_argument("--levels", help="JSON file: {column: [levels]} of the encoded columns")
    ap.add_argument("--bad-rows", help="folder for the bad lines of CSV files")
    ap.add_argument("--report", action="append", choices=list(flows.REPORTS), help="explore: only this report (may be repeated)")
    ap.add_argument("--local", action="store_true", help="start a local session (tests, laptops)")
    args = ap.parse_args(argv)

    spark = _session(args.local)
    names = ["student_info", "courses", "assessments", "student_assessment", "student_registration", "student_vle"]
    names += ["vle"] if args.flow == "explore" else []
    levels = None
    if args.levels:
        with open(args.levels, encoding="utf-8") as f:
            levels = json.load(f)
    tables = load_tables(spark, args.input, fmt=args.format, names=names, bad_rows=args.bad_rows, extra_na_tokens=tuple(args.na_token))

    def out(name: str) -> str:
        return os.path.join(args.output, name)

    if args.bad_rows and args.format == "csv":
        bad = bad_row_report(spark, args.bad_rows, names)
        write_table(bad, out("bad_rows"))
        bad.show(100, truncate=False)
    if args.flow == "explore":
        for name, df in flows.explore(tables, out("tables/student_vle_small"), args.report).items():
            write_table(df, out(name))
        return

    if args.flow == "whole":
        res = flows.whole_course(tables, levels, out("tables/master"))
        drop = flows.DROP_WHOLE
    else:
        res = flows.early_prediction(tables, args.cutoff, levels, out("tables/master"))
        drop = flows.DROP_EARLY
        write_table(res["filter_effect"], out("filter_effect"))
    write_table(res["encoded_linear"], out("encoded_linear"))
    write_table(res["encoded_tree"], out("encoded_tree"))
    write_table(flows.training_splits(res["master"], drop, levels, seed=args.seed), out("training_frame"))
    write_table(res["report"], out("report"))
    res["report"].show(50, truncate=False)


if __name__ == "__main__":
    main()
