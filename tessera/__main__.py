"""Command line: ``python -m tessera <command>``.

  publish  --source-dir DIR --root ROOT [--as-of TS]   stage Silver + Gold, run the
                                                      16 checks, publish if they pass
  publish-csv --source NAME=PATH ... [--taxonomy CSV] --root ROOT
                                                      raw CSV -> Bronze -> Silver -> Gold, gated
  report   --source-dir DIR [--as-of TS]               the DQ report, nothing written
  query    NAME --source-dir DIR [--rows N]            show a named query
  explain  NAME --source-dir DIR                       print its formatted physical plan
  list                                                 list the named queries

The session comes from ``spark-submit`` / the environment when one exists;
otherwise a local session is started.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _spark() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import local_session

    return local_session(cores="*")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="cmd", required=True)
    pub = sub.add_parser("publish")
    pub.add_argument("--source-dir", required=True)
    pub.add_argument("--root", required=True)
    pub.add_argument("--as-of")
    pc = sub.add_parser("publish-csv")
    pc.add_argument("--source", action="append", required=True, metavar="NAME=PATH")
    pc.add_argument("--taxonomy", help="taxonomy CSV (default: the marketplace taxonomy shipped with tessera)")
    pc.add_argument("--root", required=True)
    rep = sub.add_parser("report")
    rep.add_argument("--source-dir", required=True)
    rep.add_argument("--as-of")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--source-dir", required=True)
    q.add_argument("--rows", type=int, default=20)
    ex = sub.add_parser("explain")
    ex.add_argument("name")
    ex.add_argument("--source-dir", required=True)
    sub.add_parser("list")
    args = p.parse_args(argv)

    from .plans.catalog import QUERIES

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0

    spark = _spark()
    from .operators import quality as Q
    from .sources import driver_tables as D

    if args.cmd == "publish-csv":
        from .plans.pipeline import csv_pipeline

        sources = dict(item.split("=", 1) for item in args.source)
        try:
            report = csv_pipeline(spark, sources, args.taxonomy, args.root)
        except Q.QualityGateError as exc:
            print(f"NOT PUBLISHED: {exc}", file=sys.stderr)
            return 1
        report.orderBy("check_no").show(20, truncate=False)
        return 0
    if args.cmd == "explain":
        QUERIES[args.name](spark, args.source_dir).explain("formatted")
        return 0
    if args.cmd == "query":
        QUERIES[args.name](spark, args.source_dir).show(args.rows, truncate=False)
        return 0
    as_of = F.lit(args.as_of).cast("timestamp_ntz") if args.as_of else F.current_timestamp()
    events, ts = D.feed_times(spark, args.source_dir)["events"]
    if args.cmd == "report":
        from .plans.pipeline import driver_star

        Q.dq_report(driver_star(spark, args.source_dir), events, ts, as_of).show(20, truncate=False)
        return 0
    from .plans.publish import publish_gold

    try:
        report = publish_gold(spark, D.silver_tables(spark, args.source_dir), args.root, events, ts, as_of)
    except Q.QualityGateError as exc:
        print(f"NOT PUBLISHED: {exc}", file=sys.stderr)
        return 1
    report.orderBy("check_no").show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
