"""Command line of the reports: ``python -m trackframe.report log|timeline PATH -o OUT``."""

from __future__ import annotations

import argparse

from trackframe.plans.reports import measurement_tables, timeline_reports
from trackframe.session import builder, owned_scratch
from trackframe.sources.sinks import write_csv, write_traces


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Tables from console logs, traces from label timelines")
    parser.add_argument("kind", choices=["log", "timeline"])
    parser.add_argument("path", help="a log file or folder, or a wide timeline CSV")
    parser.add_argument("-o", "--out", required=True, help="folder to write")
    parser.add_argument("--patterns", nargs="+", default=[], help="log: text of a record's lines, in their order")
    parser.add_argument("--names", nargs="+", default=[], help="log: a value name for each pattern")
    parser.add_argument("--by", help="log: value to sort by, which also holds the marker")
    parser.add_argument("--marker", type=float, help="log: the value that begins the second phase")
    args = parser.parse_args(arguments)
    if args.kind == "log" and (not args.patterns or len(args.patterns) != len(args.names) or args.by not in args.names or args.marker is None):
        parser.error("a log needs --patterns, as many --names, --by one of them, and --marker")
    spark = builder("trackframe-report").getOrCreate()
    with owned_scratch(spark):
        if args.kind == "log":
            for phase, table in measurement_tables(spark, args.path, args.patterns, args.names, args.by, args.marker).items():
                write_csv(table, f"{args.out}/phase_{phase}", table.columns)
        else:
            traces, agreement = timeline_reports(spark, args.path)
            write_traces(traces, f"{args.out}/traces")
            write_csv(agreement, f"{args.out}/agreement", agreement.columns)


if __name__ == "__main__":
    main()
