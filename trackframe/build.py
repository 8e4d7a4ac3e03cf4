"""Command line of the dataset builder: ``python -m trackframe.build -dir DATA -o OUT``."""

from __future__ import annotations

import argparse

from trackframe.plans.dataset import run
from trackframe.session import builder, owned_scratch
from trackframe.spec import DatasetSpec


def parse(arguments: list[str] | None = None) -> tuple[DatasetSpec, str]:
    parser = argparse.ArgumentParser(description="Build a labelled, cleaned dataset")
    parser.add_argument("-dir", "--data_dir", default="", help="folder of recorded CSV files")
    parser.add_argument("-d", "--dataset", default="", help="dataset of an earlier run, to add to or erase from")
    parser.add_argument("-a", "--add", action="store_true", help="take amounts of classes from the folder")
    parser.add_argument("-e", "--erase", action="store_true", help="erase amounts of classes")
    parser.add_argument("-t", "--types", nargs="+", default=[], help="class labels")
    parser.add_argument("-amt", "--amounts", nargs="+", default=[], help="rows per class label")
    parser.add_argument("-ts", "--time_series", type=int, default=0, help="rows per window; 0 for single rows")
    parser.add_argument("-o", "--out", default="current_dataset", help="folder to write")
    args = parser.parse_args(arguments)
    try:
        spec = DatasetSpec(
            data_dir=args.data_dir, dataset=args.dataset, add=args.add, erase=args.erase,
            types=tuple(args.types), amounts=tuple(args.amounts), time_series=args.time_series,
        )
    except ValueError as fault:
        parser.error(str(fault))
    return spec, args.out


def main(arguments: list[str] | None = None) -> None:
    spec, out = parse(arguments)
    spark = builder("trackframe-build").getOrCreate()
    with owned_scratch(spark):
        report = run(spark, spec, out).orderBy("label")
        report.show(max(report.count(), 1), truncate=False)


if __name__ == "__main__":
    main()
