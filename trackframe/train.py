"""Command line of the trainer: ``python -m trackframe.train -d DATASET -m gb -o MODELS``."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.operators.clean import sep_classes
from trackframe.operators.sample import random_split
from trackframe.operators.stats import accuracy, class_report, confusion
from trackframe.plans import training
from trackframe.session import builder, owned_scratch, stage
from trackframe.sources.files import BUCKET, ORDER, scan_dataset
from trackframe.spec import TRACK, TRACK_VOCABULARY, FeatureSpec, Vocabulary

# The parameter grids searched per model kind.
GRIDS = {
    "gb": {"trees": [1000, 3500, 5000, 10000], "depth": [3, 6, 9, 12, 15], "rate": [0.3, 0.7, 0.9]},
    "rf": {"depth": [26, 29, 32, 35, 38]},
    "dense": {"epochs": [25, 50, 75, 100, 125, 150, 175, 200, 225, 250, 275, 300, 325, 350, 375, 400]},
}
# What a search holds fixed besides.
SEARCH_PARAMS: dict[str, dict[str, object]] = {}
# Rounds of boosting and epochs of a network without better accuracy on dev rows, after which training ends.
PATIENCE = {"gb": 50, "dense": 20}


def model_features(kind: str, spec: FeatureSpec = TRACK) -> list[str]:
    """The networks on single rows see every feature; the other kinds do without the extra family."""
    return list(spec.features if kind in ("dense", "merge") else spec.numbers + spec.matrix)


def split_dataset(
    spark: SparkSession, path: str, spec: FeatureSpec = TRACK, vocabulary: Vocabulary = TRACK_VOCABULARY
) -> dict[str, DataFrame]:
    """Train, dev and test rows of a dataset, with ``label`` and a numeric row id.

    The rows are staged, which fixes their ids.
    """
    rows = sep_classes(scan_dataset(spark, path, spec), vocabulary, spec.classes)
    rows = stage(rows.withColumn("row_id", F.monotonically_increasing_id()), "training")
    split = random_split(rows, ["row_id"])
    return {name: split.where(F.col("split") == name).drop("split") for name in ("train", "dev", "test")}


def fit(
    kind: str, train: DataFrame, spec: FeatureSpec = TRACK, vocabulary: Vocabulary = TRACK_VOCABULARY, dev: DataFrame | None = None, **params
):
    """A fitted model; with ``dev`` rows a network or boosting stops when they no longer profit."""
    features = model_features(kind, spec)
    if kind == "knn":
        return training.NearestNeighbourModel.fit(train, features, "label", "row_id")
    if kind == "merge":
        train, shares = training.merged_inputs(train, spec.matrix)
        dev = dev if dev is None else training.merged_inputs(dev, spec.matrix)[0]
        pipeline = training.label_pipeline("dense", features, vocabulary.labels, params=params, unscaled=shares)
    elif kind == "ts":
        names = [c for c in train.columns if c not in ("label", "split", "win_id")]
        scaler = training.window_scaler(train, features, names)
        pipeline = training.label_pipeline("dense", names, vocabulary.labels, params=params, scaler=scaler)
    else:
        pipeline = training.label_pipeline(kind, features, vocabulary.labels, params=params)
    if dev is None or kind == "rf":
        return pipeline.fit(train)
    return pipeline.fit_with_dev(train, dev, PATIENCE.get(kind, PATIENCE["dense"]))[0]


def split_windows(
    spark: SparkSession, path: str, steps: int, spec: FeatureSpec = TRACK, vocabulary: Vocabulary = TRACK_VOCABULARY
) -> dict[str, DataFrame]:
    """Train, dev and test windows of a dataset built with the same number of steps."""
    if steps < 1:
        raise ValueError("a windowed model needs the number of steps per window")
    rows = stage(sep_classes(scan_dataset(spark, path, spec), vocabulary, spec.classes), "training")
    windows, _ = training.window_rows(rows, model_features("ts", spec), steps, ORDER, BUCKET)
    windows = stage(windows, "windows")
    return {name: windows.where(F.col("split") == name) for name in ("train", "dev", "test")}


def score(kind: str, model, rows: DataFrame, spec: FeatureSpec = TRACK) -> DataFrame:
    if kind == "merge":
        rows, _ = training.merged_inputs(rows, spec.matrix)
    return model.transform(rows, "row_id") if kind == "knn" else model.transform(rows)


def throughput(kind: str, model, rows: DataFrame) -> float:
    """Rows scored per second, into a sink that discards them."""
    n = rows.count()
    start = time.perf_counter()
    score(kind, model, rows).write.format("noop").mode("overwrite").save()
    return n / (time.perf_counter() - start)


def show_all(df: DataFrame) -> None:
    """Print every row of a table that has one row per class, label or combination."""
    df.show(max(df.count(), 1), truncate=False)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Train and evaluate a classifier")
    parser.add_argument("-d", "--dataset", required=True)
    parser.add_argument("-m", "--model", default="dense", choices=training.KINDS)
    parser.add_argument("-lm", "--load_model", default="", help="bundle of an earlier run, evaluated only")
    parser.add_argument("-p", "--perf_check", action="store_true", help="measure rows scored per second")
    parser.add_argument("-gs", "--grid_search", action="store_true")
    parser.add_argument("-tss", "--ts_steps", type=int, default=0, help="rows per window, for the ts model")
    parser.add_argument("-o", "--out", default="Models", help="folder for model bundles")
    args = parser.parse_args(arguments)
    if args.model == "ts" and not args.load_model and args.ts_steps < 1:
        parser.error("the ts model needs -tss")
    return args


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = builder("trackframe-train").getOrCreate()
    with owned_scratch(spark):
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    # A loaded bundle says itself what kind it is, and so how its input must be prepared.
    kind, model = training.load(spark, args.load_model) if args.load_model else (args.model, None)
    if kind == "ts" and args.ts_steps < 1:
        raise SystemExit("a windowed model needs -tss")
    if kind == "ts":
        parts = split_windows(spark, args.dataset, args.ts_steps)
    else:
        parts = split_dataset(spark, args.dataset)
    if args.grid_search:
        if kind not in GRIDS:
            raise SystemExit(f"there is no parameter grid for {kind}")
        table, best = training.grid_search(
            parts["train"], model_features(kind), "label", TRACK_VOCABULARY.labels, kind, GRIDS[kind], ORDER, BUCKET, params=SEARCH_PARAMS.get(kind)
        )
        show_all(table.orderBy(F.desc_nulls_last("mean_score")))
        print("best:", best)
        return
    if model is None:
        model = fit(kind, parts["train"], dev=parts["dev"])
    counts = training.evaluate(score(kind, model, parts["test"]))
    show_all(confusion(counts, TRACK_VOCABULARY.labels))
    show_all(accuracy(counts))
    show_all(class_report(counts))
    if not args.load_model:
        print("saved:", training.save(model, kind, args.out, counts, parts["train"].count()))
    if args.perf_check:
        print("rows per second:", throughput(kind, model, parts["test"]))


if __name__ == "__main__":
    main()
