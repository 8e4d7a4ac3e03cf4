"""Writers for datasets, column families and traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from trackframe.spec import FeatureSpec


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def write_by_label(df: DataFrame, path: str, label: str = "label", mode: str = "errorifexists") -> None:
    """Parquet by label, so that later reads prune classes; rebalancing splits large classes."""
    df.hint("rebalance", label).write.mode(mode).partitionBy(label).parquet(path)


def write_windows(
    df: DataFrame, path: str, columns: Sequence[str], window: Sequence[str], mode: str = "errorifexists"
) -> None:
    """CSV files that hold whole windows, their rows side by side in order."""
    write_csv(by_windows(df, window), path, columns, mode)


def by_windows(df: DataFrame, window: Sequence[str]) -> DataFrame:
    """Whole windows side by side in one partition, their rows in order."""
    return df.repartitionByRange(*window).sortWithinPartitions(*window, "win_pos")


def column_families(df: DataFrame, spec: FeatureSpec) -> dict[str, DataFrame]:
    """The number, matrix and extra feature families and the class columns."""
    return {
        "num": df.select(*spec.numbers),
        "matrix": df.select(*spec.matrix),
        "extra": df.select(*spec.extra),
        "y": df.select(*spec.classes),
    }


def write_families(df: DataFrame, path: str, spec: FeatureSpec, mode: str = "errorifexists") -> None:
    for name, family in column_families(df, spec).items():
        if family.columns:
            write_csv(family, f"{path}/{name}", family.columns, mode)


def write_traces(traces: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per trace chunk."""
    traces.write.mode(mode).json(path)
