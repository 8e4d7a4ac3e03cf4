"""Fixed-length positional windows: cut, clean, split, stack into tensors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackframe.operators.position import cut_points, number_rows
from trackframe.session import attach


def truncate_multiple(
    df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Sequence[str], steps: int
) -> DataFrame:
    """Drop each group's tail so that its size is a multiple of ``steps``; short groups vanish."""
    return fixed_windows(df, group, order, bucket, steps).select(*df.columns)


def fixed_windows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Sequence[str], steps: int
) -> DataFrame:
    """Consecutive ``steps`` rows of a group share ``win_id`` (from 0); ``win_pos`` counts inside."""
    _check_steps(steps)
    numbered = number_rows(df, group, order, bucket)
    whole = F.col("_n") - F.col("_n") % steps
    return (
        numbered.where(F.col("_rn") <= whole)
        .withColumn("win_id", F.expr(f"(_rn - 1) div {steps}"))
        .withColumn("win_pos", ((F.col("_rn") - 1) % steps).cast("int"))
        .drop("_rn", "_n")
    )


def clean_windows(
    df: DataFrame, group: Sequence[str], valid: Column, subset: Sequence[str], steps: int
) -> DataFrame:
    """Keep a window only if all its ``steps`` rows are valid and distinct on ``subset``.

    A window holds ``steps`` rows at most, so neither the partition nor the set can grow.
    """
    _check_steps(steps)
    window = Window.partitionBy(*group, "win_id")
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    # Adding zero turns -0.0 into 0.0: the set compares bits, not values.
    key = F.struct(*[(F.col(c) + F.lit(0.0)).alias(c) if c in floats else F.col(c) for c in subset])
    return (
        df.withColumn("_valid", F.count_if(valid).over(window))
        .withColumn("_distinct", F.size(F.collect_set(key).over(window)))
        .where((F.col("_valid") == steps) & (F.col("_distinct") == steps))
        .drop("_valid", "_distinct")
    )


def seq_split(
    df: DataFrame,
    label: str,
    order: Sequence[str],
    bucket: Sequence[str],
    steps: int = 1,
    train: float = 0.9,
    dev: float = 0.5,
) -> DataFrame:
    """Add ``split``: the first rows of each class train, the next dev, the last test.

    Both sizes are rounded down to a multiple of ``steps``. Only the two cut positions per class
    are looked up; rows are compared with them, never ranked.
    """
    _check_steps(steps)
    total = F.col("_n")
    train_rows = F.floor(F.floor(total * F.lit(train)) / steps) * steps
    dev_rows = F.floor(F.floor((total - train_rows) * F.lit(dev)) / steps) * steps
    cuts = cut_points(df, [label], order, bucket, {"_train": train_rows, "_dev": train_rows + dev_rows})
    key = F.struct(*order)
    return (
        attach(df, cuts, [label], "left")
        .withColumn(
            "split", F.when(key <= F.col("_train"), "train").when(key <= F.col("_dev"), "dev").otherwise("test")
        )
        .select(*df.columns, "split")
    )


def window_tensor(
    df: DataFrame, group: Sequence[str], features: Sequence[str], label: str | None = None
) -> DataFrame:
    """One row per window: ``tensor`` (steps x features) and the label of the window's first row."""
    row = F.array(*[F.col(c).cast("double") for c in features])
    stacked = F.array_sort(F.collect_list(F.struct("win_pos", row.alias("x"))))
    measures = [F.transform(stacked, lambda r: r["x"]).alias("tensor")]
    if label and label not in group:
        measures.append(F.min_by(label, "win_pos").alias(label))
    return df.groupBy(*group, "win_id").agg(*measures)


def _check_steps(steps: int) -> None:
    if steps < 1:
        raise ValueError("a window needs at least one row")
