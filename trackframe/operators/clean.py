"""Labelling, filters and keep-first cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackframe.session import bounded, stage
from trackframe.spec import Vocabulary


BROADCAST_LABELS = 10_000


def sep_classes(df: DataFrame, vocabulary: Vocabulary, class_cols: Sequence[str]) -> DataFrame:
    """Add ``label`` and ``idx`` by the class columns; rows of no class are left out.

    A vocabulary of up to ``BROADCAST_LABELS`` labels is broadcast; a larger one joins normally.
    """
    lookup = vocabulary.frame(df.sparkSession, class_cols)
    return df.join(F.broadcast(lookup) if len(vocabulary.classes) <= BROADCAST_LABELS else lookup, list(class_cols))


def nonzero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose columns are not zero; a missing value is not zero."""
    return df.where(all_of([is_nonzero(c) for c in columns]))


def at_least(df: DataFrame, minimum: Mapping[str, float]) -> DataFrame:
    """Keep rows at or above each column's threshold; a missing value is dropped."""
    return df.where(all_of([is_at_least(c, t) for c, t in minimum.items()]))


def exclude_when(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows that match; a row for which the condition is unknown stays."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def is_nonzero(column: str) -> Column:
    return ~F.col(column).eqNullSafe(F.lit(0))


def is_at_least(column: str, threshold: float) -> Column:
    # NaN sorts above every number in Spark, so it has to be refused by name.
    value = F.col(column).cast("double")
    return F.coalesce((value >= F.lit(threshold)) & ~F.isnan(value), F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def dedupe_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per distinct ``subset``: the first by the order key. NULL equals NULL.

    Spark limits each key to one row per map task before the shuffle (WindowGroupLimit), so a
    key held by a third of all rows reaches its task as one row per map task.
    """
    by_key = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(by_key)).where(F.col("_copy") == 1).drop("_copy")


def clean_rows(
    df: DataFrame, subset: Sequence[str], order: Sequence[str], nonzero_columns: Sequence[str]
) -> DataFrame:
    """Dedupe first, then filter: a duplicate group whose first row fails a filter is lost whole."""
    return nonzero(dedupe_first(df, subset, order), nonzero_columns)


# Columns whose bounds are applied to the narrow rows before these are written again.
STAGED_COLUMNS = 3


def sigma_filter(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = (),
    k: float = 4.0,
    minimum: Mapping[str, float] | None = None,
) -> DataFrame:
    """Column after column, keep mean +- k sample deviations of what earlier columns left.

    Columns named in ``minimum`` use that threshold instead. Each bound needs a pass of its own, so
    the group and the filtered columns are staged, again after every ``STAGED_COLUMNS`` columns, and a
    pass reads only those. The rows themselves are filtered once, by all bounds together.
    """
    minimum = minimum or {}
    narrow, found = stage(df.select(*dict.fromkeys([*group, *columns])), "sigma"), []
    for number, column in enumerate(columns, 1):
        if column in minimum:
            narrow = narrow.where(is_at_least(column, minimum[column]))
        else:
            found.append((column, bounded(_bounds(narrow, [column], group, k))))
            narrow = _within(narrow, found[-1][1], [column], group)
        if number % STAGED_COLUMNS == 0 and number < len(columns):
            narrow = stage(narrow, "sigma")
    if group and found:
        # One row per group that had rows left at that column; a group missing later has lost all of them.
        together = reduce(lambda a, b: a.join(b, list(group)), [b for _, b in found])
        df = _within(df, bounded(together), [c for c, _ in found], group)
    else:
        for column, bounds in found:
            df = _within(df, bounds, [column], group)
    return at_least(df, {c: minimum[c] for c in columns if c in minimum})


def sigma_filter_single_pass(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = (),
    k: float = 4.0,
    minimum: Mapping[str, float] | None = None,
) -> DataFrame:
    """All bounds from the unfiltered rows: one aggregation for any number of columns."""
    minimum = minimum or {}
    by_sigma = [c for c in columns if c not in minimum]
    out = _within(df, bounded(_bounds(df, by_sigma, group, k)), by_sigma, group)
    return at_least(out, {c: minimum[c] for c in columns if c in minimum})


def _bounds(df: DataFrame, columns: Sequence[str], group: Sequence[str], k: float) -> DataFrame:
    measures = []
    for c in columns:
        value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        mean, spread = F.avg(value), F.stddev_samp(value) * F.lit(k)
        measures += [(mean - spread).alias(f"_lo_{c}"), (mean + spread).alias(f"_hi_{c}")]
    return df.groupBy(*group).agg(*measures)


def _within(df: DataFrame, bounds: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    names = df.columns
    if group:
        df = df.join(bounds, list(group))
    else:
        df = df.select("*", *[bounds.select(c).scalar().alias(c) for c in bounds.columns])
    inside = all_of([F.col(c).between(F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in columns])
    return df.where(inside).select(*names)
