"""Column helpers: everything here is a native expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Floating-point NaN becomes NULL, so that comparisons agree with missing values."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    names = [c for c in (columns or df.columns) if c in floats]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Column names from ``first`` to ``last``, both included, in schema order."""
    names = df.columns
    start, end = names.index(first), names.index(last)
    if end < start:
        raise ValueError(f"{last} comes before {first}")
    return names[start : end + 1]


def row_key(*columns: str, seed: int | str = "") -> Column:
    """Repeatable pseudo-random text key of a row: md5 of the seed and the identifying columns."""
    parts = [F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def key_number(key: Column) -> Column:
    """The first 32 bits of an md5 text key as a number."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def composite_label(*columns: str) -> Column:
    """The class columns joined as text, e.g. 2, 2, 0, 0 -> ``2200``."""
    return F.concat(*[F.col(c).cast("string") for c in columns])


def one_hot(label: Column, labels: Sequence[str]) -> Column:
    """0/1 array over one fixed, sorted label list, the same for every split."""
    return F.array(*[F.coalesce((label == F.lit(x)).cast("double"), F.lit(0.0)) for x in sorted(labels)])


def argmax(scores: Column) -> Column:
    """Index from 0 of the largest score, the lowest index on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def label_at(index: Column, labels: Sequence[str]) -> Column:
    """The label of a class index in a sorted label list."""
    return F.get(F.array(*[F.lit(x) for x in sorted(labels)]), index)


def divide_by_row_max(values: Column) -> Column:
    """Each element over the row's largest non-NaN element, with IEEE results for a zero maximum."""
    top = F.array_max(F.filter(values, lambda x: ~F.isnan(x)))

    def divided(x: Column) -> Column:
        infinite = F.when((x == 0) | F.isnan(x), float("nan")).when(x > 0, float("inf")).otherwise(float("-inf"))
        return F.when(top != 0, x / top).when(top == 0, infinite)

    return F.transform(values, divided)


def reshape(values: Column, rows: int, cols: int) -> Column:
    """A flat array as ``rows`` arrays of ``cols`` elements."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(values, i * cols + 1, F.lit(cols)))


def text_part(text: Column, separator: str, index: int) -> Column:
    """Trimmed part ``index`` (from 0) of a separated text; NULL if there is no such part."""
    return F.trim(F.get(F.split(text, separator), F.lit(index)))



def blank_sentinel(value: Column, sentinel: str = "_") -> Column:
    return F.when(value != F.lit(sentinel), value)


def is_whole(number: Column) -> Column:
    return (number == F.floor(number)) & (F.abs(number) < F.lit(9.0e18))
