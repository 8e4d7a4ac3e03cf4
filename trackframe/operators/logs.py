"""Console-log lines to three-value records, then to phases.

A record is built by a cyclic three-state reader: in state s only a line with pattern s counts,
every other line is skipped. Read line by line this is strictly sequential. It becomes a
set-based computation because of how the reader forgets its past:

* repeating a pattern changes nothing, so runs of equal patterns collapse to their first line;
* a pattern followed by its successor leaves one known state, whatever came before;
* between two such places every step goes to the predecessor pattern, and then exactly every
  second line is taken.

So a collapsed line is taken if it follows its predecessor pattern an even number of steps after
the last known state, or any other pattern an odd number of steps after it. The start of a log
counts as a known state (just after the third pattern).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackframe.functions.columns import text_part
from trackframe.operators.position import number_rows
from trackframe.session import attach, stage


def _follows(symbol: Column, previous: Column) -> Column:
    return symbol == (previous + 1) % 3


def taken_lines(
    lines: DataFrame,
    patterns: Sequence[str],
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    text: str = "value",
) -> DataFrame:
    """The lines the reader takes: ``sym`` (0, 1, 2) and ``number`` (third ``:`` part).

    The matching lines, narrow and few, are staged, so the log itself is scanned once. Rows are only sorted inside a bucket; one row per bucket carries the
    last pattern, the collapsed length and the last known state on to later buckets.
    """
    if len(patterns) != 3:
        raise ValueError("a record is made of three patterns")
    keys = [*group, *bucket]
    matches = F.array(*[F.when(F.col(text).contains(p), F.lit(i)) for i, p in enumerate(patterns)])
    number = text_part(F.col(text), ":", 2).try_cast("double")
    # A line with several patterns acts like several lines, in pattern order.
    hits = stage(lines.select(
        *keys, *[c for c in order if c not in keys], number.alias("number"), F.explode(F.array_compact(matches)).alias("sym")
    ), "log-lines")
    local = Window.partitionBy(*keys).orderBy(*order, "sym")
    so_far = local.rowsBetween(Window.unboundedPreceding, 0)
    changed = F.coalesce(F.col("sym") != F.col("_prev"), F.lit(False))
    hits = hits.withColumn("_prev", F.lag("sym").over(local)).withColumn("_step", F.count_if(changed).over(so_far))

    line = F.struct(*order, "sym")
    across = Window.partitionBy(*group).orderBy(*bucket)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        hits.groupBy(*keys)
        .agg(
            F.min_by("sym", line).alias("_first"),
            F.max_by("sym", line).alias("_last"),
            F.max("_step").alias("_steps"),
            F.max(F.when(_follows(F.col("sym"), F.col("_prev")), F.col("_step"))).alias("_known_step"),
        )
        .withColumn("_in", F.coalesce(F.lag("_last").over(across), F.lit(2)))
        .withColumn("_enter", (F.col("_first") != F.col("_in")).cast("long"))
        .withColumn("_base", F.coalesce(F.sum(F.col("_steps") + F.col("_enter")).over(earlier), F.lit(0)) + F.col("_enter"))
        .withColumn(
            "_known",
            F.coalesce(
                F.col("_base") + F.col("_known_step"),
                F.when(_follows(F.col("_first"), F.col("_in")), F.col("_base")),
            ),
        )
        .withColumn("_known_before", F.coalesce(F.max("_known").over(earlier), F.lit(0)))
        .select(*keys, "_in", "_base", "_known_before")
    )
    previous = F.coalesce("_prev", "_in")
    joined = (
        hits.join(carry, keys)
        .withColumn("_at", F.col("_base") + F.col("_step"))
        .withColumn("_sure", _follows(F.col("sym"), previous))
        .withColumn("_new", F.col("sym") != previous)
    )
    just_before = local.rowsBetween(Window.unboundedPreceding, -1)
    last_known = F.coalesce(F.max(F.when(F.col("_sure"), F.col("_at"))).over(just_before), F.col("_known_before"))
    odd = (F.col("_at") - 1 - last_known) % 2 == 1
    return joined.where("_new").select(*hits.columns[:-2], "_sure", odd.alias("_odd")).where(
        F.col("_sure") != F.col("_odd")
    ).drop("_sure", "_odd")


def log_records(
    lines: DataFrame,
    patterns: Sequence[str],
    names: Sequence[str],
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    text: str = "value",
) -> DataFrame:
    """One row per complete record: ``record`` (from 0 per log) and one column per pattern."""
    taken = taken_lines(lines, patterns, group, order, bucket, text)
    numbered = number_rows(taken, group, [*order, "sym"], bucket).withColumn("record", F.expr("(_rn - 1) div 3"))
    parts = [F.max(F.when(F.col("sym") == i, F.col("number"))).alias(n) for i, n in enumerate(names)]
    return numbered.groupBy(*group, "record").agg(F.count("*").alias("_parts"), *parts).where("_parts = 3").drop("_parts")


def phase_split(records: DataFrame, group: Sequence[str], order: str, column: str, marker: float) -> DataFrame:
    """Add ``phase``: 1 before a log's first record that shows the marker value, 2 from it on.

    The records are read twice: stage them first if they are costly to compute.
    """
    first = records.where(F.col(column) == F.lit(marker)).groupBy(*group).agg(F.min(order).alias("_switch"))
    phase = F.when(F.col(order) >= F.col("_switch"), 2).otherwise(1)
    return attach(records, first, group, "left").withColumn("phase", phase).drop("_switch")


def measure_sorted(records: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Distinct measurement rows in ascending order."""
    return records.select(*columns).distinct().orderBy(*by)
