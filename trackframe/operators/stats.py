"""Class counts, profiles and classification reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from trackframe.session import bounded, stage

# The percentiles of a class profile.
PROFILE_PERCENTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999, 0.9999)

# Buckets of a histogram in the search for exact percentiles.
HISTOGRAM_BUCKETS = 2048


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows passing through a stage while another action runs; no job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count("*").alias("rows")), observation


def clean_report(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Rows per class before and after cleaning, and how many were removed."""
    counted = before.groupBy(label).agg(F.count("*").alias("rows_before"))
    left = after.groupBy(label).agg(F.count("*").alias("rows_after"))
    kept = F.coalesce("rows_after", F.lit(0))
    return counted.join(left, label, "left").select(
        label, "rows_before", kept.alias("rows_after"), (F.col("rows_before") - kept).alias("removed")
    )


def _long(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    values = [df[c].cast("double").alias(c) for c in columns]
    return df.select(label, *values).unpivot(label, list(columns), "feature", "value").where("value is not null and not isnan(value)")


def _summary() -> list[Column]:
    return [
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    ]


def profile_approx(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    percentiles: Sequence[float] = PROFILE_PERCENTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """One pass: count, mean, sd, range and sketched percentiles, per class, feature and percentile."""
    points = F.array(*[F.lit(p) for p in percentiles])
    sketch = F.percentile_approx("value", points, accuracy)
    stats = _long(df, label, columns).groupBy(label, "feature").agg(*_summary(), sketch.alias("q"))
    pairs = F.arrays_zip(points.alias("percentile"), F.col("q").alias("value"))
    return stats.withColumn("p", F.explode(pairs)).select(
        label, "feature", "n", "mean", "sd", "lowest", "highest", "p.percentile", "p.value"
    )


def sketches(df: DataFrame, label: str, columns: Sequence[str], k: int = 4096) -> DataFrame:
    """One row per class and feature to be stored beside a file: counts, sums and a mergeable quantile sketch.

    A larger ``k`` makes ranks more exact: they are off by some ``2.3 / k ** 0.9`` of the rows.
    """
    return _long(df, label, columns).groupBy(label, "feature").agg(
        F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("lowest"), F.max("value").alias("highest"),
        F.kll_sketch_agg_double("value", k).alias("sketch"),
    )


def merged_sketches(stored: DataFrame, label: str) -> DataFrame:
    """Rows of :func:`sketches` of several files as those of all their rows; no row of data is read again."""
    return stored.groupBy(label, "feature").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketched_percentiles(stored: DataFrame, label: str, percentiles: Sequence[float] = PROFILE_PERCENTILES) -> DataFrame:
    """Count, mean, range and percentiles, per class, feature and percentile, from stored sketches."""
    points = [F.struct(F.lit(p).alias("percentile"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value")) for p in percentiles]
    return stored.withColumn("_p", F.explode(F.array(*points))).select(
        label, "feature", "n", (F.col("total") / F.col("n")).alias("mean"), "lowest", "highest", "_p.*"
    )


def _octave(value: Column) -> Column:
    """A slot number that never falls as the value grows: sixteen slots for each doubling, on both sides of zero."""
    size = F.abs(value)
    power = F.least(F.floor(F.log2(size)), F.lit(1023))
    slot = (power + 1100) * 16 + F.floor((size / F.pow(F.lit(2.0), power) - 1) * 16)
    slot = F.when(size == float("inf"), F.lit(40_000)).otherwise(slot)
    return F.when(value == 0, F.lit(0)).when(value > 0, slot).otherwise(-slot).cast("long")


def profile(
    df: DataFrame, label: str, columns: Sequence[str], percentiles: Sequence[float] = PROFILE_PERCENTILES
) -> DataFrame:
    """Exact percentiles with linear interpolation, per class, feature and percentile.

    Distributed selection: all values are counted by slots of their size, which also gives mean and deviation;
    the slots that hold a wanted rank are cut into ``HISTOGRAM_BUCKETS`` parts and counted again, all
    percentiles of all features at once, until a part holds one value. Only values of these slots are read in
    the next round. No group is sorted, and no window holds more rows than there are slots.
    """
    keys = [label, "feature"]
    rows = stage(_long(df, label, columns), "values")
    rows = rows.withColumns({"span": F.lit(0.0), "slot": _octave(F.col("value"))})
    # Deviations from the slot's mean, so that the sum of squares loses no digits.
    more = [F.avg("value").alias("mean"), F.var_pop("value").alias("spread")]
    counted = stage(_counted(rows, keys, more), "slots")
    whole = counted.groupBy(*keys).agg(F.sum("c").alias("n"), (F.sum(F.col("mean") * F.col("c")) / F.sum("c")).alias("mean"), F.min("lo").alias("lowest"), F.max("hi").alias("highest"))
    apart = counted.select(*keys, "c", F.col("mean").alias("_m"), "spread").join(whole.select(*keys, "mean"), keys)
    squares = F.sum(F.col("c") * (F.col("spread") + (F.col("_m") - F.col("mean")) ** 2))
    deviations = apart.groupBy(*keys).agg(F.when(F.sum("c") > 1, F.sqrt(squares / (F.sum("c") - 1))).alias("sd"))
    stats = bounded(whole.join(deviations, keys))
    wanted = stats.withColumn("percentile", F.explode(F.array(*[F.lit(p) for p in percentiles])))
    wanted = wanted.withColumn("_pos", (F.col("n") - 1) * F.col("percentile")).withColumns({"_low": F.floor("_pos"), "_high": F.ceil("_pos")})
    ranks = wanted.select(*keys, F.explode(F.array("_low", "_high")).alias("rank")).distinct()

    spans = _narrowed(ranks.withColumns({"span": F.lit(0.0), "before": F.lit(0).cast("long")}), counted, keys)
    settled = spans.where("lo = hi")
    while not (open := spans.where("lo <> hi")).isEmpty():
        parts = bounded(open.select(*keys, "span", "slot", "lo", "hi").distinct())
        # Halved, so that the width of a span cannot overflow.
        share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        slot = F.least(F.floor(share * HISTOGRAM_BUCKETS), F.lit(HISTOGRAM_BUCKETS - 1))
        rows = rows.join(parts, [*keys, "span", "slot"]).select(*keys, "value", F.col("lo").alias("span"), slot.alias("slot"))
        rows = stage(rows, "values")
        spans = _narrowed(open.select(*keys, "rank", F.col("lo").alias("span"), "before"), _counted(rows, keys), keys)
        settled = settled.unionByName(spans.where("lo = hi"))
    found = settled.select(*keys, "rank", F.col("lo").alias("value"))
    below = found.select(*keys, F.col("rank").alias("_low"), F.col("value").alias("_lv"))
    above = found.select(*keys, F.col("rank").alias("_high"), F.col("value").alias("_hv"))
    # Nothing is added between equal values, so that infinite ones stay what they are.
    between = F.when(F.col("_hv") == F.col("_lv"), 0.0).otherwise((F.col("_hv") - F.col("_lv")) * (F.col("_pos") - F.col("_low")))
    return wanted.join(below, [*keys, "_low"]).join(above, [*keys, "_high"]).select(
        *keys, "n", "mean", "sd", "lowest", "highest", "percentile", (F.col("_lv") + between).alias("value")
    )


def _counted(rows: DataFrame, keys: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Rows, smallest and largest value of every slot of every span."""
    return rows.groupBy(*keys, "span", "slot").agg(F.count("*").alias("c"), F.min("value").alias("lo"), F.max("value").alias("hi"), *more)


def _narrowed(ranks: DataFrame, counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The slot that holds each wanted rank; ``before`` counts the values of the group in front of the span."""
    earlier = Window.partitionBy(*keys, "span").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = counted.select(*keys, "span", "slot", "c", "lo", "hi", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("start"))
    held = F.col("rank") - F.col("before")
    found = ranks.join(slots, [*keys, "span"]).where((held >= F.col("start")) & (held < F.col("start") + F.col("c")))
    return stage(found.select(*keys, "rank", "span", "slot", "lo", "hi", (F.col("before") + F.col("start")).alias("before")), "spans")


def outcome_counts(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Rows per (truth, pred): the only pass over the data that an evaluation needs."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def confusion(counts: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Rows are true labels, columns ``p_<label>`` predicted ones, both sorted, zeros filled in.

    Labels are the given ones and all that occur (an action that returns one row per label); a
    missing label is a row and a column of its own, ``NULL`` and ``p_null``. The cells add up to
    the number of rows.
    """
    both = counts.select(F.explode(F.array("truth", "pred")).alias("label")).distinct()
    seen = [r.label for r in both.collect()]
    names = sorted({*labels, *(x for x in seen if x is not None)})
    known = [*names, *[None] * (None in seen)]
    grid = counts.sparkSession.createDataFrame([(x,) for x in known], "truth string")
    cells = [
        F.sum(F.when(F.col("pred").eqNullSafe(F.lit(x)), F.col("n")).otherwise(0)).alias(f"p_{'null' if x is None else x}")
        for x in known
    ]
    sums = counts.groupBy(F.col("truth").alias("_truth")).agg(*cells)
    joined = grid.join(sums, F.col("truth").eqNullSafe(F.col("_truth")), "left").drop("_truth")
    return joined.na.fill(0)


def accuracy(counts: DataFrame) -> DataFrame:
    """Share of rows with truth = pred, and the same in percent rounded to two places."""
    right = F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0))
    share = right / F.sum("n")
    return counts.agg(
        F.sum("n").alias("rows"), share.alias("accuracy"), (F.round(share, 4) * 100).alias("accuracy_pct")
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    A ratio with a zero denominator counts as 0.
    """
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )
    sums = counts.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    precision, recall = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    per_class = sums.select(
        "label", precision.alias("precision"), recall.alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support", "tp",
    )
    scores = ("precision", "recall", "f1")
    right = ratio(F.sum("tp"), F.sum("support"))
    summary = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *[right.alias(s) for s in scores]),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores]),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
            ),
        ).alias("lines"),
        F.sum("support").alias("support"),
    )
    averages = summary.select(F.inline("lines"), "support").select("label", *scores, "support")
    return per_class.select("label", *scores, "support").unionByName(averages)
