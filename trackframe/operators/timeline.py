"""Wide label timelines to long form, extension, truth comparison and chart traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.functions.columns import blank_sentinel
from trackframe.operators.position import neighbour, number_rows
from trackframe.session import attach


def timeline_long(wide: DataFrame, time: str = "Time", keep: Sequence[str] = (), sentinel: str = "_") -> DataFrame:
    """``time, track, role, value`` from a time column and alternating prediction/truth columns.

    The track number is the digits of the column name, the role follows from the position.
    """
    names = [c for c in wide.columns if c != time and c not in keep]
    if len(names) % 2:
        raise ValueError("every prediction column needs a truth column next to it")
    layout = {
        c: (int("".join(ch for ch in c if ch.isdigit())), "truth" if i % 2 else "pred") for i, c in enumerate(names)
    }
    text = wide.select(F.col(time).cast("double").alias("time"), *keep, *[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    long = text.unpivot(["time", *keep], [f"`{c}`" for c in names], "_name", "_value")
    tracks = F.create_map(*[F.lit(x) for c, (track, _) in layout.items() for x in (c, track)])
    roles = F.create_map(*[F.lit(x) for c, (_, role) in layout.items() for x in (c, role)])
    return long.select(
        *keep, "time", tracks[F.col("_name")].alias("track"), roles[F.col("_name")].alias("role"),
        blank_sentinel(F.col("_value"), sentinel).alias("value"),
    )


def extend_one(long: DataFrame, series: Sequence[str], time: str = "time", value: str = "value") -> DataFrame:
    """At a series' first gap after a value, carry the value one step on; later gaps stay.

    Two aggregations find the first value and the first gap behind it, a third the value to
    carry. They combine on the map side, so a series of any length is never gathered. Their
    results, one row per series, are evaluated one after the other.
    """
    keys = list(series)
    starts = long.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(time).alias("_start"))
    gaps = (
        attach(long.where(F.col(value).isNull()), starts, keys).where(F.col(time) > F.col("_start"))
        .groupBy(*keys).agg(F.min(time).alias("_gap"))
    )
    carried = (
        attach(long.where(F.col(value).isNotNull()), gaps, keys).where(F.col(time) < F.col("_gap"))
        .groupBy(*keys).agg(F.max("_gap").alias("_gap"), F.max_by(value, time).alias("_carry"))
    )
    extended = F.when(F.col(time) == F.col("_gap"), F.col("_carry")).otherwise(F.col(value))
    return attach(long, carried, keys, "left").withColumn(value, extended).select(*long.columns)


def pair_roles(long: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    """One row per track and time with the ``pred`` and ``truth`` values side by side."""
    sides = [F.max(F.when(F.col("role") == r, F.col("value"))).alias(r) for r in ("pred", "truth")]
    return long.groupBy(*keys, time).agg(*sides)


def truth_vs_pred(long: DataFrame, keys: Sequence[str], bucket: Sequence[str], time: str = "time") -> DataFrame:
    """Agreement per track, by time points and by held time (a value lasts until the next time).

    ``bucket`` must be a column computed from the time, so that it survives the pairing.
    """
    pairs = pair_roles(long, [*keys, *bucket], time)
    held = neighbour(pairs, keys, [time], bucket, F.col(time), "_next", step=1).withColumn(
        "_held", F.coalesce(F.col("_next") - F.col(time), F.lit(0.0))
    )
    both = F.col("pred").isNotNull() & F.col("truth").isNotNull()
    agree = F.coalesce(F.col("pred") == F.col("truth"), F.lit(False))

    def held_where(condition):
        return F.sum(F.when(condition, F.col("_held")).otherwise(0.0))

    out = held.groupBy(*keys).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.count("*").alias("points"), F.count_if(both).alias("compared"), F.count_if(agree).alias("agreed"),
        held_where(F.col("truth").isNotNull()).alias("truth_time"),
        held_where(both).alias("compared_time"), held_where(agree).alias("agreed_time"),
    )
    return out.withColumns({
        "agree_share": F.try_divide("agreed", "compared"),
        "covered_share": F.try_divide("compared_time", "truth_time"),
        "agree_time_share": F.try_divide("agreed_time", "compared_time"),
    })


def trace_series(
    long: DataFrame, series: Sequence[str], bucket: Sequence[str], time: str = "time", chunk_rows: int = 10_000
) -> DataFrame:
    """Chart-ready arrays of times and values; a long series comes as several numbered chunks."""
    numbered = number_rows(long, series, [time], bucket).withColumn("chunk", F.expr(f"(_rn - 1) div {chunk_rows}"))
    points = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col("value").alias("v"))))
    return numbered.groupBy(*series, "chunk").agg(points.alias("_p")).select(
        *series, "chunk", F.col("_p.t").alias("times"), F.col("_p.v").alias("values"),
        F.col("_p")[0]["t"].alias("first_time"), F.element_at("_p", -1)["t"].alias("last_time"),
    )
