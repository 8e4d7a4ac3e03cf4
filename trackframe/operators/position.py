"""Positions, cuts, neighbours and running totals inside groups of any size.

A plain window over a group puts the whole group into one task. Here a group is cut into
buckets by an expression that never decreases along the order key (a file split, a key range,
a hash prefix). Rows only ever meet inside one bucket; what crosses buckets is one row per
(group, bucket), which is aggregated before it is shuffled. Where a group has many of them, they are
cut into ranges of bounded size and the same is done with one row per (group, range), level by
level, so that no window grows with the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackframe.session import bounded, stage


# Rows of one level that windows run over at once; more are cut into ranges of half as many.
LEVEL_ROWS = 10_000


def _ranges(rows: DataFrame, group: Sequence[str], bucket: Sequence[str]) -> tuple[DataFrame, str | None]:
    """The rows, staged; if those of a group are many, with a column that numbers consecutive ranges of their order.

    Many groups of few rows are no reason to cut: a group keeps at least one row a level, so levels
    above more than ``LEVEL_ROWS`` groups would never end.
    """
    rows = stage(rows, "buckets")
    n = rows.count()
    if n <= LEVEL_ROWS or rows.groupBy(*group).count().agg(F.max("count")).first()[0] <= LEVEL_ROWS // 2:
        return rows, None
    name = "_range" if "_range" not in rows.columns else "_wider_range"
    cut = rows.repartitionByRange(-(-2 * n // LEVEL_ROWS), *group, *bucket)
    return stage(cut.withColumn(name, F.spark_partition_id()), "ranges"), name


def bucket_totals(
    df: DataFrame, group: Sequence[str], bucket: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Sum ``measures`` per bucket; adds ``<name>_before`` (earlier buckets) and ``<name>_all``."""
    return _totals(df.groupBy(*group, *bucket).agg(*[F.sum(m).alias(n) for n, m in measures.items()]), group, bucket, list(measures))


def _totals(sums: DataFrame, group: Sequence[str], bucket: Sequence[str], names: Sequence[str]) -> DataFrame:
    rows, part = _ranges(sums, group, bucket)
    near = Window.partitionBy(*group, *([part] if part else []))
    earlier = near.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = {n: F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in names}
    if part is None:
        return rows.select("*", *[b.alias(f"{n}_before") for n, b in before.items()], *[F.sum(n).over(near).alias(f"{n}_all") for n in names])
    keys = [*group, part]
    above = _totals(rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names]), group, [part], names).drop(*names)
    rows = rows.select("*", *[b.alias(f"_{n}_here") for n, b in before.items()]).join(above, keys)
    return rows.select(
        *sums.columns, *[(F.col(f"_{n}_here") + F.col(f"{n}_before")).alias(f"{n}_before") for n in names], *[f"{n}_all" for n in names]
    )


def _edges(edges: DataFrame, group: Sequence[str], bucket: Sequence[str], step: int) -> DataFrame:
    """``_edge`` of the bucket before (``step=-1``) or after each bucket."""
    rows, part = _ranges(edges, group, bucket)
    move = F.lag if step < 0 else F.lead
    near = Window.partitionBy(*group, *([part] if part else [])).orderBy(*bucket)
    moved = rows.select(*group, *bucket, *([part] if part else []), move("_edge").over(near).alias("_edge"))
    if part is None:
        return moved
    keys = [*group, part]
    pick = F.max_by if step < 0 else F.min_by
    ends = rows.groupBy(*keys).agg(pick("_edge", F.struct(*bucket)).alias("_edge"))
    above = _edges(ends, group, [part], step).withColumnRenamed("_edge", "_far")
    return moved.join(above, keys).select(*group, *bucket, F.coalesce("_edge", "_far").alias("_edge"))


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    position: str = "_rn",
    total: str = "_n",
) -> DataFrame:
    """Position of each row in its group (from 1) and the group's size.

    Group and bucket columns must not be NULL.
    """
    keys = [*group, *bucket]
    offsets = bucket_totals(df, group, bucket, {"_c": F.lit(1).cast("long")}).select(
        *keys, F.col("_c_before"), F.col("_c_all").alias(total)
    )
    local = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(position, F.row_number().over(local))
        .join(offsets, keys)
        .withColumn(position, F.col(position) + F.col("_c_before"))
        .drop("_c_before")
    )


def cut_points(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    ranks: Mapping[str, Column],
) -> DataFrame:
    """Order keys found at given ranks: one struct column per entry of ``ranks``.

    A rank is an expression over the group columns and ``_n``, the group's size. Ranks below 1
    give NULL. Only the bucket that holds a rank is sorted, so no wide row is shuffled. Order
    keys must be unique within a group. Join the result with :func:`trackframe.session.attach`.
    """
    keys = [*group, *bucket]
    sizes = bucket_totals(df, group, bucket, {"_c": F.lit(1).cast("long")}).withColumnRenamed("_c_all", "_n")
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), r.cast("long").alias("rank")) for n, r in ranks.items()]
    )
    edge = (
        sizes.withColumn("_want", F.explode(wanted))
        .where(
            (F.col("_want.rank") > F.col("_c_before"))
            & (F.col("_want.rank") <= F.col("_c_before") + F.col("_c"))
        )
        .select(*keys, F.col("_want.name").alias("_cut"), (F.col("_want.rank") - F.col("_c_before")).alias("_need"))
    )
    inside = Window.partitionBy(*keys, "_cut").orderBy(*order)
    found = (
        df.select(*keys, *[c for c in order if c not in keys])
        .join(bounded(edge), keys)
        .withColumn("_at", F.row_number().over(inside))
        .where(F.col("_at") == F.col("_need"))
    )
    cuts = found.groupBy(*group).agg(
        *[
            F.max(F.when(F.col("_cut") == name, F.struct(*order))).alias(name)
            for name in ranks
        ]
    )
    return cuts


def neighbour(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    value: Column,
    out: str,
    step: int = -1,
) -> DataFrame:
    """``value`` of the previous (``step=-1``) or next (``step=1``) row of the group, NULL at its end."""
    keys = [*group, *bucket]
    df = df.withColumn("_v", F.struct(value.alias("v")))
    pick = F.max_by if step < 0 else F.min_by
    edges = _edges(df.groupBy(*keys).agg(pick("_v", F.struct(*order)).alias("_edge")), group, bucket, step)
    move = F.lag if step < 0 else F.lead
    local = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_near", move("_v").over(local))
        .join(edges, keys)
        .withColumn(out, F.coalesce("_near", "_edge")["v"])
        .drop("_v", "_near", "_edge")
    )


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Running sum of each measure along the order key, current row included."""
    keys = [*group, *bucket]
    offsets = bucket_totals(df, group, bucket, {f"_{n}": m for n, m in measures.items()}).select(
        *keys, *[f"_{n}_before" for n in measures]
    )
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.select("*", *[F.sum(m).over(local).alias(n) for n, m in measures.items()])
        .join(offsets, keys)
        .withColumns({n: F.coalesce(F.col(n), F.lit(0)) + F.col(f"_{n}_before") for n in measures})
        .drop(*[f"_{n}_before" for n in measures])
    )
