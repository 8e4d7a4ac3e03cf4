"""Repeatable sampling, erasing, appending and splitting by hash keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackframe.functions.columns import key_number, row_key
from trackframe.operators.position import cut_points
from trackframe.session import attach, stage

# Rows a hash bucket should hold: one bucket per class is sorted, the others are only counted.
BUCKET_ROWS = 50_000


def _keyed(df: DataFrame, ids: Sequence[str], seed: int | str, rows: int) -> DataFrame:
    """Add the hash key and its leading hex digits, as many as ``rows`` rows need, as bucket."""
    digits = 1
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return df.withColumn("_key", row_key(*ids, seed=seed)).withColumn("_bucket", F.substring("_key", 1, digits))


def _class_sizes(df: DataFrame, label: str) -> dict[str, int]:
    """Rows per class, at most one entry per requested label."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def _amounts(amounts: Mapping[str, int], label: str) -> Column:
    """Rows wanted per class, never more than the class has."""
    lookup = F.create_map(*[F.lit(x) for k, v in amounts.items() for x in (k, int(v))])
    return F.least(lookup[F.col(label)], F.col("_n"))


def shuffle_rows(df: DataFrame, ids: Sequence[str], seed: int | str = 42) -> DataFrame:
    """All rows in a repeatable random order (a range-partitioned sort on the hash key)."""
    return df.withColumn("_key", row_key(*ids, seed=seed)).orderBy("_key", *ids).drop("_key")


def sample_n_per_class(
    df: DataFrame, label: str, quota: Mapping[str, int | None], ids: Sequence[str], seed: int | str = 42
) -> DataFrame:
    """Random rows per requested class without replacement; classes not requested are dropped.

    An amount above the class size, or none, takes the whole class. For the other classes the
    n-th smallest hash key is found first; then rows are filtered by it, never ranked.
    """
    whole, part = _resolve(df, label, quota)
    wanted = df.where(F.col(label).isin([*whole, *part]))
    if not part:
        return wanted
    order = ["_key", *ids]
    sizes = max(n for n, _ in part.values())
    counted = _keyed(df.where(F.col(label).isin(list(part))), ids, seed, sizes)
    cuts = cut_points(counted, [label], order, ["_bucket"], {"_cut": _amounts({k: a for k, (_, a) in part.items()}, label)})
    chosen = F.col(label).isin(whole) | (F.struct(*order) <= F.col("_cut"))
    return attach(_keyed(wanted, ids, seed, sizes), cuts, [label], "left").where(chosen).select(*df.columns)


def _resolve(
    df: DataFrame, label: str, quota: Mapping[str, int | None]
) -> tuple[list[str], dict[str, tuple[int, int]]]:
    """Classes to take whole, and size and amount of the classes to take a part of (an action)."""
    sizes = _class_sizes(df.where(F.col(label).isin(list(quota))), label)
    whole = [k for k, v in quota.items() if k in sizes and (v is None or v >= sizes[k])]
    part = {k: (sizes[k], v) for k, v in quota.items() if k in sizes and k not in whole and v > 0}
    return whole, part


def head_n_per_class(
    df: DataFrame,
    label: str,
    quota: Mapping[str, int | None],
    order: Sequence[str],
    bucket: Sequence[str],
    steps: int = 1,
) -> DataFrame:
    """The first rows per requested class, the amount rounded down to a multiple of ``steps``."""
    whole, part = _resolve(df, label, {k: None if v is None else v // steps * steps for k, v in quota.items()})
    wanted = df.where(F.col(label).isin([*whole, *part]))
    if not part:
        return wanted
    counted = df.where(F.col(label).isin(list(part)))
    cuts = cut_points(counted, [label], order, bucket, {"_cut": _amounts({k: a for k, (_, a) in part.items()}, label)})
    chosen = F.col(label).isin(whole) | (F.struct(*order) <= F.col("_cut"))
    return attach(wanted, cuts, [label], "left").where(chosen).select(*df.columns)


def erase_n(
    df: DataFrame, label: str, quota: Mapping[str, int | None], ids: Sequence[str], seed: int | str = 42
) -> DataFrame:
    """Remove random rows per requested class; too large or no amount removes the class.

    Classes not requested are untouched, and a requested class without rows changes nothing.
    """
    whole, part = _resolve(df, label, quota)
    kept = df.where(~F.col(label).isin(whole)) if whole else df
    if not part:
        return kept
    order = ["_key", *ids]
    sizes = max(n for n, _ in part.values())
    counted = _keyed(df.where(F.col(label).isin(list(part))), ids, seed, sizes)
    cuts = cut_points(counted, [label], order, ["_bucket"], {"_cut": _amounts({k: a for k, (_, a) in part.items()}, label)})
    left = F.coalesce(F.struct(*order) > F.col("_cut"), F.lit(True))
    return attach(_keyed(kept, ids, seed, sizes), cuts, [label], "left").where(left).select(*df.columns)


def erase_windows(
    df: DataFrame,
    label: str,
    quota: Mapping[str, int | None],
    window: Sequence[str],
    steps: int,
    seed: int | str = 42,
) -> DataFrame:
    """Remove whole random windows per class: the amount counts rows and is rounded down.

    The list of windows is staged, since choosing among them takes several passes.
    """
    windows = stage(df.select(label, *[c for c in window if c != label]).distinct(), "windows")
    amounts = {k: None if v is None else v // steps for k, v in quota.items()}
    left = erase_n(windows, label, amounts, [c for c in window if c != label], seed)
    return df.join(left, list(dict.fromkeys([label, *window])), "left_semi").select(*df.columns)


def append_dataset(new: DataFrame, old: DataFrame, rank: str = "_src") -> DataFrame:
    """New rows before old rows: ``rank`` goes in front of the order key for keep-first."""
    return new.withColumn(rank, F.lit(0)).unionByName(old.withColumn(rank, F.lit(1)))


def random_split(
    df: DataFrame, ids: Sequence[str], train: float = 0.9, dev: float = 0.5, seed: int | str = 42
) -> DataFrame:
    """Add ``split`` by hash bucket: no shuffle, the same for any partitioning, sizes approximate."""
    bucket = F.pmod(key_number(row_key(*ids, seed=seed)), F.lit(1000))
    first = round(train * 1000)
    second = first + round((1000 - first) * dev)
    return df.withColumn("split", F.when(bucket < first, "train").when(bucket < second, "dev").otherwise("test"))


def random_split_exact(
    df: DataFrame, ids: Sequence[str], train: float = 0.9, dev: float = 0.5, seed: int | str = 42
) -> DataFrame:
    """Add ``split`` with exact sizes, rounded down: two cut keys over the whole table."""
    rows = df.count()
    train_rows = int(rows * train)
    ranks = {"_train": train_rows, "_dev": train_rows + int((rows - train_rows) * dev)}
    keyed = _keyed(df, ids, seed, rows)
    order = ["_key", *ids]
    cuts = _hash_cuts(keyed, order, ranks)
    key = F.struct(*order)
    first, second = (F.coalesce(key <= cuts.select(c).scalar(), F.lit(False)) for c in ranks)
    return keyed.withColumn("split", F.when(first, "train").when(second, "dev").otherwise("test")).select(*df.columns, "split")


def _hash_cuts(keyed: DataFrame, order: Sequence[str], ranks: Mapping[str, int]) -> DataFrame:
    """One row with the order keys at given ranks (from 1; NULL below 1) of the whole table.

    Buckets are counted once. Digit by digit a rank's bucket is found from sixteen sums, so neither
    all rows nor all buckets meet in a task; only the rows of the buckets found are sorted.
    """
    spark = keyed.sparkSession
    counts = stage(keyed.groupBy("_bucket").agg(F.count("*").alias("c")), "buckets")
    digits = counts.agg(F.max(F.length("_bucket"))).first()[0] or 0
    places = []
    for name, rank in ranks.items():
        prefix, need = "", rank
        for width in range(1, digits + 1 if rank > 0 else 1):
            level = counts.where(F.col("_bucket").startswith(prefix)).groupBy(F.substring("_bucket", 1, width).alias("p"))
            for p, c in sorted(map(tuple, level.agg(F.sum("c")).collect())):  # sixteen rows at most
                if need <= c:
                    prefix = p
                    break
                need -= c
        if rank > 0:
            places.append((name, prefix, need))
    wanted = spark.createDataFrame(places, "_cut string, _bucket string, _need long")
    inside = Window.partitionBy("_cut").orderBy(*order)
    found = keyed.select("_bucket", *order).join(F.broadcast(wanted), "_bucket").withColumn("_at", F.row_number().over(inside))
    found = found.where(F.col("_at") == F.col("_need")).select("_cut", F.struct(*order).alias("_key_at"))
    rows = {r["_cut"]: r["_key_at"] for r in found.collect()}  # one row per rank
    kind = T.StructType([T.StructField(n, found.schema["_key_at"].dataType) for n in ranks])
    return spark.createDataFrame([tuple(rows.get(n) for n in ranks)], kind)
