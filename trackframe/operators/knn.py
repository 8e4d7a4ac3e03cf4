"""Nearest neighbour (k = 1, Euclidean): exact by cells and blocks, approximate by hashing.

Training rows are put into the cells of some of them, the pivots. A query first meets its own cell, which
bounds the distance of its neighbour; then it visits the cells that can hold something nearer: a cell is
skipped where the triangle inequality, or the plane between its pivot and the query's, shows that all of it lies
further away. Inside a cell both sides are cut into blocks of bounded size and each pair of blocks is one task
group. Along the principal axes of the pivots the leading components of all its pairs are compared first, with
the difference of the norms of what is left as a bound for the rest; only pairs that stay below the query's bound
are compared in full. A group returns one row per query, never the pairs. In many dimensions cells may prune
little: if the queries would meet more than half of all pairs, there is one cell and each query meets each block of
training rows once, still with its bound. Both plans give the same rows.

A test row whose vector is missing, of another length, or not finite in every component has no
neighbour: it comes back with NULLs. Such training rows are nobody's neighbour.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trackframe.session import bounded, stage

# Task functions travel to the workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 1024
BLOCK_ROWS = 4096
# Relative slack against rounding: bounds may only let too much through, never too little.
SLACK = 1e-9
# Share of the variance of the pivots that the leading axes hold.
LEADING = 0.6
# Share of pairs near their bound, or cells of their vectors, up to which pairs are compared one by one.
SPARSE, SPARSE_CELLS = 0.02, 1 << 21


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


@dataclass(frozen=True)
class Axes:
    """Principal axes: a rotation, which keeps distances, and how many leading axes are compared first."""

    middle: np.ndarray
    rotation: np.ndarray
    leading: int

    @classmethod
    def of(cls, rows: np.ndarray) -> "Axes":
        middle = rows.mean(0)
        _, spread, rotation = np.linalg.svd(rows - middle, full_matrices=True)
        share = np.cumsum(spread**2) / max(float((spread**2).sum()), 1e-300)
        leading = int(np.searchsorted(share, LEADING)) + 1
        return cls(middle, rotation.T, min(leading, rows.shape[1]))

    def parts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading components, and the norm of the others."""
        turned = (rows - self.middle) @ self.rotation
        return turned[:, : self.leading], np.sqrt((turned[:, self.leading :] ** 2).sum(1))


def _prepare(train: DataFrame, test: DataFrame, train_id: str, label: str, test_id: str, vector: str):
    """Equal training vectors count once, as the one with the lowest id."""
    points = train.select(
        F.col(vector).cast("array<double>").alias("x"), F.col(train_id).alias("tid"), F.col(label).alias("label")
    )
    # Compiled functions instead of one on every element: NaN counts as the largest number, and looking for a value
    # in an array that holds a null does not give "no".
    inf = float("inf")
    whole = lambda c: ~F.array_contains(c, F.lit(inf)) & (F.array_max(c) < inf) & (F.array_min(c) > -inf)
    points = points.where(F.coalesce(whole("x"), F.lit(False)))
    width = points.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        raise ValueError("there are no training rows")
    points = points.where(F.size("x") == width)
    # Equal by 128 bits of hash: an array as a key would be rebuilt element by element.
    same = [F.xxhash64("x").alias("_h1"), F.xxhash64(F.lit("second"), "x").alias("_h2")]
    points = points.groupBy(*same).agg(F.first("x").alias("x"), F.min("tid").alias("tid"), F.min_by("label", "tid").alias("label")).drop("_h1", "_h2")
    queries = test.select(F.col(test_id).alias("qid"), F.col(vector).cast("array<double>").alias("q"))
    usable = F.coalesce(whole("q") & (F.size("q") == width), F.lit(False))
    none = [F.lit(None).cast(points.schema[c].dataType).alias(n) for c, n in (("tid", "neighbour"), ("label", "label"))]
    lost = queries.where(~usable).select("qid", *none, F.lit(None).cast("double").alias("distance"))
    return points, queries.where(usable), lost


def knn1(
    train: DataFrame,
    test: DataFrame,
    train_id: str,
    label: str,
    test_id: str,
    vector: str,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
    compared: bool = False,
) -> DataFrame:
    """``qid, neighbour, label, distance`` for every test row; the lowest id wins a tie.

    With ``compared`` also how many training vectors (equal ones count once), besides the pivots, the query was
    compared with in full.
    """
    points, queries, lost = _prepare(train, test, train_id, label, test_id, vector)
    points, queries = stage(points, "points"), stage(queries, "queries")
    n, asked = points.count(), queries.count()
    pivots = max(1, min(n // 8 + 1 if pivots is None else pivots, MAX_PIVOTS))
    chosen = points.orderBy(F.md5(F.col("tid").cast("string").cast("binary")), "tid").limit(pivots).select("x").toArrow()
    centres = _matrix(chosen.column("x"))
    axes = Axes.of(centres)
    id_type, label_type = points.schema["tid"].dataType, points.schema["label"].dataType
    query_type = queries.schema["qid"].dataType.simpleString()

    def add_cell(vector: str):
        def to_cell(batches):
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                distance = np.sqrt(_squared(_matrix(pa.chunked_array([batch.column(vector)])), centres))
                cell = distance.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype("int32")), pa.array(distance[np.arange(len(cell)), cell])],
                    names=[*batch.schema.names, "cell", "_r"],
                )

        return to_cell

    celled = stage(points.mapInArrow(
        add_cell("x"), f"x array<double>, tid {id_type.simpleString()}, label {label_type.simpleString()}, cell int, _r double"
    ), "celled")
    radius, held = np.full(len(centres), -1.0), np.zeros(len(centres))
    for row in celled.groupBy("cell").agg(F.max("_r").alias("r"), F.count("*").alias("n")).collect():  # one row per pivot
        radius[row.cell], held[row.cell] = row.r, row.n
    between = np.sqrt(_squared(centres, centres))
    scale = 1.0 + float(np.abs(centres).max())

    # First every query in its own cell: what it finds there bounds the distance of its neighbour.
    at_home = queries.mapInArrow(add_cell("q"), f"qid {query_type}, q array<double>, cell int, _r double").drop("_r")
    first = stage(_best(_nearest(celled.drop("_r"), at_home, ["cell"], block_rows, axes)), "at_home")
    # Cells of pivots are never empty, so every query has found something.
    bounded_queries = stage(queries.join(first.select("qid", F.sqrt("d").alias("bound")), "qid"), "bounds")

    def visits(q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which further cells each query has to visit."""
        distance = np.sqrt(_squared(q, centres))
        home = distance.argmin(1)
        best = distance[np.arange(len(home)), home]
        # Squared distances lose half their digits near zero, hence the root of the slack.
        slack = np.sqrt(SLACK) * scale * (1.0 + best)
        ball = distance - radius[None, :]
        apart = between[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (distance**2 - (best**2)[:, None]) / (2.0 * apart)
        plane = np.where(apart > 0, plane, -np.inf)
        near = (np.maximum(ball, plane) <= (bound + slack)[:, None]) & (radius >= 0)[None, :]
        near[np.arange(len(home)), home] = False
        return near

    def visited(batches):
        for batch in batches:
            near = visits(_matrix(pa.chunked_array([batch.column("q")])), batch.column("bound").to_numpy()) if batch.num_rows else np.zeros((0, len(held)))
            yield pa.RecordBatch.from_arrays([pa.array([float((near @ held).sum())])], ["pairs"])

    def to_cells(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows, cells = np.nonzero(visits(_matrix(pa.chunked_array([batch.column("q")])), batch.column("bound").to_numpy()))
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cells.astype("int32"))], names=[*batch.schema.names, "cell"]
            )

    bounded_queries = bounded_queries.select("qid", "q", "bound")
    pairs = bounded_queries.mapInArrow(visited, "pairs double").agg(F.sum("pairs")).first()[0] or 0.0
    if pairs > 0.5 * asked * n:
        one = F.lit(0).alias("cell")
        rest = _nearest(points.select("*", one), bounded_queries.select("*", one), ["cell"], block_rows, axes)
    else:
        routed = bounded_queries.mapInArrow(to_cells, f"qid {query_type}, q array<double>, bound double, cell int")
        rest = _nearest(celled.drop("_r"), routed, ["cell"], block_rows, axes)
    found = _shown(_best(first.unionByName(rest)), *(["compared"] if compared else []))
    return found.unionByName(lost.withColumn("compared", F.lit(0).cast("long")) if compared else lost)


def _best(found: DataFrame) -> DataFrame:
    """One row per query of what :func:`_nearest` found: the nearest, the lowest id on a tie."""
    best = F.min(F.struct("d", "tid", "label")).alias("_best")
    return found.groupBy("qid").agg(best, F.sum("compared").alias("compared")).select("qid", "_best.*", "compared")


def _shown(found: DataFrame, *more: str) -> DataFrame:
    return found.select("qid", F.col("tid").alias("neighbour"), "label", F.sqrt("d").alias("distance"), *more)


def knn_lsh(
    train: DataFrame,
    test: DataFrame,
    train_id: str,
    label: str,
    test_id: str,
    vector: str,
    bucket_length: float,
    tables: int = 4,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    recall: float = 0.97,
) -> DataFrame:
    """Neighbour among the training rows in buckets of random projections that can hold it, found with chance ``recall``.

    A query first meets its own bucket in each table, which bounds the distance of its neighbour by ``d``. A random
    projection of a vector of length ``d`` is rarely longer than a known part of ``d``, so the query then probes, nearest
    edges first, the buckets it would have to cross to get that far; how far is set by the chance that the neighbour
    lies beyond in every table. A query whose own buckets hold no training row is answered exactly, so no row is lost.
    """
    points, queries, _ = _prepare(train, test, train_id, label, test_id, vector)
    # Staged, or the vectors might be made before the rows that can't be one are left out.
    points, queries = stage(points, "points"), stage(queries, "queries")
    width = points.select(F.size("x")).first()[0]
    random = np.random.default_rng(seed)
    directions = random.normal(size=(width, tables))
    directions /= np.sqrt((directions**2).sum(0))
    # How much of its length a vector shows in a random direction, at the chance that one table may miss it.
    sample = random.normal(size=(100_000, width))
    reach = float(np.quantile(np.abs(sample[:, 0]) / np.sqrt((sample**2).sum(1)), 1 - (1 - recall) ** (1 / tables)))

    def add_buckets(column: str, further: bool = False):
        """A row per table and bucket: the own bucket, or those within reach besides."""

        def run(batches):
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                place = _matrix(pa.chunked_array([batch.column(column)])) @ directions / bucket_length
                own = np.floor(place).astype(np.int64)
                low, high = own, own
                if further:
                    far = (batch.column("bound").to_numpy() * reach / bucket_length)[:, None]
                    low, high = (np.floor(np.clip(place + s * far, lowest, highest + 0.5)).astype(np.int64) for s in (-1, 1))
                    low, high = np.minimum(low, own), np.maximum(high, own)
                count = (high - low + 1).ravel()
                row, table = np.divmod(np.repeat(np.arange(count.size), count), tables)
                bucket = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row, table]
                kept = np.flatnonzero((bucket != own[row, table]) & (bucket >= lowest[table]) & (bucket <= highest[table]) if further else bucket == bucket)
                taken = batch.take(pa.array(row[kept]))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(table[kept].astype(np.int32)), pa.array(bucket[kept])], names=[*batch.schema.names, "table", "bucket"]
                )

        return run

    kinds = {f.name: f.dataType.simpleString() for f in [*points.schema.fields, *queries.schema.fields]}
    hashed = stage(points.mapInArrow(add_buckets("x"), f"x array<double>, tid {kinds['tid']}, label {kinds['label']}, table int, bucket long"), "hashed")
    lowest, highest = np.zeros(tables, np.int64), np.zeros(tables, np.int64)
    for row in hashed.groupBy("table").agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).collect():  # a row per table
        lowest[row["table"]], highest[row["table"]] = row.low, row.high
    own = queries.mapInArrow(add_buckets("q"), f"qid {kinds['qid']}, q array<double>, table int, bucket long")
    near = stage(_best(_nearest(hashed, own, ["table", "bucket"], block_rows)), "near")
    known = stage(queries.join(near.select("qid", F.sqrt("d").alias("bound")), "qid").select("qid", "q", "bound"), "bounds")
    probes = known.mapInArrow(add_buckets("q", True), f"qid {kinds['qid']}, q array<double>, bound double, table int, bucket long")
    axes = Axes.of(_matrix(points.limit(MAX_PIVOTS).select("x").toArrow().column("x")))
    near = stage(_shown(_best(near.unionByName(_nearest(hashed, probes, ["table", "bucket"], block_rows, axes)))), "near")
    missed = stage(test.join(near.select(F.col("qid").alias(test_id)), test_id, "left_anti"), "missed")
    if missed.isEmpty():
        return near
    return near.unionByName(knn1(train, missed, train_id, label, test_id, vector, block_rows=block_rows))


def _nearest(points: DataFrame, queries: DataFrame, cell: list[str], block_rows: int, axes: Axes | None = None) -> DataFrame:
    """``qid, d, tid, label, compared``: the best training row of each block a query meets, ``d`` squared.

    ``queries`` may bring a ``bound``: blocks without anything at that distance or nearer return no row for a query.
    """
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*cell).agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))

    # Sizes decide how often the other side is repeated; cells met by one side only drop out.
    sizes = blocks(points, "_pn").join(blocks(queries, "_qn"), cell)
    sizes = bounded(sizes)

    def cut(df: DataFrame, own: str, other: str, own_block: str, other_block: str, row_id: str) -> DataFrame:
        return df.join(sizes, cell).withColumn(own_block, F.pmod(F.xxhash64(row_id), F.col(own)).cast("int")).withColumn(
            other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        ).drop("_pn", "_qn")

    keys = [*cell, "_pb", "_qb"]
    if "bound" not in queries.columns:
        queries = queries.withColumn("bound", F.lit(float("inf")))
    left = cut(queries, "_qn", "_pn", "_qb", "_pb", "qid").groupBy(*keys)
    right = cut(points, "_pn", "_qn", "_pb", "_qb", "tid").groupBy(*keys)
    result = T.StructType([queries.schema["qid"], points.schema["tid"], points.schema["label"]]).add("d", "double").add("compared", "long")
    empty = to_arrow_schema(result).empty_table()

    def best_in_block(some_queries: pa.Table, some_points: pa.Table) -> pa.Table:
        # Hashing may leave a block without rows on one side; such a table has no columns.
        if some_queries.num_rows == 0 or some_points.num_rows == 0:
            return empty
        return _best_in_block(some_queries, some_points, axes)

    return left.cogroup(right).applyInArrow(best_in_block, result)


def _best_in_block(queries: pa.Table, points: pa.Table, axes: Axes | None, rows_at_once: int = 512) -> pa.Table:
    """Closest point per query: bounds and a matrix product narrow it down, exact differences decide."""
    ids = points.column("tid").to_numpy()
    q, x = _matrix(queries.column("q")), _matrix(points.column("x"))
    bound = queries.column("bound").to_numpy()
    largest = max(float((q * q).sum(1).max()), float((x * x).sum(1).max()))
    slack = SLACK * (1.0 + largest)
    point_parts = axes.parts(x) if axes else None
    kept, winners, distances, seen = [], [], [], []
    for start in range(0, len(q), rows_at_once):
        part, limit = q[start : start + rows_at_once], bound[start : start + rows_at_once, None] ** 2
        near = None
        if axes and np.isfinite(limit).all():
            leading, rest = axes.parts(part)
            least = _squared(leading, point_parts[0]) + (rest[:, None] - point_parts[1][None, :]) ** 2
            near = least <= limit + slack
        if near is None or near.sum() > max(SPARSE * near.size, SPARSE_CELLS / x.shape[1]):
            rough = _squared(part, x)
            close = rough <= np.minimum(rough.min(1)[:, None], limit) + slack
            full = np.full(len(part), len(x))
        else:
            close, full = near, near.sum(1)
        rows, cols = np.nonzero(close)
        exact = ((part[rows] - x[cols]) ** 2).sum(1)
        ranked = np.lexsort((ids[cols], exact, rows))
        first = ranked[np.r_[True, np.diff(rows[ranked]) > 0]] if len(rows) else ranked
        # A query that found nothing near still says what it was compared with.
        chosen, distance = np.zeros(len(part), np.int64), np.full(len(part), np.inf)
        chosen[rows[first]], distance[rows[first]] = cols[first], exact[first]
        kept.append(start + np.arange(len(part)))
        winners.append(chosen)
        distances.append(distance)
        seen.append(full)
    chosen = pa.array(np.concatenate(winners))
    return pa.table({
        "qid": queries.column("qid").take(pa.array(np.concatenate(kept))), "tid": points.column("tid").take(chosen),
        "label": points.column("label").take(chosen), "d": pa.array(np.concatenate(distances)), "compared": pa.array(np.concatenate(seen).astype(np.int64)),
    })
