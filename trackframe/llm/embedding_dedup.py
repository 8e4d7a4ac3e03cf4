"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are compared within a label and a number of dimensions. Equal vectors are first collapsed to
one with a multiplicity. Unit vectors are rotated to principal axes (one covariance matrix over all
vectors, summed by Spark), which keeps every product. Sorted along the first axis they are cut into
tiles. Two tiles meet only if their boxes on the leading axes come near enough, and a pair of tiles
is compared in blocks of axes: products over the leading axes are exact, the rest is bounded by the
product of the suffix norms, and a pair that cannot reach the threshold is dropped. Pairs within
``CLOSE`` of the threshold are decided by the original components in double precision.

No pair of vectors leaves a task. Of a pair of tiles come the number of links of each vector and a
spanning forest of the links, at most one edge per vector; components of the forest edges are then
found over all tiles. Tiles of one label that stay near are compared all with all, as an exact
comparison must, spread over as many tasks as there are pairs of tiles.

A vector links with nothing if its label, itself or a component is null, or if it is zero or not
finite. Vectors of different length never link. A row without an id links with nothing and is kept.
Rows that repeat an id count as further vectors. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackframe.llm.common import components
from trackframe.session import stage

TILE = 2048
# Axes that a tile's box keeps, axes of a block of products, and how close to the threshold is decided anew.
BOX, STEP, CLOSE = 8, 16, 1e-9


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes of the most frequent number of dimensions, leading ones first; the sum has ``dim ** 2`` rows."""
    common = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return {}
    dim = common[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["i", "v"])

    sums = vectors.where(F.col("dim") == dim).select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    found = sums.orderBy("i").toArrow().column("v").to_numpy().reshape(dim, dim)
    return {dim: np.linalg.eigh(found)[1][:, ::-1].copy()}


def cut_tiles(unique: DataFrame, axes: dict[int, np.ndarray], tile: int) -> DataFrame:
    """Tiles of neighbouring vectors: their ids, multiplicities, rotated unit and original components, and box."""
    label = unique.schema["label"]
    rotated = T.StructType([label, T.StructField("dim", T.IntegerType()), T.StructField("rep", T.LongType()),
                            T.StructField("copies", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("lead", T.DoubleType())])

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy()
            for dim in set(dims.tolist()):
                at = np.flatnonzero(dims == dim)
                x = matrix(batch.column("x").take(pa.array(at)), dim)
                axis = axes[dim][:, 0] if dim in axes else np.eye(dim)[0]
                out[at] = (x @ axis) / np.linalg.norm(x, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "lead"])

    rows = unique.select("label", "dim", "rep", "copies", "x").mapInArrow(lead, rotated)
    rows = rows.repartitionByRange("label", "dim", "lead").sortWithinPartitions("label", "dim", "lead", "rep")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tiles(held: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            out = []
            while held.num_rows:
                labels, dims = held.column("label").to_pylist(), held.column("dim").to_pylist()
                n = next((i for i in range(min(len(dims), tile)) if labels[i] != labels[0] or dims[i] != dims[0]), min(len(dims), tile))
                if n == held.num_rows and n < tile and not last:
                    break
                part, dim = held.slice(0, n).combine_chunks(), dims[0]
                x = matrix(part.column("x").combine_chunks(), dim)
                y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes.get(dim, np.eye(dim))
                box = y[:, :BOX]
                values = [labels[0], dim, part.column("rep").to_pylist(), part.column("copies").to_pylist(), y.astype("<f8").tobytes(),
                          x.astype("<f8").tobytes(), box.min(axis=0).tolist(), box.max(axis=0).tolist()]
                out.append(pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names))
                held = held.slice(n)
            return out, held

        held = None
        for batch in batches:
            kinds[0] = batch.schema.field("label").type
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= tile:
                done, held = tiles(held, False)
                yield from done
        if held is not None:
            yield from tiles(held, True)[0]

    names = ["label", "dim", "reps", "copies", "y", "x", "low", "high"]
    kinds = [None, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    schema = T.StructType([label] + [T.StructField(n, k) for n, k in zip(names[1:], (
        T.IntegerType(), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()), T.BinaryType(), T.BinaryType(),
        T.ArrayType(T.DoubleType()), T.ArrayType(T.DoubleType())))])
    return rows.mapInArrow(cut, schema).withColumn("tile", F.monotonically_increasing_id())


def linked(a: np.ndarray, b: np.ndarray, xa: np.ndarray, xb: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two tiles link: leading axes first, the rest only while the bound allows."""
    dim = a.shape[1]
    product = np.zeros((len(a), len(b)))
    left: tuple[np.ndarray, np.ndarray] | None = None
    for begin in range(0, dim, STEP):
        end = min(begin + STEP, dim)
        rest = [np.sqrt(np.maximum((m[:, end:] ** 2).sum(axis=1), 0)) for m in (a, b)]
        if left is None:
            product += a[:, begin:end] @ b[:, begin:end].T
            open_pairs = product + rest[0][:, None] * rest[1] >= threshold - CLOSE
            if end < dim and open_pairs.mean() < 0.02:
                left = np.nonzero(open_pairs)
                values = product[left]
        else:
            values += np.einsum("ij,ij->i", a[left[0], begin:end], b[left[1], begin:end])
            keep = values + rest[0][left[0]] * rest[1][left[1]] >= threshold - CLOSE
            left, values = (left[0][keep], left[1][keep]), values[keep]
    if left is None:
        out, near = product >= threshold + CLOSE, np.nonzero(np.abs(product - threshold) < CLOSE)
    else:
        out = np.zeros(product.shape, bool)
        out[left[0], left[1]] = values >= threshold + CLOSE
        close = np.abs(values - threshold) < CLOSE
        near = left[0][close], left[1][close]
    for i, j in zip(*near):
        out[i, j] = xa[i] @ xb[j] / (np.linalg.norm(xa[i]) * np.linalg.norm(xb[j])) >= threshold
    return out


def forest(n: int, links: np.ndarray, offset: int) -> np.ndarray:
    """Smallest position linked with every one of ``n`` rows, where columns begin at ``offset``."""
    u, v = np.nonzero(links)
    v = v + offset
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def compare_tiles(tiles: DataFrame, threshold: float) -> DataFrame:
    """``rep``, ``links`` and ``low``: links found in a pair of tiles, and an edge of its spanning forest."""
    meta = tiles.select("tile", "label", "dim", "low", "high")
    a = meta.toDF(*[f"a_{c}" for c in meta.columns])
    b = meta.toDF(*[f"b_{c}" for c in meta.columns])
    gaps = F.zip_with("a_low", "b_high", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    others = F.zip_with("b_low", "a_high", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    # Unit vectors with cosine c lie 2 - 2c apart in squared distance; so do, at least, their boxes.
    apart = F.aggregate(F.zip_with(gaps, others, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    pairs = a.join(b, (F.col("a_label") == F.col("b_label")) & (F.col("a_dim") == F.col("b_dim")) & (F.col("a_tile") <= F.col("b_tile")))
    pairs = pairs.where(apart <= 2 - 2 * threshold + CLOSE).select(F.col("a_tile").alias("a"), F.col("b_tile").alias("b"))
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    data = tiles.select("tile", "dim", "reps", "copies", "y", "x")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = {}
        for row in table.to_pylist():
            found[row["tile"]] = (
                np.array(row["reps"], np.int64), np.array(row["copies"], np.int64),
                np.frombuffer(row["y"], "<f8").reshape(-1, row["dim"]), np.frombuffer(row["x"], "<f8").reshape(-1, row["dim"]),
            )
        first, second = found[key[0].as_py()], found[key[1].as_py()]
        links = linked(first[2], second[2], first[3], second[3], threshold)
        n = len(first[0])
        if key[0].as_py() == key[1].as_py():
            np.fill_diagonal(links, False)
            links &= links.T
            reps, counts, root = first[0], links @ first[1], forest(n, links, 0)
        else:
            reps = np.concatenate([first[0], second[0]])
            counts = np.concatenate([links @ second[1], first[1] @ links])
            root = forest(len(reps), links, n)
        some = counts > 0
        return pa.table({"rep": reps[some], "links": counts[some].astype(np.int64), "low": reps[root][some]})

    return sides.join(data, "tile").groupBy("a", "b").applyInArrow(run, "rep long, links long, low long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v)) & F.exists("x", lambda v: v != 0)
    usable = F.coalesce(finite & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    # Scaled by the largest component, so that squares neither overflow nor vanish; equal vectors stay equal.
    largest = F.array_max(F.transform("x", lambda v: F.abs(v)))
    good = rows.where(usable).withColumn("x", F.when((largest > 1e100) | (largest < 1e-100), F.transform("x", lambda v: v / largest)).otherwise(F.col("x")))
    good = good.withColumn("dim", F.size("x"))
    classes = good.groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("dim").alias("dim"))
    classes = stage(classes, "vectors")
    tiles = stage(cut_tiles(classes, principal_axes(classes), tile), "tiles")
    found = stage(compare_tiles(tiles, threshold), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked_to = components(found.select("rep", "low").where("rep <> low"), "rep", "low")
    per_class = classes.join(counts, "rep", "left").join(linked_to, F.col("rep") == F.col("node"), "left").select(
        "label", "x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    members = good.select("vec_id", "label", "x").join(per_class, ["label", "x"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
