"""Helpers that several operators share: reading columns, Arrow buffers, staged tables, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.session import stage

# Rounds after which linked components must have settled; each round at least halves the paths.
MAX_ROUNDS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as ``doc_id``) and the whole text (null: empty); other columns can't clash then."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and where each row starts (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches of at most ``limit`` bytes of text, and the texts; a longer text is a part of its own."""
    for batch in batches:
        data, starts = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(int(np.searchsorted(starts, starts[begin] + limit, "right")) - 1, begin + 1)
            part = data[starts[begin] : starts[end]].tobytes()
            cuts = (starts[begin : end + 1] - starts[begin]).tolist()
            yield batch.slice(begin, end - begin), [part[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            begin = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finalizer of a multiplicative hash)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node reachable over undirected ``edges``.

    Alternating large-star and small-star rounds: every round points nodes at the smallest
    neighbour they know, which takes a number of rounds that grows with the logarithm of the
    longest path. Each round is written to the shared folder, so lineage stays short, and only two
    numbers reach the driver. Minima are combined before their shuffle; the join that brings a
    minimum back to the edges of a hot node has unique keys on the other side, so adaptive
    execution may split it. Nodes without an edge have no row.
    """
    now = stage(
        edges.select(
            F.greatest(left, right).cast("long").alias("a"), F.least(left, right).cast("long").alias("b")
        ).where("a > b").distinct(),
        "edges",
    )
    known = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")
        ).select("e.a", "e.b").where("a > b").distinct()
        now = stage(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def add_columns(batch: pa.RecordBatch, names: Sequence[str], arrays: Sequence[pa.Array]) -> pa.RecordBatch:
    """The batch with more columns behind its own."""
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])
