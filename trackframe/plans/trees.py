"""Decision trees of any depth over binned features, grown level by level.

Features are cut into at most 255 bins once; bin 0 is a missing value. A level is one Spark job: tasks walk
their rows down the trees grown so far and count what falls into ``(node, feature, bin)``, Spark adds the
counts up, and the best split of every node is chosen where its counts meet (:func:`best_splits`). Nodes that
hold few rows are not worth a job a level: their rows are brought together, some nodes to a task and never more
than ``LOCAL_ROWS`` rows, and their subtrees are grown to the end there, by the same code, so that the trees do
not depend on where they were grown. The driver sees one row per node, which is what a tree consists of.

A node is known by a hash of the path to it, not by a number with a bit per level, so depth has no bound. The
hash also draws the node's share of the features, and where none of those can split it, all are tried.

Two kinds of ensembles come out: forests on resampled rows that split by entropy or Gini impurity
(:func:`grow_forest`), and boosted trees for the gradients of the softmax, one tree a class and round
(:func:`boost`). A missing value goes to the side of a split that serves training best.

Ties go to the feature that comes first, then to the lowest bin, then to missing values on the left. Gradients are rounded to a grid, so sums do
not depend on the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.session import stage

MAX_BINS = 255
# Distinct values up to which every value gets a bin of its own.
FEW_VALUES = 200
LOCAL_ROWS = 1 << 15
# Cells of a level's counts that a task adds up in one array; beyond, each batch is summed by sorting.
DENSE_CELLS = 1 << 22
# Nodes of one group of trees, and of a whole ensemble; about 40 bytes each on the driver and in tasks.
MAX_GROUP_NODES, MAX_NODES = 1 << 20, 1 << 25
GRID = float(1 << 20)
# Rounds after which raw scores are written.
STAGE_EVERY = 10


# --- bins ------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, vector: str, width: int) -> list[np.ndarray]:
    """Upper bounds of the bins of every feature: between all values if they are few, else quantiles."""
    values = [F.nullif(F.nanvl(F.col(vector)[i], F.lit(None)), F.lit(float("nan"))) for i in range(width)]
    levels = [i / MAX_BINS for i in range(1, MAX_BINS)]
    found = rows.agg(
        *[F.approx_count_distinct(v).alias(f"n{i}") for i, v in enumerate(values)],
        *[F.percentile_approx(v, levels, 10 * MAX_BINS).alias(f"q{i}") for i, v in enumerate(values)],
    ).first()
    few = [i for i in range(width) if found[f"n{i}"] <= FEW_VALUES]
    sets = rows.agg(F.lit(0).alias("none"), *[F.sort_array(F.collect_set(values[i])).alias(f"s{i}") for i in few]).first()
    edges = []
    for i in range(width):
        own = np.array(sets[f"s{i}"] if i in few else found[f"q{i}"] or [], float)
        own = own[np.isfinite(own)]
        if i in few and len(own) <= MAX_BINS:
            edges.append((own[:-1] + own[1:]) / 2)
        else:
            edges.append(np.unique(own)[: MAX_BINS - 1])
    return edges


def to_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value of a matrix; 0 for NaN."""
    out = np.zeros(values.shape, np.uint8)
    for i, own in enumerate(edges):
        column = values[:, i]
        out[:, i] = np.where(np.isnan(column), 0, 1 + np.searchsorted(own, column, "left"))
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix; nulls are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _bytes(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """Rows of a binary column of equal lengths as a matrix."""
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, width), kind)
    start = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(start)).reshape(len(column), width)


def _binary(rows: np.ndarray) -> pa.Array:
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


@dataclass
class Binned:
    """Rows as bins, written once: ``rid``, ``label`` (from 0), ``part``, ``bins``."""

    rows: DataFrame
    edges: list[np.ndarray]
    classes: int

    @property
    def width(self) -> int:
        return len(self.edges)


def binned(rows: DataFrame, vector: str, label: str, classes: int, part: Column | None = None) -> Binned:
    """Cut the features of an ``array<double>`` column into bins. ``part`` numbers folds, or marks dev rows."""
    rows = rows.select(
        F.monotonically_increasing_id().alias("rid"), F.col(label).cast("int").alias("label"),
        (F.lit(0) if part is None else part).cast("int").alias("part"), F.col(vector).cast("array<double>").alias("x"),
    )
    width = rows.select(F.max(F.size("x"))).first()[0]
    if width is None:
        raise ValueError("there are no rows to learn from")
    edges = bin_edges(rows, "x", width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(matrix(batch.column("x"), width), edges)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binary(bins)], ["rid", "label", "part", "bins"])

    return Binned(stage(rows.mapInArrow(run, "rid long, label int, part int, bins binary"), "binned"), edges, classes)


# --- trees -----------------------------------------------------------------------------------


def spread(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers."""
    x = np.asarray(x).astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass
class Trees:
    """Some trees in flat arrays; the first ``trees`` nodes are their roots. A leaf has feature -1."""

    trees: int
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # a row per node: class shares, or one step of a score

    FIELDS = ("feature", "bin", "missing_left", "left", "right", "value")

    def walk(self, bins: np.ndarray, steps: int | None = None) -> np.ndarray:
        """The node of every row in every tree, after at most ``steps`` splits."""
        node = np.tile(np.arange(self.trees), len(bins))
        row = np.repeat(np.arange(len(bins)), self.trees)
        active, taken = np.flatnonzero(self.feature[node] >= 0), 0
        while len(active) and (steps is None or taken < steps):
            at = node[active]
            value = bins[row[active], self.feature[at]]
            left = np.where(value == 0, self.missing_left[at], value <= self.bin[at])
            at = np.where(left, self.left[at], self.right[at])
            node[active] = at
            active, taken = active[self.feature[at] >= 0], taken + 1
        return node.reshape(len(bins), self.trees)


def tree_depths(trees: Trees) -> np.ndarray:
    """How many splits lie above the deepest leaf of each tree."""
    depth, node, own = np.zeros(trees.trees, int), np.arange(trees.trees), np.arange(trees.trees)
    while len(node):
        split = trees.feature[node] >= 0
        node, own = node[split], own[split]
        node, own = np.concatenate([trees.left[node], trees.right[node]]), np.concatenate([own, own])
        depth[np.unique(own)] += 1
    return depth


def join_trees(parts: Sequence[Trees]) -> Trees:
    """Several groups of trees as one."""
    roots = sum(p.trees for p in parts)
    sizes = [len(p.feature) - p.trees for p in parts]
    order, first_root, first_node = [], 0, roots
    children = {"left": [], "right": []}
    for p, size in zip(parts, sizes):
        place = np.concatenate([first_root + np.arange(p.trees), first_node + np.arange(size)])
        order.append(place)
        for side in children:
            own = getattr(p, side)
            children[side].append(np.where(own >= 0, place[own], -1))
        first_root, first_node = first_root + p.trees, first_node + size
    back = np.argsort(np.concatenate(order))
    columns = {n: np.concatenate([getattr(p, n) for p in parts])[back] for n in ("feature", "bin", "missing_left", "value")}
    return Trees(roots, **columns, **{side: np.concatenate(own)[back] for side, own in children.items()})


@dataclass(frozen=True)
class Rule:
    """How nodes split: by ``entropy`` or ``gini`` of class counts, or by ``gradient`` sums (g, h, rows)."""

    measure: str
    depth: int
    share: float = 1.0
    seed: int = 42
    ridge: float = 1.0
    least_hessian: float = 1.0

    def worth(self, s: np.ndarray) -> np.ndarray:
        if self.measure == "gradient":
            return s[:, 0] ** 2 / (s[:, 1] + self.ridge * GRID) / GRID
        n = s.sum(1)
        if self.measure == "gini":
            return (s * s).sum(1) / np.maximum(n, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(s > 0, s * np.log(s), 0).sum(1) - np.where(n > 0, n * np.log(n), 0)

    def allowed(self, s: np.ndarray) -> np.ndarray:
        if self.measure == "gradient":
            return (s[:, 1] >= self.least_hessian * GRID) & (s[:, 2] > 0)
        return s.sum(1) > 0

    @property
    def least_gain(self) -> float:
        # A split that gains nothing may be needed for one that does; it always makes nodes smaller.
        return 1e-6 if self.measure == "gradient" else -1e-6

    def final(self, s: np.ndarray) -> np.ndarray:
        """Nodes that no split can improve."""
        return s[:, 2] < 2 if self.measure == "gradient" else s.max(1) == s.sum(1)

    def rows(self, s: np.ndarray) -> np.ndarray:
        return s[:, 2] if self.measure == "gradient" else s.sum(1)


def best_splits(node: np.ndarray, feature: np.ndarray, bin: np.ndarray, stats: np.ndarray, rule: Rule):
    """Best split of every node from its counts, which come sorted by node, feature and bin.

    Returns node, total, feature (-1 if none is allowed), bin, side of missing values, and the left part.
    """
    new_node = np.concatenate([[True], node[1:] != node[:-1]])
    new = new_node | np.concatenate([[True], feature[1:] != feature[:-1]])
    start = np.flatnonzero(new)
    segment = np.cumsum(new) - 1
    end = np.append(start[1:], len(node)) - 1
    running = np.cumsum(stats, 0)
    running -= (running[start] - stats[start])[segment]
    total = running[end]
    missing = np.where((bin[start] == 0)[:, None], stats[start], 0)
    known = running - missing[segment]
    whole, lost = total[segment], missing[segment]
    base, open = rule.worth(whole), ~rule.final(whole)
    gains = []
    for left in (known, known + lost):  # missing values right, then left
        ok = open & (bin > 0) & rule.allowed(left) & rule.allowed(whole - left)
        gain = rule.worth(left) + rule.worth(whole - left) - base
        gains.append(np.where(ok & (gain > rule.least_gain), gain, -np.inf))
    gain = np.maximum(*gains)
    begin = np.flatnonzero(new_node)
    most = np.maximum.reduceat(gain, begin)
    owner = np.cumsum(new_node) - 1
    # Equal gains differ in their last bits; the first of those counts as the best.
    near = gain >= (most - 1e-9 * np.maximum(np.abs(most), 1))[owner]
    at = np.flatnonzero(near & np.isfinite(gain))
    first = at[np.unique(owner[at], return_index=True)[1]]
    chosen = np.full(len(begin), -1)
    chosen[owner[first]] = first
    some = chosen >= 0
    pick = np.where(some, chosen, begin)
    side = gains[1][pick] >= gains[0][pick] - 1e-9 * np.maximum(np.abs(gains[0][pick]), 1)
    # Without missing values here, later ones follow the larger part.
    none = lost[pick].sum(1) == 0
    side = np.where(none, 2 * rule.rows(known[pick]) >= rule.rows(whole[pick]), side)
    left = known[pick] + np.where((side & ~none)[:, None], lost[pick], 0)
    return node[begin], total[segment[begin]], np.where(some, feature[pick], -1), bin[pick], side, left


def drawn(paths: np.ndarray, width: int, share: float) -> np.ndarray:
    """The features that each node may split on, drawn by the hash of its path."""
    count = max(1, int(share * width))
    if count >= width:
        return np.tile(np.arange(width), (len(paths), 1))
    keys = spread(paths[:, None] ^ spread(np.arange(1, width + 1))[None, :])
    return np.sort(np.argpartition(keys, count - 1, axis=1)[:, :count], axis=1)


class Counts:
    """Sums of what falls into (node, feature, bin), over the batches of a task."""

    def __init__(self, paths: np.ndarray, full: np.ndarray, width: int, size: int, rule: Rule):
        self.full, self.width, self.size = full, width, size
        self.features = drawn(paths, width, rule.share)
        self.cells = len(paths) * width * 256
        self.dense = np.zeros(self.cells * size) if self.cells * size <= DENSE_CELLS else None

    def add(self, rank: np.ndarray, bins: np.ndarray, column: np.ndarray | None, weight: np.ndarray):
        """Rows of nodes ``rank``: a ``weight`` for one ``column`` of the sums, or a weight for every column.

        Returns the sums of these rows if they are too many to be held.
        """
        codes, index = [], []
        for wanted, features in ((~self.full, self.features), (self.full, None)):
            rows = np.flatnonzero(wanted[rank])
            if not len(rows):
                continue
            own = features[rank[rows]] if features is not None else np.broadcast_to(np.arange(self.width), (len(rows), self.width))
            code = (rank[rows, None] * self.width + own) * 256 + bins[rows[:, None], own]
            codes.append(code.ravel())
            index.append(np.repeat(rows, own.shape[1]))
        if not codes:
            return None
        code, index = np.concatenate(codes), np.concatenate(index)
        if self.dense is not None:
            self._sum(self.dense, code, index, column, weight)
            return None
        distinct, code = np.unique(code, return_inverse=True)
        sums = np.zeros(len(distinct) * self.size)
        self._sum(sums, code, index, column, weight)
        return self._rows(distinct, sums.reshape(-1, self.size))

    def _sum(self, sums: np.ndarray, code: np.ndarray, index: np.ndarray, column: np.ndarray | None, weight: np.ndarray) -> None:
        if column is not None:
            sums += np.bincount(code * self.size + column[index], weight[index], len(sums))
        else:
            for j in range(self.size):
                sums += np.bincount(code * self.size + j, weight[index, j], len(sums))

    def _rows(self, code: np.ndarray, sums: np.ndarray):
        cell, bin = np.divmod(code, 256)
        return cell // self.width, cell % self.width, bin, sums

    def rows(self):
        """Node, feature, bin and sums of what was held, in order."""
        sums = self.dense.reshape(-1, self.size)
        used = np.flatnonzero(sums.any(1))
        return self._rows(used, sums[used])


@dataclass
class Growing:
    """Trees that are still growing: their nodes, and which of them wait to be split."""

    rule: Rule
    size: int
    trees: int
    paths: np.ndarray
    depth: np.ndarray = field(init=False)
    stats: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.paths)
        self.depth, self.stats = np.zeros(n, int), np.zeros((n, self.size))
        self.feature, self.bin, self.missing_left = np.full(n, -1), np.zeros(n, int), np.zeros(n, bool)
        self.left, self.right = np.full(n, -1), np.full(n, -1)

    def split(self, node: np.ndarray, feature: np.ndarray, bin: np.ndarray, side: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Split nodes; returns the children that may split again."""
        if not len(node):
            return node
        count = len(self.paths)
        both = np.stack([count + 2 * np.arange(len(node)), count + 2 * np.arange(len(node)) + 1])
        self.feature[node], self.bin[node], self.missing_left[node] = feature, bin, side
        self.left[node], self.right[node] = both
        parts = np.stack([left, self.stats[node] - left], 1).reshape(-1, self.size)
        paths = spread(2 * self.paths[node][:, None] + np.arange(1, 3, dtype=np.uint64)).ravel()
        self.paths = np.concatenate([self.paths, paths])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[node] + 1, 2)])
        self.stats = np.concatenate([self.stats, parts])
        more = 2 * len(node)
        self.feature = np.concatenate([self.feature, np.full(more, -1)])
        self.bin = np.concatenate([self.bin, np.zeros(more, int)])
        self.missing_left = np.concatenate([self.missing_left, np.zeros(more, bool)])
        self.left = np.concatenate([self.left, np.full(more, -1)])
        self.right = np.concatenate([self.right, np.full(more, -1)])
        return self.open(both.T.ravel())

    def open(self, nodes: np.ndarray) -> np.ndarray:
        return nodes[(self.depth[nodes] < self.rule.depth) & ~self.rule.final(self.stats[nodes])]

    def finished(self, rate: float = 1.0) -> Trees:
        s = self.stats
        if self.rule.measure == "gradient":
            value = -rate * s[:, :1] / (s[:, 1:2] + self.rule.ridge * GRID)
        else:
            value = s / np.maximum(s.sum(1, keepdims=True), 1)
        return Trees(
            self.trees, self.feature.astype(np.int32), self.bin.astype(np.int16), self.missing_left, self.left.astype(np.int32),
            self.right.astype(np.int32), value.astype(np.float32 if self.rule.measure != "gradient" else float),
        )


def grow_here(grown: Growing, rank: np.ndarray, bins: np.ndarray, column: np.ndarray | None, weight: np.ndarray) -> None:
    """Grow the trees whose roots hold these rows to the end, in memory."""
    node, waiting = rank.copy(), np.unique(rank)
    waiting = waiting[grown.depth[waiting] < grown.rule.depth]
    full = np.zeros(len(waiting), bool)
    while len(waiting):
        place = np.full(len(grown.paths), -1)
        place[waiting] = np.arange(len(waiting))
        own = place[node]
        rows = np.flatnonzero(own >= 0)
        counts = Counts(grown.paths[waiting], full, bins.shape[1], grown.size, grown.rule)
        found = counts.add(own[rows], bins[rows], None if column is None else column[rows], weight[rows])
        at, total, feature, bin, side, left = best_splits(*(counts.rows() if found is None else found), grown.rule)
        grown.stats[waiting[at]] = total
        splits = feature >= 0
        again = waiting[at[~splits & ~full[at]]] if grown.rule.share < 1 else at[:0]
        again = grown.open(again)
        parents = waiting[at[splits]]
        children = grown.split(parents, feature[splits], bin[splits], side[splits], left[splits])
        split = np.zeros(len(grown.paths), bool)
        split[parents] = True
        moved = rows[split[node[rows]]]
        at = node[moved]
        value = bins[moved, grown.feature[at]]
        goes = np.where(value == 0, grown.missing_left[at], value <= grown.bin[at])
        node[moved] = np.where(goes, grown.left[at], grown.right[at])
        waiting = np.concatenate([children, again]).astype(int)
        full = np.concatenate([np.zeros(len(children), bool), np.ones(len(again), bool)])


def grow(rows: DataFrame, total: int, width: int, size: int, paths: np.ndarray, rule: Rule, weigh) -> Growing:
    """Grow one group of trees, one per path, over all ``total`` rows.

    ``weigh(batch)`` gives what a batch adds: for every (row, tree) a row number, a tree number, the column of the
    sums (None: all columns) and the weight. It runs in tasks.
    """
    grown = Growing(rule, size, len(paths), paths)
    waiting, full = np.arange(len(paths)), np.zeros(len(paths), bool)
    names = [f"s{j}" for j in range(size)]
    sums = ", ".join(f"{n} double" for n in names)
    small = waiting[:0]
    if total <= LOCAL_ROWS or not rule.depth:
        small, waiting = waiting, waiting[:0]

    def placed(trees: Trees, place: np.ndarray, batch: pa.RecordBatch):
        """Rows of a batch whose nodes wait: rank of the node, bins, column and weight."""
        bins = _bytes(batch.column("bins"), np.uint8, width)
        row, tree, column, weight = weigh(batch)
        rank = place[trees.walk(bins)[row, tree]]
        keep = np.flatnonzero(rank >= 0)
        return rank[keep], bins[row[keep]], None if column is None else column[keep], weight[keep]

    while len(waiting):
        trees, rule_now = grown.finished(), rule
        place = np.full(len(grown.paths), -1)
        place[waiting] = np.arange(len(waiting))
        own_paths, own_full = grown.paths[waiting], full

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = Counts(own_paths, own_full, width, size, rule_now)

            def out(node, feature, bin, stats) -> pa.RecordBatch:
                arrays = [pa.array(x.astype(np.int32)) for x in (node, feature, bin)] + [pa.array(stats[:, j]) for j in range(size)]
                return pa.RecordBatch.from_arrays(arrays, ["node", "feature", "bin", *names])

            for batch in batches:
                if batch.num_rows and (found := counts.add(*placed(trees, place, batch))) is not None:
                    yield out(*found)
            if counts.dense is not None:
                yield out(*counts.rows())

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in [*batches, None]:
                if batch is not None:
                    now = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
                    node = now.column("node").to_numpy()
                    cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
                    now, held = now.slice(0, cut), now.slice(cut)
                else:
                    now = held
                if now is None or not now.num_rows:
                    continue
                columns = [now.column(c).to_numpy() for c in ("node", "feature", "bin")]
                node, total, feature, bin, side, left = best_splits(*columns, np.stack([now.column(n).to_numpy() for n in names], 1), rule_now)
                arrays = [pa.array(x.astype(np.int32)) for x in (node, feature, bin)] + [pa.array(side)]
                arrays += [pa.array(x[:, j]) for x in (total, left) for j in range(size)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "feature", "bin", "side", *[f"t{j}" for j in range(size)], *[f"l{j}" for j in range(size)]])

        counted = rows.mapInArrow(count, f"node int, feature int, bin int, {sums}")
        counted = counted.groupBy("node", "feature", "bin").agg(*[F.sum(n).alias(n) for n in names])
        counted = counted.repartition("node").sortWithinPartitions("node", "feature", "bin")
        both = ", ".join(f"{c}{j} double" for c in "tl" for j in range(size))
        found = counted.mapInArrow(choose, f"node int, feature int, bin int, side boolean, {both}").toArrow()
        column = {c: found.column(c).to_numpy() for c in found.schema.names}
        at = column["node"]
        order = np.argsort(at)
        at, feature = at[order], column["feature"][order]
        grown.stats[waiting[at]] = np.stack([column[f"t{j}"][order] for j in range(size)], 1)
        splits = feature >= 0
        again = grown.open(waiting[at[~splits & ~full[at]]]) if rule.share < 1 else waiting[:0]
        left = np.stack([column[f"l{j}"][order] for j in range(size)], 1)
        children = grown.split(waiting[at[splits]], feature[splits], column["bin"][order][splits], column["side"][order][splits], left[splits])
        few = rule.rows(grown.stats[children]) <= LOCAL_ROWS
        small = np.concatenate([small, children[few]])
        waiting = np.concatenate([children[~few], again])
        full = np.concatenate([np.zeros(int((~few).sum()), bool), np.ones(len(again), bool)])
        if len(grown.paths) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: grow fewer levels")
    if len(small):
        _finish(rows, grown, small, placed, names, total)
    return grown


def _finish(rows: DataFrame, grown: Growing, small: np.ndarray, placed, names: list[str], total: int) -> None:
    """Grow the subtrees below nodes of few rows, several nodes to a task, and graft them."""
    held = np.maximum(grown.rule.rows(grown.stats[small]), 1)
    if not grown.stats[small].any():  # roots that were never counted
        held = np.full(len(small), total)
    bucket = (np.cumsum(held) - held) // LOCAL_ROWS
    trees, size, rule = grown.finished(), grown.size, grown.rule
    place = np.full(len(grown.paths), -1)
    place[small] = np.arange(len(small))
    paths, depth, stats = grown.paths[small], grown.depth[small], grown.stats[small]
    one_column = "one_column"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rank, bins, column, weight = placed(trees, place, batch)
            weights = weight[:, None] if column is not None else weight
            column = np.full(len(rank), -1) if column is None else column
            arrays = [pa.array(bucket[rank].astype(np.int64)), pa.array(rank.astype(np.int32)), _binary(bins), pa.array(column.astype(np.int32)), _binary(weights.astype(float))]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "rank", "bins", "column", "weight"])

    fields = ("at", "feature", "bin", "left", "right", "depth")

    def finish(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        rank, column = batch.column("rank").to_numpy(), batch.column("column").to_numpy()
        width = len(batch.column("bins")[0].as_py())
        bins = _bytes(batch.column("bins"), np.uint8, width)
        one = column[0] >= 0
        weight = _bytes(batch.column("weight"), float, 1 if one else size)
        here, own = np.unique(rank, return_inverse=True)
        part = Growing(rule, size, len(here), paths[here])
        part.depth, part.stats = depth[here].copy(), stats[here].copy()
        grow_here(part, own, bins, column if one else None, weight[:, 0] if one else weight)
        n = len(part.paths)
        at = np.concatenate([here, np.full(n - len(here), -1)])
        arrays = [pa.array(np.full(n, batch.column("bucket")[0].as_py())), pa.array(np.arange(n))]
        arrays += [pa.array(np.asarray(x).astype(np.int64)) for x in (at, part.feature, part.bin, part.left, part.right, part.depth)]
        arrays += [pa.array(part.missing_left)] + [pa.array(part.stats[:, j]) for j in range(size)]
        return pa.table(dict(zip(["bucket", "id", *fields, "missing_left", *names], arrays)))

    schema = ", ".join(["bucket long", "id long", *[f"{c} long" for c in fields], "missing_left boolean", *[f"{n} double" for n in names]])
    sent = rows.mapInArrow(send, "bucket long, rank int, bins binary, column int, weight binary")
    found = sent.groupBy("bucket").applyInArrow(finish, schema).toArrow()
    if len(found) + len(grown.paths) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes: grow fewer levels")
    column = {c: found.column(c).to_numpy(zero_copy_only=False) for c in found.schema.names}
    order = np.lexsort((column["id"], column["bucket"]))
    column = {c: x[order] for c, x in column.items()}
    old = column["at"] >= 0
    where = np.empty(len(old), int)
    where[old] = small[column["at"][old]]
    where[~old] = len(grown.paths) + np.arange(int((~old).sum()))
    # Children are numbered inside their bucket; buckets follow each other.
    _, start, of = np.unique(column["bucket"], return_index=True, return_inverse=True)
    more = int((~old).sum())

    def put(name: str, values: np.ndarray, blank) -> None:
        now = getattr(grown, name)
        now = np.concatenate([now, np.full((more, *now.shape[1:]), blank, now.dtype)])
        now[where] = values
        setattr(grown, name, now)

    for side in ("left", "right"):
        child = column[side]
        put(side, np.where(child >= 0, where[np.where(child >= 0, start[of] + child, 0)], -1), -1)
    put("feature", column["feature"], -1)
    put("bin", column["bin"], 0)
    put("depth", column["depth"], 0)
    put("missing_left", column["missing_left"], False)
    put("stats", np.stack([column[n] for n in names], 1), 0)
    grown.paths = np.concatenate([grown.paths, np.zeros(more, np.uint64)])


# --- forests ---------------------------------------------------------------------------------


def poisson(keys: np.ndarray) -> np.ndarray:
    """Draws of the Poisson distribution of mean 1, by 64-bit keys."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    return np.searchsorted(shares, (spread(keys) >> np.uint64(11)).astype(float) / float(1 << 53), "right")


def grow_forest(
    data: Binned, trees: int, depth: int, share: float = 0.2, measure: str = "entropy", seed: int = 42,
    held_out: int | None = None, at_once: int | None = None,
) -> list[Trees]:
    """A forest, in groups of ``at_once`` trees. Every tree sees each row as often as a Poisson draw says.

    Rows of part ``held_out`` are not learnt from.
    """
    rows = data.rows if held_out is None else data.rows.where(F.col("part") != held_out)
    total = rows.count()
    at_once = at_once or max(16, min(64, 8 * LOCAL_ROWS // max(total, 1)))
    roots = spread(np.uint64(seed) * np.uint64(1_000_003) + np.arange(trees, dtype=np.uint64))
    rule, classes, groups, nodes = Rule(measure, depth, share, seed), data.classes, [], 0
    for first in range(0, trees, at_once):
        own = roots[first : first + at_once]

        def weigh(batch: pa.RecordBatch, own=own):
            rid = batch.column("rid").to_numpy().astype(np.uint64)
            times = poisson(spread(rid)[:, None] ^ own[None, :])
            row, tree = np.nonzero(times)
            return row, tree, batch.column("label").to_numpy()[row], times[row, tree].astype(float)

        groups.append(grow(rows, total, data.width, classes, own, rule, weigh).finished())
        nodes += len(groups[-1].feature)
        if nodes > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: grow fewer trees or levels")
    return groups


# --- boosting --------------------------------------------------------------------------------


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def add_steps(scores: np.ndarray, groups: Sequence[Trees], bins: np.ndarray) -> np.ndarray:
    """Raw scores after more rounds; a group holds one tree a class."""
    for trees in groups:
        scores = scores + trees.value[trees.walk(bins), 0].reshape(len(bins), -1, scores.shape[1]).sum(1)
    return scores


def boost(
    data: Binned, rounds: int, depth: int = 6, rate: float = 0.3, held_out: int | None = None, patience: int | None = None,
    checks: Sequence[int] = (), ridge: float = 1.0, least_hessian: float = 1.0,
) -> tuple[list[Trees], dict[int, float]]:
    """Rounds of boosting with softmax gradients, and the accuracy on ``held_out`` rows after some rounds.

    Raw scores are a column of the rows; it is written every ``STAGE_EVERY`` rounds and brought up to date by
    the rounds since. With ``patience`` boosting ends when so many rounds in a row did not better the accuracy
    (seen when scores are written and at ``checks``), and the rounds after the best are dropped.
    """
    classes, width = data.classes, data.width
    rule = Rule("gradient", depth, ridge=ridge, least_hessian=least_hessian)
    rows = data.rows.withColumn("scores", F.lit(np.zeros(classes).tobytes()))
    learnt = rows if held_out is None else rows.where(F.col("part") != held_out)
    total, nodes = learnt.count(), 0
    groups, fresh, seen, best = [], [], {}, (-1.0, 0)
    for done in range(1, rounds + 1):
        since = list(fresh)

        def weigh(batch: pa.RecordBatch):
            bins = _bytes(batch.column("bins"), np.uint8, width)
            p = softmax(add_steps(_bytes(batch.column("scores"), float, classes), since, bins))
            label = batch.column("label").to_numpy()
            g, h = p.copy(), np.maximum(2 * p * (1 - p), 1e-16)
            g[np.arange(len(label)), label] -= 1
            stats = np.stack([np.round(g * GRID), np.maximum(np.round(h * GRID), 1), np.ones_like(g)], 2).reshape(-1, 3)
            row, tree = np.divmod(np.arange(len(stats)), classes)
            return row, tree, None, stats

        learnt = rows if held_out is None else rows.where(F.col("part") != held_out)
        paths = spread(np.arange(done * classes, (done + 1) * classes, dtype=np.uint64))
        fresh.append(grow(learnt, total, width, 3, paths, rule, weigh).finished(rate))
        groups.append(fresh[-1])
        nodes += len(fresh[-1].feature)
        if nodes > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: boost fewer rounds or levels")
        if done % STAGE_EVERY == 0 or done in checks or done == rounds:
            rows, fresh = _scored(rows, fresh, width, classes), []
            if held_out is not None:
                right = rows.where(F.col("part") == held_out).agg(F.avg((F.col("best") == F.col("label")).cast("double"))).first()[0]
                seen[done] = right if right is not None else 0.0
                if seen[done] > best[0]:
                    best = (seen[done], done)
                elif patience is not None and done - best[1] >= patience:
                    break
    return (groups[: best[1]] if patience is not None and held_out is not None else groups), seen


def _scored(rows: DataFrame, groups: Sequence[Trees], width: int, classes: int) -> DataFrame:
    """The rows with their raw scores brought up to date, and the class of the highest, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _bytes(batch.column("bins"), np.uint8, width)
            scores = add_steps(_bytes(batch.column("scores"), float, classes), groups, bins)
            known = [batch.column(c) for c in ("rid", "label", "part", "bins")]
            yield pa.RecordBatch.from_arrays([*known, _binary(scores), pa.array(scores.argmax(1).astype(np.int32))], ["rid", "label", "part", "bins", "scores", "best"])

    return stage(rows.mapInArrow(run, "rid long, label int, part int, bins binary, scores binary, best int"), "scores")


# --- ensembles -------------------------------------------------------------------------------


@dataclass
class Ensemble:
    """Trees with the edges of their bins: raw scores of rows of features."""

    edges: list[np.ndarray]
    classes: int
    groups: list[Trees]
    boosted: bool
    depth: int | None = None

    def packed(self) -> list[Trees]:
        """The same trees in as few groups as bounded arrays allow."""
        out, now, nodes = [], [], 0
        for g in self.groups:
            if now and nodes + len(g.feature) > MAX_GROUP_NODES:
                out.append(join_trees(now))
                now, nodes = [], 0
            now.append(g)
            nodes += len(g.feature)
        return [*out, join_trees(now)] if now else out

    def scores(self, trees: Trees, values: np.ndarray) -> np.ndarray:
        """What a group of trees adds to the score of every class."""
        return self.add(trees, to_bins(values, self.edges))

    def add(self, trees: Trees, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.classes))
        step = max(1, (1 << 20) // max(trees.trees, 1))
        for start in range(0, len(bins), step):
            node = trees.walk(bins[start : start + step], self.depth)
            if self.boosted:
                out[start : start + step] = trees.value[node, 0].reshape(len(node), -1, self.classes).sum(1)
            else:
                out[start : start + step] = trees.value[node].sum(1)
        return out

    def truncated(self, depth: int) -> "Ensemble":
        """The forest as if its trees had been grown to ``depth`` only: splits do not depend on what follows."""
        return replace(self, depth=depth)


def held_out_accuracy(data: Binned, ensemble: Ensemble, part: int, depths: Sequence[int]) -> dict[int, float]:
    """Accuracy on the rows of one part for the ensemble cut off at several depths; one pass over the rows a group of trees."""
    rows = data.rows.where(F.col("part") == part)
    width, classes, packed = data.width, data.classes, ensemble.packed()
    cut = [replace(ensemble, depth=d, edges=[]) for d in depths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, label = _bytes(batch.column("bins"), np.uint8, width), batch.column("label").to_numpy()
            best = [sum(e.add(trees, bins) for trees in packed).argmax(1) for e in cut]
            right = [int((b == label).sum()) if len(label) else 0 for b in best]
            yield pa.RecordBatch.from_arrays([pa.array(list(depths)), pa.array(right), pa.array([len(label)] * len(right))], ["depth", "correct", "n"])

    found = rows.select("label", "bins").mapInArrow(run, "depth long, correct long, n long")
    return {r.depth: r.c / r.n if r.n else 0.0 for r in found.groupBy("depth").agg(F.sum("correct").alias("c"), F.sum("n").alias("n")).collect()}
