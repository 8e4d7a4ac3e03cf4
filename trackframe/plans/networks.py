"""Feed-forward networks trained by mini-batches on Spark: ReLU layers, dropout, softmax, Adam.

Rows are dealt once into pieces of about ``PIECE_ROWS`` rows and written. An epoch is one Spark job: each
piece is walked in shuffled mini-batches from the same weights with its own copy of Adam's moments, and what
comes back is averaged, weighted by rows: Spark adds up groups of pieces, about as many groups as a group has
pieces, and the driver adds up these. A table of one piece is trained exactly as on one machine.
Shuffles and dropout are drawn from the seed, the epoch and the piece, so a lost task repeats the same steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.functions.columns import argmax
from trackframe.plans.trees import matrix, softmax
from trackframe.session import stage

PIECE_ROWS = 1 << 15
# Batches are smaller than asked for where a piece would have fewer than so many of them.
LEAST_STEPS = 32
# Adam's decay rates and the guard against division by zero.
DECAY, DECAY_SQUARED, GUARD = 0.9, 0.999, 1e-7


@dataclass
class Weights:
    """All weights of a network in one flat array."""

    sizes: tuple[int, ...]
    flat: np.ndarray

    @classmethod
    def drawn(cls, sizes: Sequence[int], seed: int) -> "Weights":
        """Uniform draws bounded by the sizes of both layers; biases are 0."""
        r = np.random.default_rng(seed)
        parts = []
        for a, b in zip(sizes[:-1], sizes[1:]):
            bound = np.sqrt(6.0 / (a + b))
            parts += [r.uniform(-bound, bound, a * b), np.zeros(b)]
        return cls(tuple(sizes), np.concatenate(parts))

    def layers(self, flat: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Views of the matrix and bias of each layer."""
        flat, out, at = self.flat if flat is None else flat, [], 0
        for a, b in zip(self.sizes[:-1], self.sizes[1:]):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        layers = self.layers()
        for w, b in layers[:-1]:
            x = np.maximum(x @ w + b, 0)
        return x @ layers[-1][0] + layers[-1][1]


def gradient(weights: Weights, x: np.ndarray, label: np.ndarray, keep: Sequence[np.ndarray | None] = ()) -> tuple[float, np.ndarray]:
    """Mean cross entropy of a batch and its gradient; ``keep`` has what dropout multiplies a layer's output by."""
    layers, inputs = weights.layers(), [x]
    keep = [*keep, *[None] * len(layers)]
    for (w, b), mask in zip(layers[:-1], keep):
        x = np.maximum(x @ w + b, 0)
        inputs.append(x if mask is None else x * mask)
        x = inputs[-1]
    p = softmax(x @ layers[-1][0] + layers[-1][1])
    rows = np.arange(len(label))
    loss = float(-np.log(np.maximum(p[rows, label], 1e-300)).mean())
    flat = np.empty_like(weights.flat)
    slots = weights.layers(flat)
    back = p
    back[rows, label] -= 1
    back /= len(label)
    for i in reversed(range(len(layers))):
        slots[i][0][:], slots[i][1][:] = inputs[i].T @ back, back.sum(0)
        if i:
            back = back @ layers[i][0].T
            if keep[i - 1] is not None:
                back = back * keep[i - 1]
            back = back * (inputs[i] > 0)
    return loss, flat


def train_piece(state: np.ndarray, steps: int, sizes: Sequence[int], x: np.ndarray, label: np.ndarray, settings: "Settings", seeds: Sequence[Sequence[int]]) -> tuple[np.ndarray, int]:
    """Some epochs over the rows of one piece; ``state`` is weights and both moments, a seed per epoch."""
    state = state.copy()
    weights, (first, second) = Weights(tuple(sizes), state[0]), state[1:]
    batch = min(settings.batch, max(len(label) // LEAST_STEPS, 16))
    for seed in seeds:
        r = np.random.default_rng(seed)
        order = r.permutation(len(label))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            keep = [
                (r.random((len(rows), size)) >= settings.dropout) / (1 - settings.dropout) if i in settings.dropped and settings.dropout else None
                for i, size in enumerate(sizes[1:-1])
            ]
            _, g = gradient(weights, x[rows], label[rows], keep)
            steps += 1
            first *= DECAY
            first += (1 - DECAY) * g
            second *= DECAY_SQUARED
            second += (1 - DECAY_SQUARED) * g * g
            rate = settings.rate * np.sqrt(1 - DECAY_SQUARED**steps) / (1 - DECAY**steps)
            weights.flat -= rate * first / (np.sqrt(second) + GUARD)
    return state, steps


@dataclass(frozen=True)
class Settings:
    """``hidden`` layer sizes, ``epochs``, dropout behind the layers ``dropped`` (from 0), Adam's rate."""

    hidden: tuple[int, ...]
    epochs: int
    dropout: float = 0.1
    dropped: tuple[int, ...] = ()
    batch: int = 512
    rate: float = 0.001
    seed: int = 42


def dealt(rows: DataFrame, vector: str, label: str, part: str | None = None) -> tuple[DataFrame, int]:
    """Rows as ``piece``, ``label``, ``part``, ``x``, written piece by piece, and the number of pieces."""
    rows = rows.select(F.col(label).cast("int").alias("label"), (F.col(part) if part else F.lit(0)).cast("int").alias("part"), F.col(vector).alias("x"))
    if rows.where(F.exists("x", lambda v: v.isNull() | F.isnan(v))).limit(1).count():
        raise ValueError("a network can't take null or NaN as a feature")
    pieces = max(1, -(-rows.count() // PIECE_ROWS))
    key = F.pmod(F.xxhash64("x", "label", F.monotonically_increasing_id()), pieces)
    return stage(rows.withColumn("piece", key.cast("int")).repartition(pieces, "piece").sortWithinPartitions("piece"), "pieces"), pieces


def fit_network(
    rows: DataFrame, pieces: int, sizes: Sequence[int], settings: Settings, held_out: int | None = None,
    patience: int | None = None, step: int = 5, checks: Sequence[int] = (),
) -> tuple[Weights, dict[int, float]]:
    """Train on :func:`dealt` rows; also the accuracy on ``held_out`` rows after every ``step`` epochs and at ``checks``.

    With ``patience`` training ends when so many epochs did not better that accuracy, and the best weights are kept.
    """
    weights = Weights.drawn(sizes, settings.seed)
    state, steps, seen = np.stack([weights.flat, np.zeros_like(weights.flat), np.zeros_like(weights.flat)]), 0, {}
    best, epoch = (-1.0, 0, weights.flat), 0
    learnt = rows if held_out is None else rows.where(F.col("part") != held_out)
    marks = sorted({*range(step, settings.epochs, step), *(c for c in checks if c < settings.epochs), settings.epochs} - {0})
    for mark in marks:
        while epoch < mark:
            # Pieces are averaged after every epoch; a single one needs no averaging and goes on to the mark.
            now = mark - epoch if pieces == 1 else 1
            state, steps = _epochs(learnt, pieces, state, steps, sizes, settings, range(epoch, epoch + now))
            epoch += now
        if held_out is not None:
            seen[mark] = accuracy_of(rows.where(F.col("part") == held_out), Weights(tuple(sizes), state[0]))
            if seen[mark] > best[0]:
                best = (seen[mark], mark, state[0])
            elif patience is not None and mark - best[1] >= patience:
                break
    return Weights(tuple(sizes), best[2] if patience is not None and held_out is not None else state[0]), seen


def _epochs(
    rows: DataFrame, pieces: int, state: np.ndarray, steps: int, sizes: Sequence[int], settings: Settings, epochs: range
) -> tuple[np.ndarray, int]:
    width, groups = sizes[0], math.isqrt(pieces - 1) + 1

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        # A task may read several pieces, which come one after the other.
        for batch in batches:
            piece = batch.column("piece").to_numpy()
            for p in np.unique(piece).tolist():
                own = np.flatnonzero(piece == p)
                if p not in held and held:
                    yield from finished(held)
                held.setdefault(p, []).append((matrix(batch.column("x"), width)[own], batch.column("label").to_numpy()[own]))
        yield from finished(held)

    def finished(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for p, parts in held.items():
            x, label = (np.concatenate(c) for c in zip(*parts))
            new, taken = train_piece(state, steps, sizes, x, label, settings, [(settings.seed, e, p) for e in epochs])
            blob = (new * len(label)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p % groups], pa.int32()), pa.array([len(label)], pa.int64()), pa.array([taken], pa.int64()), pa.array([blob], pa.binary())],
                ["key", "n", "steps", "state"],
            )
        held.clear()

    def add_up(table: pa.Table) -> pa.Table:
        total = np.zeros_like(state)
        for blob in table.column("state"):
            total += np.frombuffer(blob.as_py()).reshape(state.shape)
        n, taken = sum(table.column("n").to_pylist()), max(table.column("steps").to_pylist())
        return pa.table({"key": table.column("key")[:1], "n": [n], "steps": [taken], "state": pa.array([total.tobytes()], pa.binary())})

    schema = "key int, n long, steps long, state binary"
    found = rows.mapInArrow(train, schema).groupBy("key").applyInArrow(add_up, schema).collect()  # one row a group
    if not found:
        raise ValueError("there are no rows to learn from")
    found.sort(key=lambda r: r.key)
    total = sum(np.frombuffer(r.state).reshape(state.shape) for r in found) / sum(r.n for r in found)
    return total, max(r.steps for r in found)


def accuracy_of(rows: DataFrame, weights: Weights) -> float:
    right = argmax(_scores(weights)("x")) == F.col("label")
    return rows.agg(F.avg(right.cast("double"))).first()[0] or 0.0


def _scores(weights: Weights):
    width = weights.sizes[0]

    @F.arrow_udf("array<double>")
    def scores(x: pa.Array) -> pa.Array:
        found = weights.scores(matrix(x, width))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))

    return scores


class DenseNetwork(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """A classifier of vectors; ``labelCol`` is the number of a class from 0."""

    def __init__(self, inputs: int, classes: int, settings: Settings):
        super().__init__()
        self.sizes, self.settings = (inputs, *settings.hidden, classes), settings

    def pieces(self, dataset: DataFrame, part: str | None = None) -> tuple[DataFrame, int]:
        return dealt(dataset.withColumn("_x", vector_to_array(self.getFeaturesCol())), "_x", self.getLabelCol(), part)

    def model(self, weights: Weights) -> "NetworkModel":
        model = NetworkModel(weights)
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model

    def _fit(self, dataset: DataFrame) -> "NetworkModel":
        return self.model(fit_network(*self.pieces(dataset), self.sizes, self.settings, step=self.settings.epochs)[0])

    def fit_with_dev(self, train: DataFrame, dev: DataFrame, patience: int, step: int = 5) -> tuple["NetworkModel", dict[int, float]]:
        """Stop when ``patience`` epochs did not better the accuracy on ``dev``; also returns that accuracy by epochs."""
        columns = [self.getFeaturesCol(), self.getLabelCol()]
        both = train.select(*columns, F.lit(0).alias("_part")).unionByName(dev.select(*columns, F.lit(1).alias("_part")))
        weights, seen = fit_network(*self.pieces(both, "_part"), self.sizes, self.settings, 1, patience, step)
        return self.model(weights), seen


class NetworkModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """Adds ``predictionCol``, the number of the class with the highest score (the lowest such number)."""

    def __init__(self, weights: Weights | None = None):
        super().__init__()
        self.weights = weights

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        # A network can't take null or NaN as a feature: such a row fails instead of getting a guess.
        bad = F.exists(x, lambda v: v.isNull() | F.isnan(v))
        checked = F.when(bad, F.raise_error(F.lit("null or NaN is no feature of a network"))).otherwise(x)
        return dataset.withColumn(self.getPredictionCol(), argmax(_scores(self.weights)(checked)).cast("double"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: NetworkModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        weights = self.model.weights
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"sizes": list(weights.sizes)})
        table = pa.table({"weights": pa.array([weights.flat], pa.list_(pa.float64()))})
        self.sparkSession.createDataFrame(table).write.parquet(f"{path}/weights")


class _Reader(MLReader):
    def load(self, path: str) -> NetworkModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        flat = np.array(self.sparkSession.read.parquet(f"{path}/weights").first()[0], float)
        model = NetworkModel(Weights(tuple(metadata["sizes"]), flat))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
