"""Train, search, evaluate, save and load classifiers."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.functions.columns import divide_by_row_max
from trackframe.operators.knn import knn1
from trackframe.operators.position import cut_points
from trackframe.operators.scale import MinMaxColumns, MinMaxColumnsModel
from trackframe.operators.sequence import fixed_windows, seq_split, window_tensor
from trackframe.operators.stats import accuracy, outcome_counts
from trackframe.plans.networks import DenseNetwork, Settings, fit_network
from trackframe.plans.tree_models import DeepForest, SoftmaxBoosting
from trackframe.plans.trees import Ensemble, boost, grow_forest, held_out_accuracy
from trackframe.session import attach, stage

def gradient_boosting(inputs: int | None, classes: int, trees: int = 3500, depth: int = 6, rate: float = 0.3) -> SoftmaxBoosting:
    """Boosted trees for the softmax of all classes; ``trees`` counts rounds of one tree a class."""
    return SoftmaxBoosting(classes, rounds=trees, depth=depth, rate=rate)


def random_forest(
    inputs: int | None, classes: int, trees: int = 1000, depth: int = 32, share: float = 0.2, impurity: str = "entropy"
) -> DeepForest:
    """A forest of trees of any depth; every node chooses among a ``share`` of the features."""
    return DeepForest(classes, trees=trees, depth=depth, share=share, measure=impurity)


def dense_network(
    inputs: int, classes: int, hidden: Sequence[int] | None = None, epochs: int = 1000, dropout: float = 0.1, batch: int = 512, rate: float = 0.001
) -> DenseNetwork:
    """A feed-forward network of ReLU layers.

    Without ``hidden`` it has ten layers of five more than half of inputs and classes together, with dropout
    behind every second of the first eight, and one of a quarter.
    """
    if hidden is None:
        half = (inputs + classes) // 2
        hidden, dropped = (*[half + 5] * 10, *([half // 2] if half // 2 > 1 else [])), (1, 3, 5, 7)
    else:
        dropped = ()
    return DenseNetwork(inputs, classes, Settings(tuple(hidden), epochs, dropout, dropped, batch, rate))


# Model kinds by their short names. "knn" is fitted by NearestNeighbourModel.
REGISTRY = {"gb": gradient_boosting, "rf": random_forest, "dense": dense_network}
# "merge" and "ts" are dense networks over prepared inputs, see trackframe.train.
KINDS = (*REGISTRY, "knn", "merge", "ts")


TREES = ("gb", "rf")
# What a missing feature counts as in a reduction: outside the range that training rows are scaled to.
MISSING = -1.0


def missing_as_value(columns: Sequence[str]) -> SQLTransformer:
    """Add ``<column>_filled``: NULL and NaN as a value of their own, which a reduction can take."""
    filled = ", ".join(f"coalesce(nanvl(`{c}`, NULL), {MISSING}D) AS `{c}_filled`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def label_pipeline(
    kind: str,
    features: Sequence[str],
    labels: Sequence[str],
    label: str = "label",
    encode: Sequence[str] = (),
    components: int | None = None,
    params: Mapping[str, object] | None = None,
    unscaled: Sequence[str] = (),
    scaler: MinMaxColumnsModel | None = None,
) -> "LabelPipeline":
    """Scale, assemble, optionally encode and reduce, classify, name the class.

    Encoded features go before the rest, ``unscaled`` columns after it. A fitted ``scaler`` for the
    features may be given. One sorted label list is stored with the model. Trees learn where missing
    features go (before a reduction they are a value of their own); networks refuse them.
    """
    plain = [f for f in features if f not in encode]
    scaled = [f"{f}_scaled" for f in plain]
    stages = [scaler or MinMaxColumns(inputCols=plain, outputCols=scaled)]
    blocks = []
    if encode:
        stages += encoder_stages(encode)
        blocks = [f"{f}_hot" for f in encode]
    target = "assembled" if components else "features_vector"
    numbers = [*scaled, *unscaled]
    width = len(numbers)
    if kind in TREES and components:
        stages.append(missing_as_value(numbers))
        numbers = [f"{c}_filled" for c in numbers]
    # Trees and networks get missing values as NaN: the ones learn from them, the others refuse them.
    stages.append(VectorAssembler(inputCols=[*blocks, *numbers], outputCol=target, handleInvalid="error" if components else "keep"))
    if encode and (components or kind == "dense"):
        raise ValueError("a reduced or dense model needs plain features: its input width must be known")
    if components:
        stages.append(PCA(k=components, inputCol=target, outputCol="features_vector"))
        width = components
    labels = sorted(labels)
    classifier = REGISTRY[kind](width, len(labels), **(params or {}))
    classifier = classifier.copy({classifier.featuresCol: "features_vector", classifier.labelCol: "label_index"})
    index = StringIndexerModel.from_labels(labels, inputCol=label, outputCol="label_index", handleInvalid="error")
    name = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels)
    return LabelPipeline(index, Pipeline(stages=[*stages, classifier, name]))


@dataclass
class LabelPipeline:
    """A pipeline whose fitted model needs no label column: labels are indexed for training only."""

    index: StringIndexerModel
    pipeline: Pipeline

    def fit(self, train: DataFrame) -> PipelineModel:
        # A copy leaves the training summary behind: it would tie the model to the training plan.
        return self.pipeline.fit(self.index.transform(train)).copy()

    def prepared(self, *tables: DataFrame) -> tuple[list[Estimator], list[DataFrame]]:
        """The stages before the classifier, fitted on the first table, and all tables after them."""
        stages = Pipeline(stages=self.pipeline.getStages()[:-2]).fit(self.index.transform(tables[0]))
        return stages.stages, [stages.transform(self.index.transform(t)) for t in tables]

    def fit_with_dev(self, train: DataFrame, dev: DataFrame, patience: int = 20, step: int = 5) -> tuple[PipelineModel, list[float]]:
        """Fit a network or boosted trees and keep what did best on ``dev``.

        Training ends when ``patience`` epochs (or rounds) bring no better accuracy on ``dev``, which is looked
        at every ``step`` epochs (or whenever raw scores are written). Returns the model and these accuracies.
        """
        stages, rows = self.prepared(train, dev)
        classifier, name = self.pipeline.getStages()[-2:]
        more = {"step": step} if isinstance(classifier, DenseNetwork) else {}
        model, seen = classifier.fit_with_dev(*rows, patience, **more)
        return PipelineModel([*stages, model, name]).copy(), [seen[k] for k in sorted(seen)]


def encoder_stages(columns: Sequence[str]) -> list[Estimator]:
    """Index categories in text order and one-hot encode them without dropping any."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="error"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_hot" for c in columns], dropLast=False),
    ]


def subset_encoder(encode: Sequence[str], rest: Sequence[str], out: str = "encoded") -> Pipeline:
    """Encoded block first, the other features after it, each in list order."""
    blocks = [f"{c}_hot" for c in encode]
    return Pipeline(stages=[*encoder_stages(encode), VectorAssembler(inputCols=[*blocks, *rest], outputCol=out)])


# What a model reaches on the way to its largest value: one fit is scored at all values of it.
PATHS = {"gb": "trees", "rf": "depth", "dense": "epochs"}


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    labels: Sequence[str],
    kind: str,
    grid: Mapping[str, Sequence[object]],
    order: Sequence[str],
    bucket: Sequence[str],
    folds: int = 3,
    params: Mapping[str, object] | None = None,
) -> tuple[DataFrame, Mapping[str, object]]:
    """Mean and deviation of the accuracy per parameter combination, and the best combination.

    ``grid`` and ``params`` name arguments of the kind's entry in ``REGISTRY``. Folds are consecutive parts of
    each class, cut by position. All folds share one table of prepared rows, and combinations that differ only in
    the kind's path (``PATHS``) share one fit a fold: boosting is scored after some rounds of a longer fit, a
    network after some epochs, a forest as cut off at a depth.
    """
    path = PATHS[kind]
    values = list(grid.get(path, [{**(params or {})}.get(path)]))
    others = [n for n in grid if n != path]
    rest = [dict(zip(others, v)) for v in itertools.product(*[grid[n] for n in others])]
    most = {} if values == [None] else {path: max(values)}
    folded = class_folds(train, label, order, bucket, folds)
    pipelines = [label_pipeline(kind, features, labels, label, params={**(params or {}), **most, **r}) for r in rest]
    _, (rows,) = pipelines[0].prepared(folded)
    found: dict[tuple, list[float]] = {}
    shared = None
    for r, pipeline in zip(rest, pipelines):
        classifier = pipeline.pipeline.getStages()[-2]
        if shared is None:
            shared = classifier.pieces(rows, "fold") if kind == "dense" else classifier.bins(rows, F.col("fold"))
        settings = getattr(classifier, "settings")
        for fold in range(folds):
            if kind == "gb":
                marks = values if most else [settings["rounds"]]
                seen = boost(shared, **settings, held_out=fold, checks=marks)[1]
            elif kind == "rf":
                marks = values if most else [settings["depth"]]
                groups = grow_forest(shared, **settings, held_out=fold)
                seen = held_out_accuracy(shared, Ensemble(shared.edges, len(labels), groups, False), fold, marks)
            else:
                marks = values if most else [settings.epochs]
                seen = fit_network(*shared, classifier.sizes, settings, fold, step=settings.epochs, checks=marks)[1]
            for value, mark in zip(values, marks):
                found.setdefault((*r.items(), *([(path, value)] if most else [])), []).append(seen[mark])
    shown = lambda c: ", ".join(f"{n}={v}" for n, v in sorted(c))
    scores = [(shown(c), float(np.mean(s)), float(np.std(s))) for c, s in found.items()]
    best = list(found)[max(range(len(scores)), key=lambda i: scores[i][1])]
    table = train.sparkSession.createDataFrame(scores, "params string, mean_score double, sd_score double")
    return table, dict(best)


def class_folds(df: DataFrame, label: str, order: Sequence[str], bucket: Sequence[str], folds: int) -> DataFrame:
    """Add ``fold`` (from 0): consecutive parts of each class, sizes differing by one at most."""
    ranks = {f"_f{i}": F.expr(f"_n * {i + 1} div {folds}") for i in range(folds - 1)}
    cuts = cut_points(df, [label], order, bucket, ranks)
    key = F.struct(*order)
    fold: Column = sum(
        (F.coalesce((key > F.col(name)).cast("int"), F.lit(1)) for name in ranks), F.lit(0)
    )
    return attach(df, cuts, [label], "left").withColumn("fold", fold).select(*df.columns, "fold")


@dataclass
class NearestNeighbourModel:
    """Nearest neighbour over min-max scaled features, kept as a table of training rows."""

    scaler: MinMaxColumnsModel
    train: DataFrame  # _tid, label, x

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str], label: str, row_id: str) -> "NearestNeighbourModel":
        scaler = MinMaxColumns(inputCols=list(features), outputCols=[f"{f}_scaled" for f in features]).fit(train)
        rows = scaler.transform(train).select(
            F.col(row_id).alias("_tid"), F.col(label).alias("label"), cls._vector(scaler).alias("x")
        )
        return cls(scaler, stage(rows, "neighbours"))

    @staticmethod
    def _vector(scaler: MinMaxColumnsModel) -> Column:
        return F.array(*[F.col(c) for c in scaler.getOutputCols()])

    def transform(self, df: DataFrame, row_id: str) -> DataFrame:
        """``df`` with ``predicted_label``; ``row_id`` must be unique."""
        queries = self.scaler.transform(df).select(F.col(row_id), self._vector(self.scaler).alias("x"))
        found = knn1(self.train, queries, "_tid", "label", row_id, "x")
        named = found.select(F.col("qid").alias(row_id), F.col("label").alias("predicted_label"))
        return df.join(named, row_id)

    def save(self, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        self.train.write.mode("overwrite").parquet(f"{path}/train")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NearestNeighbourModel":
        return cls(MinMaxColumnsModel.load(f"{path}/scaler"), spark.read.parquet(f"{path}/train"))


def merged_inputs(df: DataFrame, matrix: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the matrix columns over their row's maximum; what is not finite counts as 0."""
    names = [f"{c}_of_max" for c in matrix]
    shares = df.withColumn("_shares", divide_by_row_max(F.array(*[F.col(c).cast("double") for c in matrix])))
    finite = lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x).otherwise(0.0)
    return shares.withColumns({n: finite(F.col("_shares")[i]) for i, n in enumerate(names)}).drop("_shares"), names


def window_rows(
    rows: DataFrame, features: Sequence[str], steps: int, order: Sequence[str], bucket: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """One row per window of ``steps`` rows of a class, split by position: label, split, features by step.

    ``rows`` carry ``label``; they are read several times.
    """
    split = seq_split(rows, "label", order, bucket, steps)
    windows = fixed_windows(split, ["label", "split"], order, bucket, steps)
    tensors = window_tensor(windows, ["label", "split"], features)
    names = [f"{f}_{i}" for i in range(steps) for f in features]
    cells = [F.col("tensor")[i][j] for i in range(steps) for j in range(len(features))]
    return tensors.select("label", "split", "win_id", *[c.alias(n) for c, n in zip(cells, names)]), names


def window_scaler(train: DataFrame, features: Sequence[str], names: Sequence[str]) -> MinMaxColumnsModel:
    """One range per feature, shared by all steps of a window."""
    fitted = MinMaxColumns(inputCols=list(names), outputCols=[f"{n}_scaled" for n in names]).fit(train)
    low, high = (fitted.getOrDefault(p) for p in (fitted.low, fitted.high))
    width = len(features)
    shared_low = [min(low[j::width]) for j in range(width)]
    shared_high = [max(high[j::width]) for j in range(width)]
    steps = len(names) // width
    fitted._set(low=shared_low * steps, high=shared_high * steps)
    return fitted


def evaluate(scored: DataFrame, label: str = "label") -> DataFrame:
    """Rows per (truth, predicted label); confusion, accuracy and report derive from it."""
    return outcome_counts(scored, label, "predicted_label")


def bundle_name(kind: str, at: dt.datetime) -> str:
    """Kind and time; sizes and scores are in the metrics file."""
    return f"{kind}-{at:%Y%m%dT%H%M%S%f}"


def save(model, kind: str, folder: str, counts: DataFrame, train_rows: int) -> str:
    """Write the model and a one-row metrics file below ``folder``; returns the bundle's path."""
    spark = counts.sparkSession
    scores = accuracy(counts).first()
    now = dt.datetime.now()
    path = f"{folder.rstrip('/')}/{bundle_name(kind, now)}"
    if kind == "knn":
        model.save(f"{path}/model")
    else:
        model.write().save(f"{path}/model")
    meta = [(kind, float(scores.accuracy), float(scores.accuracy_pct), now.isoformat(), train_rows, scores.rows)]
    columns = "kind string, accuracy double, accuracy_pct double, saved_at string, train_rows long, test_rows long"
    spark.createDataFrame(meta, columns).coalesce(1).write.json(f"{path}/metrics")
    return path


def load(spark: SparkSession, path: str):
    """The kind, read from the metrics file, and the model."""
    kind = spark.read.json(f"{path}/metrics").first().kind
    model = NearestNeighbourModel.load(spark, f"{path}/model") if kind == "knn" else PipelineModel.load(f"{path}/model")
    return kind, model
