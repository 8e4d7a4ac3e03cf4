"""Forests and boosted trees as Spark ML estimators over a vector of features; NaN in it is a missing value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.functions.columns import argmax
from trackframe.plans.trees import Ensemble, Trees, binned, boost, grow_forest, matrix


class _TreeEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Learns from ``labelCol``, the number of a class from 0."""

    def __init__(self, classes: int, **settings):
        super().__init__()
        self.classes, self.settings = classes, settings

    def bins(self, dataset: DataFrame, part: Column | None = None):
        rows = dataset.withColumn("_x", vector_to_array(self.getFeaturesCol()))
        return binned(rows, "_x", self.getLabelCol(), self.classes, part)

    def model(self, edges: list[np.ndarray], groups: list[Trees], boosted: bool) -> "TreeModel":
        model = TreeModel(Ensemble(edges, self.classes, groups, boosted))
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model


class DeepForest(_TreeEstimator):
    """Trees of any depth on resampled rows; settings are those of :func:`trackframe.plans.trees.grow_forest`."""

    def _fit(self, dataset: DataFrame) -> "TreeModel":
        data = self.bins(dataset)
        return self.model(data.edges, grow_forest(data, **self.settings), False)


class SoftmaxBoosting(_TreeEstimator):
    """One ensemble for all classes; settings are those of :func:`trackframe.plans.trees.boost`."""

    def _fit(self, dataset: DataFrame) -> "TreeModel":
        data = self.bins(dataset)
        return self.model(data.edges, boost(data, **self.settings)[0], True)

    def fit_with_dev(self, train: DataFrame, dev: DataFrame, patience: int) -> tuple["TreeModel", dict[int, float]]:
        """Stop when ``patience`` rounds did not better the accuracy on ``dev``; also returns that accuracy by rounds."""
        columns = [self.getFeaturesCol(), self.getLabelCol()]
        both = train.select(*columns, F.lit(0).alias("_part")).unionByName(dev.select(*columns, F.lit(1).alias("_part")))
        data = self.bins(both, F.col("_part"))
        groups, seen = boost(data, **self.settings, held_out=1, patience=patience)
        return self.model(data.edges, groups, True), seen


class TreeModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """Adds ``predictionCol``, the number of the class with the highest score (the lowest such number)."""

    def __init__(self, ensemble: Ensemble | None = None):
        super().__init__()
        self.ensemble = ensemble

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = F.col(self.getFeaturesCol())
        features = F.when(column.isNotNull(), vector_to_array(column))
        total = None
        for trees in self.ensemble.packed():
            added = _scores(self.ensemble, trees)(features)
            total = added if total is None else F.zip_with(total, added, lambda a, b: a + b)
        if total is None:
            return dataset.withColumn(self.getPredictionCol(), F.lit(0.0))
        rows = dataset.withColumn("_scores", total)
        return rows.withColumn(self.getPredictionCol(), argmax(F.col("_scores")).cast("double")).drop("_scores")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _scores(ensemble: Ensemble, trees: Trees):
    """Scores of one group of trees, for batches of features; a row without features has none."""
    bare = Ensemble(ensemble.edges, ensemble.classes, [], ensemble.boosted, ensemble.depth)
    width = len(ensemble.edges)

    @F.arrow_udf("array<double>")
    def scores(x: pa.Array) -> pa.Array:
        known = np.array(x.is_valid())
        found = bare.scores(trees, matrix(x.drop_null(), width))
        sizes = np.where(known, bare.classes, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()), mask=pa.array(~known))

    return scores


class _Writer(MLWriter):
    """Parameters and bin edges as metadata, the nodes as a table."""

    def __init__(self, model: TreeModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        e = self.model.ensemble
        extra = {
            "edges": [x.tolist() for x in e.edges], "classes": e.classes, "boosted": e.boosted, "depth": e.depth, "trees": [g.trees for g in e.groups],
        }
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"ensemble": extra})
        parts = []
        for number, g in enumerate(e.groups):
            columns = {n: pa.array(getattr(g, n)) for n in ("feature", "bin", "missing_left", "left", "right")}
            offsets = pa.array(np.arange(len(g.feature) + 1, dtype=np.int32) * g.value.shape[1])
            columns["value"] = pa.ListArray.from_arrays(offsets, pa.array(g.value.astype(float).ravel()))
            ids = {"group": pa.array(np.full(len(g.feature), number)), "id": pa.array(np.arange(len(g.feature)))}
            parts.append(pa.table(ids | columns))
        if parts:
            self.sparkSession.createDataFrame(pa.concat_tables(parts)).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> TreeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        extra = metadata["ensemble"]
        groups = []
        if extra["trees"]:
            found = self.sparkSession.read.parquet(f"{path}/nodes").orderBy("group", "id").toArrow()
            group = found.column("group").to_numpy()
            for number, trees in enumerate(extra["trees"]):
                low, high = np.searchsorted(group, [number, number + 1])
                part = found.slice(int(low), int(high - low)).combine_chunks()
                columns = {n: part.column(n).to_numpy() for n in ("feature", "bin", "missing_left", "left", "right")}
                value = matrix(part.column("value").combine_chunks(), len(part.column("value")[0]))
                groups.append(Trees(trees, **columns, value=value if extra["boosted"] else value.astype(np.float32)))
        edges = [np.array(x, float) for x in extra["edges"]]
        model = TreeModel(Ensemble(edges, extra["classes"], groups, extra["boosted"], extra["depth"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
