"""Min-max scaling as a Spark ML estimator over plain columns."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(column: str) -> Column:
    """The value as a double; NaN, which sorts above every number, counts as missing."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


class MinMaxColumns(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns each column's minimum and maximum in one aggregation.

    A constant column scales to 0, and values outside the learned range are not clipped.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MinMaxColumnsModel":
        columns = self.getInputCols()
        found = dataset.agg(
            F.array(*[F.min(_number(c)) for c in columns]).alias("low"),
            F.array(*[F.max(_number(c)) for c in columns]).alias("high"),
        ).first()
        if any(v is None for v in [*found.low, *found.high]):
            raise ValueError("cannot scale a column without values")
        model = MinMaxColumnsModel()
        model._set(inputCols=columns, outputCols=self.getOutputCols(), low=found.low, high=found.high)
        return model


class MinMaxColumnsModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    low = Param(Params._dummy(), "low", "minimum per input column", TypeConverters.toListFloat)
    high = Param(Params._dummy(), "high", "maximum per input column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {}
        for source, out, low, high in zip(
            self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.low), self.getOrDefault(self.high)
        ):
            width = (high - low) or 1.0
            scaled[out] = (F.col(source).cast("double") - F.lit(low)) / F.lit(width)
        return dataset.withColumns(scaled)


def minmax_scale(train: DataFrame, *others: DataFrame, columns: list[str]) -> list[DataFrame]:
    """Fit on the first table, scale it and the others in place."""
    model = MinMaxColumns(inputCols=columns, outputCols=columns).fit(train)
    return [model.transform(df) for df in (train, *others)]
