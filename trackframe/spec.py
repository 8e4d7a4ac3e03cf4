"""Column layouts, class vocabularies and run specifications, checked on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

@dataclass(frozen=True)
class FeatureSpec:
    """Names of a track-update table by family, in file order."""

    numbers: tuple[str, ...]
    matrix: tuple[str, ...]
    extra: tuple[str, ...]
    classes: tuple[str, ...]
    dedupe_ignore: tuple[str, ...] = ()
    nonzero: tuple[str, ...] = ()
    minimum: Mapping[str, float] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numbers + self.matrix + self.extra

    @property
    def columns(self) -> tuple[str, ...]:
        return self.features + self.classes

    @property
    def dedupe_subset(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.dedupe_ignore)

    def read_schema(self) -> T.StructType:
        """Every cell is read as a double: class codes may be written as ``2`` or ``2.0``."""
        return T.StructType([T.StructField(c, T.DoubleType()) for c in self.columns])


@dataclass(frozen=True)
class Vocabulary:
    """Class label -> the class-column values that define it. Order of entry is kept."""

    classes: Mapping[str, tuple[int, ...]]

    def __post_init__(self):
        if not self.classes:
            raise ValueError("a vocabulary needs at least one label")
        if len({len(v) for v in self.classes.values()}) != 1:
            raise ValueError("every label must define the same number of class columns")
        if len(set(self.classes.values())) != len(self.classes):
            raise ValueError("two labels define the same class values")

    @property
    def labels(self) -> list[str]:
        """Labels in text order; the position is the class index used by every encoder."""
        return sorted(self.classes)

    def only(self, labels: Sequence[str]) -> "Vocabulary":
        unknown = [x for x in labels if x not in self.classes]
        if unknown:
            raise ValueError(f"unknown class labels: {unknown}")
        return Vocabulary({x: self.classes[x] for x in labels})

    def frame(self, spark: SparkSession, class_cols: Sequence[str]) -> DataFrame:
        """``label, idx`` and one column per class column, one row per label."""
        index = {label: i for i, label in enumerate(self.labels)}
        schema = T.StructType(
            [T.StructField("label", T.StringType()), T.StructField("idx", T.IntegerType())]
            + [T.StructField(c, T.IntegerType()) for c in class_cols]
        )
        rows = [(label, index[label], *values) for label, values in self.classes.items()]
        return spark.createDataFrame(rows, schema)


# The column names and class codes of the recorded track-update files.
TRACK = FeatureSpec(
    numbers=("speed", "altitude", "verticalSpeed", "range", "bearing", "rangeRate", "signalToNoiseRatio"),
    matrix=tuple(f"sCov{i}" for i in range(1, 37)),
    extra=tuple(f"rCov{i}" for i in range(1, 10)),
    classes=("Class", "Subclass", "Type", "Subtype"),
    dedupe_ignore=("verticalSpeed",),
    nonzero=("verticalSpeed", "signalToNoiseRatio"),
    minimum={"range": 300.0},
)
TRACK_VOCABULARY = Vocabulary(
    {
        "2200": (2, 2, 0, 0),
        "5200": (5, 2, 0, 0),
        "1122": (1, 1, 2, 2),
        "1112": (1, 1, 1, 2),
        "1111": (1, 1, 1, 1),
        "1113": (1, 1, 1, 3),
    }
)


@dataclass(frozen=True)
class DatasetSpec:
    """One builder run: where rows come from, what to add or erase, window length."""

    data_dir: str = ""
    dataset: str = ""
    add: bool = False
    erase: bool = False
    types: tuple[str, ...] = ()
    amounts: tuple[int | str, ...] = ()
    time_series: int = 0
    seed: int = 42
    features: FeatureSpec = TRACK
    vocabulary: Vocabulary = TRACK_VOCABULARY
    exclude_suffixes: tuple[str, ...] = ("1.csv", "3.csv")

    def __post_init__(self):
        if not self.data_dir and not self.dataset:
            raise ValueError("give a data directory or an earlier dataset")
        if self.add and self.erase:
            raise ValueError("cannot add and erase in the same run")
        if self.add and not self.data_dir:
            raise ValueError("adding needs a data directory to take the rows from")
        if (self.add or self.erase) and not self.types:
            raise ValueError("adding or erasing needs class labels")
        if self.time_series < 0:
            raise ValueError("the window length cannot be negative")
        self.vocabulary.only(self.types or list(self.vocabulary.classes))
        for amount in self.amounts:
            if int(amount) < 0:
                raise ValueError("an amount cannot be negative")

    @property
    def quota(self) -> dict[str, int | None]:
        """Amount per label; None (no amount given) means the whole class."""
        amounts = [int(a) for a in self.amounts]
        return {x: amounts[i] if i < len(amounts) else None for i, x in enumerate(self.types)}
