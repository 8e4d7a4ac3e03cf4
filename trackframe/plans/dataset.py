"""The dataset builder: scan, add, append, erase, clean, count, write."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.functions.columns import composite_label, row_key
from trackframe.operators.clean import all_of, clean_rows, is_at_least, is_nonzero, sep_classes
from trackframe.operators.sample import append_dataset, erase_n, erase_windows, head_n_per_class, sample_n_per_class
from trackframe.operators.sequence import clean_windows, fixed_windows
from trackframe.operators.stats import class_counts, observe_rows
from trackframe.session import stage
from trackframe.sources.files import ORDER, quarantine_files, scan_dataset, unclassed_rows
from trackframe.sources.sinks import by_windows, write_csv
from trackframe.spec import DatasetSpec

# What tells windows apart: source, file and class (empty for an earlier dataset), then number.
WINDOW = ("_src", "_file", "_class", "win_id")


def build_dataset(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The cleaned rows of one run, with a ``label`` column and the order or window columns.

    Rows without a whole class are left out, as are files of another shape; both can be listed by
    :func:`trackframe.sources.files.quarantine_files` and ``unclassed_rows``.
    """
    return _build(*read_sources(spark, spec), spec)


def read_sources(spark: SparkSession, spec: DatasetSpec) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows with a whole class of new recordings, and those of an earlier dataset.

    Both are parsed once and staged: everything after reads columns, not text, and row ids stay the same.
    """
    f, new, old = spec.features, None, None
    if spec.data_dir:
        new = unclassed_rows(quarantine_files(spark, spec.data_dir, f, spec.exclude_suffixes)[0], f.classes)[0]
    if spec.dataset:
        old = stage(scan_dataset(spark, spec.dataset, f), "old-rows")
    return new, old


def _build(new: DataFrame | None, old: DataFrame | None, spec: DatasetSpec) -> DataFrame:
    return build_windows(new, old, spec) if spec.time_series else build_rows(new, old, spec)


def build_rows(
    new: DataFrame | None, old: DataFrame | None, spec: DatasetSpec, order: Sequence[str] = ORDER
) -> DataFrame:
    """Add, append, erase and clean single rows. ``order`` identifies a row of one source."""
    f = spec.features
    columns = [*f.columns, *order]
    if new is not None and spec.add:
        classed = sep_classes(new, spec.vocabulary.only(spec.types), f.classes)
        new = sample_n_per_class(classed, "label", spec.quota, order, spec.seed)
    rows = _merge(new, old, columns)
    if spec.erase:
        classed = sep_classes(rows, spec.vocabulary, f.classes)
        rows = erase_n(classed, "label", spec.quota, ["_src", *order], spec.seed).select(*rows.columns)
    clean = clean_rows(rows, f.dedupe_subset, ["_src", *order], f.nonzero)
    return clean.withColumn("label", composite_label(*f.classes))


def build_windows(
    new: DataFrame | None,
    old: DataFrame | None,
    spec: DatasetSpec,
    file: str = "_file",
    order: Sequence[str] = ("_blk", "_pos"),
    bucket: Sequence[str] = ("_blk",),
) -> DataFrame:
    """The same for windows of ``spec.time_series`` rows, which are kept or dropped as a whole."""
    f, steps = spec.features, spec.time_series
    columns = list(dict.fromkeys([*f.columns, file, *order, *bucket, "_class", "win_id", "win_pos"]))
    if new is not None:
        classed = sep_classes(new, spec.vocabulary, f.classes)
        new = fixed_windows(classed, [file, "label"], order, bucket, steps)
        if spec.add:
            new = head_n_per_class(new, "label", spec.quota, [file, *order], [file, *bucket], steps)
        new = new.withColumn("_class", F.col("label"))
    if old is not None:
        # Written by write_dataset: every file holds whole windows, so positions count per file.
        old = fixed_windows(old, [file], order, bucket, steps).withColumn("_class", F.lit(""))
    rows = _merge(new, old, columns)
    window = ["_src", file, "_class"]
    if spec.erase:
        classed = sep_classes(rows, spec.vocabulary, f.classes)
        rows = erase_windows(classed, "label", spec.quota, [*window, "win_id"], steps, spec.seed).select(*rows.columns)
    valid = all_of([*[is_nonzero(c) for c in f.nonzero], *[is_at_least(c, t) for c, t in f.minimum.items()]])
    clean = clean_windows(rows, window, valid, f.dedupe_subset, steps)
    return clean.withColumn("label", composite_label(*f.classes))


def _merge(new: DataFrame | None, old: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    if new is None:
        return old.select(*columns).withColumn("_src", F.lit(1))
    if old is None:
        return new.select(*columns).withColumn("_src", F.lit(0))
    return append_dataset(new.select(*columns), old.select(*columns))


def write_dataset(df: DataFrame, spec: DatasetSpec, path: str, mode: str = "errorifexists") -> int:
    """Write the CSV dataset and return its row count, observed during the write.

    Plain rows are written in a repeatable random order, windows as runs of whole windows. The
    count sits behind the sort, directly under the write: what lies below a range exchange runs
    once more, to sample the ranges.
    """
    if spec.time_series:
        ordered = by_windows(df, WINDOW)
    else:
        ordered = df.withColumn("_key", row_key("_src", *ORDER, seed=spec.seed)).orderBy("_key")
    counted, seen = observe_rows(ordered, "written")
    write_csv(counted, path, spec.features.columns, mode)
    return seen.get["rows"]


def run(spark: SparkSession, spec: DatasetSpec, path: str, mode: str = "errorifexists") -> DataFrame:
    """Build, write, and return rows per class before and after cleaning, the written ones.

    The built rows are staged: they are written and counted, but read and cleaned once.
    """
    sources = read_sources(spark, spec)
    built = stage(_build(*sources, spec), "built")
    written = write_dataset(built, spec, path, mode)
    after = class_counts(built, "label").withColumnRenamed("n", "rows_written")
    before = input_counts(sources, spec)
    report = before.join(after, "label", "full").select(
        "label", F.coalesce("rows_read", F.lit(0)).alias("rows_read"), F.coalesce("rows_written", F.lit(0)).alias("rows_written")
    )
    total = report.agg(F.sum("rows_written")).first()[0] or 0
    if written != total:
        raise RuntimeError(f"{written} rows were written, {total} were built")
    return report


def input_counts(sources: Sequence[DataFrame | None], spec: DatasetSpec) -> DataFrame:
    """Rows per class of what a run has read, before amounts, erasing and cleaning."""
    labels = [s.select(composite_label(*spec.features.classes).alias("label")) for s in sources if s is not None]
    return class_counts(reduce(DataFrame.unionByName, labels), "label").withColumnRenamed("n", "rows_read")
