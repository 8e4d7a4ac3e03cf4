"""Directory, dataset, timeline and log scans, with an explicit row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.functions.columns import nan_to_null
from trackframe.session import attach, bounded, stage
from trackframe.spec import FeatureSpec

# Row order of a scan: file, part of the file, running id inside the scan task. A part is also the
# bucket of the positional operators and holds at most 2^PART_BITS rows, also where a file can't be
# split (a compressed one): its number is the start of the file split plus the running row number
# over 2^PART_BITS, which stays below the start of the next split, as a row has a byte at least.
ORDER = ("_file", "_blk", "_pos")
BUCKET = ("_file", "_blk")
PART_BITS = 16
_ROW_BITS = 33  # of the running id, below the number of the task


def _order_columns() -> list[Column]:
    running = F.monotonically_increasing_id()
    return [
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.file_block_start") + F.shiftright(running.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)), PART_BITS)).alias("_blk"),
        running.alias("_pos"),
    ]


def exclude_suffix(df: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Leave out files by name ending. Nothing is deleted; the files are never opened."""
    for suffix in suffixes:
        df = df.where(~F.col("_metadata.file_name").endswith(suffix))
    return df


# How cells are read.
CELLS = {"nullValue": "NaN", "positiveInf": "inf", "negativeInf": "-inf"}


def scan_csv(
    spark: SparkSession, path: str, spec: FeatureSpec, exclude_suffixes: Sequence[str] = ()
) -> DataFrame:
    """All CSV files of a folder; names are imposed by position, file headers are discarded.

    Adds the order key. Empty cells, NaN and text become NULL; ``Infinity`` and ``inf`` are read as
    such. The parser makes the NULLs: one expression per column would outgrow what the JVM
    compiles. A class code is a whole number: a fraction, or one that no integer holds, is NULL.
    """
    reader = spark.read.schema(spec.read_schema()).options(header=True, enforceSchema=True, **CELLS)
    rows = exclude_suffix(reader.csv(path), exclude_suffixes)
    classes = [class_code(c).alias(c) for c in spec.classes]
    return rows.select(*spec.features, *classes, *_order_columns())


def scan_parquet(spark: SparkSession, path: str, spec: FeatureSpec) -> DataFrame:
    """A dataset kept as Parquet, in the same shape as :func:`scan_csv`."""
    rows = spark.read.parquet(path).select(*spec.columns, *_order_columns())
    return nan_to_null(rows, spec.columns).withColumns({c: class_code(c) for c in spec.classes})


def class_code(column: str) -> Column:
    """The whole number a class column holds, else NULL."""
    value = F.col(column).cast("double")
    return F.when(value == F.floor(value), value.try_cast("int"))


def scan_dataset(spark: SparkSession, path: str, spec: FeatureSpec) -> DataFrame:
    return scan_parquet(spark, path, spec) if path.rstrip("/").endswith(".parquet") else scan_csv(spark, path, spec)


def parse_files(spark: SparkSession, path: str, spec: FeatureSpec, exclude_suffixes: Sequence[str] = ()) -> DataFrame:
    """Every line of all CSV files of a folder, read and parsed once and staged.

    The rows are those of :func:`scan_csv`, headers and rows of bad files included, with ``_fields``, the
    number of cells of the line. Blank lines are left out.
    """
    lines = exclude_suffix(spark.read.text(path), exclude_suffixes).select("value", *_order_columns()).where(F.trim("value") != "")
    quoted = F.col("value").contains('"')
    plain = F.when(quoted, F.regexp_replace("value", '"[^"]*"', "")).otherwise(F.col("value"))
    fields = (F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(","))) + 1).alias("_fields")
    cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.read_schema())
    row = F.from_csv("value", cells, CELLS)
    rows = lines.select(*ORDER, fields, row.alias("_row"))
    return stage(rows.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in spec.features], *[class_code(f"_row.`{c}`").alias(c) for c in spec.classes], *ORDER, "_fields"
    ), "parsed")


def quarantine_files(
    spark: SparkSession, path: str, spec: FeatureSpec, exclude_suffixes: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The rows of all sound files, and the list of files left out.

    A file is bad if its header does not have a cell per column or if it holds a longer row; a shorter row is
    no fault (its missing cells are NULL). Text is read once: what is known about a file after that decides
    which of the staged rows count.
    """
    parsed = parse_files(spark, path, spec, exclude_suffixes)
    place = F.struct("_blk", "_pos")
    per_file = bounded(parsed.groupBy("_file").agg(
        F.min_by("_fields", place).alias("header_fields"), F.max("_fields").alias("most_fields"), F.min(place).alias("_header")
    ))
    width = len(spec.columns)
    bad = per_file.where((F.col("header_fields") != width) | (F.col("most_fields") > width)).drop("_header")
    sound = per_file.where((F.col("header_fields") == width) & (F.col("most_fields") == width)).select("_file", "_header")
    rows = attach(parsed, sound, ["_file"]).where(place != F.col("_header"))
    return rows.select(*spec.columns, *ORDER), bad


def unclassed_rows(df: DataFrame, classes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all class columns given, and the rest."""
    known = F.lit(True)
    for c in classes:
        known = known & F.col(c).isNotNull()
    return df.where(known), df.where(~known)


def scan_timeline(spark: SparkSession, path: str) -> DataFrame:
    """A wide label timeline; column names come from the header, labels stay text."""
    return spark.read.option("header", True).csv(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the order key."""
    return spark.read.text(path).select("value", *_order_columns())
