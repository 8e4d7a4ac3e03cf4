"""Console logs to measurement tables, wide timelines to chart traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.operators.logs import log_records, measure_sorted, phase_split
from trackframe.operators.timeline import extend_one, timeline_long, trace_series, truth_vs_pred
from trackframe.session import stage
from trackframe.sources.files import BUCKET, ORDER, scan_lines, scan_timeline

# Seconds in a bucket of a timeline.
TIMELINE_BUCKET = 3600


def measurement_tables(
    spark: SparkSession,
    path: str,
    patterns: Sequence[str],
    names: Sequence[str],
    by: str,
    marker: float,
) -> dict[int, DataFrame]:
    """Records of lines that match ``patterns`` in turn, their values under ``names``.

    The distinct records before and from the marker on, as phases 1 and 2, in ascending order."""
    records = log_records(scan_lines(spark, path), patterns, names, ["_file"], ORDER[1:], BUCKET[1:])
    phases = phase_split(stage(records, "records"), ["_file"], "record", by, marker)
    columns = [by, *[n for n in names if n != by]]
    return {p: measure_sorted(phases.where(F.col("phase") == p), columns, columns) for p in (1, 2)}


def timeline_reports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Chart traces of a wide label timeline, extended by one step, and the agreement per track."""
    # Extending looks at the rows several times: the text is read once.
    long = extend_one(stage(timeline_long(scan_timeline(spark, path)), "timeline"), ["track", "role"])
    long = stage(long.withColumn("_bucket", F.floor(F.col("time") / TIMELINE_BUCKET)), "timeline")
    return trace_series(long, ["track", "role"], ["_bucket"]), truth_vs_pred(long, ["track"], ["_bucket"])
