"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest staged table, in bytes of its files, that is marked for broadcast.
MAX_BROADCAST_BYTES = 4 << 20


def builder(app: str = "trackframe") -> SparkSession.Builder:
    """Settings every job here relies on; partition counts are left to the cluster."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach; only a local session may use a temporary one."""
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="trackframe-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder; a :func:`owned_scratch` around it removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (owner := _owner.get()) is not None:
        owner.append(path)
    return path


_owner: ContextVar[list[str] | None] = ContextVar("owner", default=None)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end the scratch folders made inside. Results that read them must be written by then."""
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield
    finally:
        _owner.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and go on from there (an action).

    What was read from text is parsed once, later passes read only the columns they need, and a
    lost executor costs a re-read. It also fixes running row ids: the splits of a text scan, and
    with them the ids, may differ between two jobs.
    """
    return df.sparkSession.read.schema(df.schema).parquet(staged_path(df, name))


def staged_path(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` as :func:`stage` does and return its path.

    Tables that are written one after the other are read by one scan of all their paths, where a union
    would scan, plan and compile each of them alone.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def bounded(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Stage a table that should be small, and mark it for broadcast if its files are small.

    This is an action. Its rows do not pass through Python on the driver. A larger table is returned
    as staged and joins through a shuffle, with the same result.
    """
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    table = stage(df, "small")
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(table) if size <= max_bytes else table


def attach(
    df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", max_bytes: int | None = None
) -> DataFrame:
    """Join a table that should be small to one where a single key may hold a third of the rows.

    Broadcast where :func:`bounded` allows it. Otherwise it is a shuffle join against a staged table
    with unique keys, of which adaptive execution splits the hot key's partition.
    """
    return df.join(bounded(small, max_bytes), list(keys), how)
