"""Streaming counterparts: request scoring, running means, incremental ingest."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trackframe.operators.clean import dedupe_first, nonzero
from trackframe.operators.scoring import answer_requests


def read_requests(
    spark: SparkSession, path: str | None = None, kafka: Mapping[str, str] | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """JSON requests, one per ``value``, from a folder of text files or a Kafka topic."""
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")
    if path is not None:
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return spark.readStream.format("kafka").options(**kafka).load().select(F.col("value").cast("string"))


def score_stream(
    requests: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    target: str,
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Answer every request once. Replies and dead letters are partitions of one file sink.

    The sink's commit log makes a restart from the checkpoint add nothing twice.
    """
    answered = answer_requests(requests, model, features, target)
    return (
        answered.writeStream.format("parquet").partitionBy("outcome").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def topic_rows(answered: DataFrame, replies: str, dead: str) -> DataFrame:
    """Answers as rows of a topic sink: ``topic``, ``key`` (where the reply goes) and ``value``.

    A reply's value is its JSON; a dead letter's holds the request and the fault.
    """
    is_reply = F.col("outcome") == "reply"
    letter = F.to_json(F.struct(F.col("value").alias("request"), "fault"))
    return answered.select(
        F.when(is_reply, replies).otherwise(dead).alias("topic"),
        F.concat_ws(":", "reply_host", F.col("reply_port").cast("string")).alias("key"),
        F.when(is_reply, F.col("reply")).otherwise(letter).alias("value"),
    )


def score_to_topic(
    requests: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    target: str,
    replies: str,
    dead: str,
    checkpoint: str,
    options: Mapping[str, str],
    sink: str = "kafka",
    trigger: Mapping[str, object] | None = None,
) -> DataStreamWriter:
    """The writer that answers requests into two topics; ``start()`` runs it. Delivery is at least once."""
    rows = topic_rows(answer_requests(requests, model, features, target), replies, dead)
    return (
        rows.writeStream.format(sink).options(**options).outputMode("append").queryName(f"answers-{target}")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    )


# Runs of one level that are merged into one of the next.
FAN = 10


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _folder(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def manifests(spark: SparkSession, out: str) -> list[int]:
    """The batches after which a whole list of live runs was written, oldest first."""
    whole = [n for n in _names(spark, f"{out}/manifests") if _folder(spark, f"{out}/manifests/{n}/_SUCCESS")[0].exists(_folder(spark, f"{out}/manifests/{n}/_SUCCESS")[1])]
    return sorted(int(n.removeprefix("upto-")) for n in whole)


def live_runs(spark: SparkSession, out: str, batch: int | None = None) -> list[str]:
    """The runs a reader has to look at, oldest first, after the newest batch or a given one."""
    known = manifests(spark, out) if batch is None else [batch]
    return [r.value for r in spark.read.text(f"{out}/manifests/upto-{known[-1]}").orderBy("value").collect()] if known else []


def run_name(level: int, first: int, last: int) -> str:
    """Names sort by the batches they hold."""
    return f"run-{first:012d}-{last:012d}-{level}"


def merge_plan(runs: Sequence[str], fan: int) -> tuple[list[str], list[tuple[list[str], str]]]:
    """Merge the last ``fan`` runs as long as they are of one level: the runs left, and each merge in turn."""
    runs, merges = list(runs), []
    parsed = lambda name: [int(x) for x in name.split("-")[1:]]
    while len(runs) >= fan and len({parsed(r)[2] for r in runs[-fan:]}) == 1:
        last = runs[-fan:]
        merged = run_name(parsed(last[0])[2] + 1, parsed(last[0])[0], parsed(last[-1])[1])
        merges.append((last, merged))
        runs = [*runs[:-fan], merged]
    return runs, merges


def stored(spark: SparkSession, out: str) -> DataFrame:
    """All rows that count, with ``batch``: the runs of the newest manifest."""
    runs = live_runs(spark, out)
    if not runs:
        raise ValueError(f"nothing is stored in {out}")
    return spark.read.parquet(*[f"{out}/runs/{r}" for r in runs])


def _save(out: str, shrink: Callable[[DataFrame], DataFrame], fan: int) -> Callable[[DataFrame, int], None]:
    """Write a batch as a run of its own, and merge runs level by level.

    ``fan`` runs of a level become one of the next, so a row is rewritten once a level: a batch costs its own rows
    and, on average, as many again for every level. A manifest lists the live runs and is written last; a batch
    whose manifest is there is not stored again. Runs that neither of the last two manifests lists are removed.
    """

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = manifests(spark, out)
        if known and known[-1] >= number:
            if known[-1] > number:
                raise ValueError(f"batch {number} comes again, but batch {known[-1]} is stored: the checkpoint is older than {out}")
            return
        before = live_runs(spark, out, known[-1]) if known else []
        own = run_name(0, number, number)
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/runs/{own}")
        runs, merges = merge_plan([*before, own], fan)
        for parts, merged in merges:
            rows = spark.read.parquet(*[f"{out}/runs/{r}" for r in parts])
            shrink(rows).select(*rows.columns).write.mode("overwrite").parquet(f"{out}/runs/{merged}")
        lines = spark.createDataFrame([(r,) for r in runs], "value string")
        lines.coalesce(1).write.mode("overwrite").text(f"{out}/manifests/upto-{number}")
        kept = {*runs, *before}
        for name in _names(spark, f"{out}/runs"):
            if name not in kept:
                system, folder = _folder(spark, f"{out}/runs/{name}")
                system.delete(folder, True)
        for old in known[:-1]:
            system, folder = _folder(spark, f"{out}/manifests/upto-{old}")
            system.delete(folder, True)

    return save


def running_mean_stream(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    fan: int = FAN,
) -> StreamingQuery:
    """Sum, count and mean per key over everything seen so far; each batch writes what changed.

    State is one row per key. Readers see the runs of one manifest, fewer than ``fan`` of each level.
    """
    means = df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean"))
    return (
        means.writeStream.outputMode("update").foreachBatch(_save(out, lambda rows: _newest(rows, keys), fan))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def _newest(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in history.columns if c not in keys]
    return history.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(*keys, "s.*")


def latest_means(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The newest state of every key."""
    return _newest(stored(spark, out), keys).drop("batch")


def ingest_stream(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    subset: Sequence[str] = (),
    order: Sequence[str] = (),
    fan: int = FAN,
) -> StreamingQuery:
    """Append each batch of new rows to the stored history under its batch number.

    Copies are resolved on reading (:func:`current_dataset`). With ``subset`` and ``order``, as given to
    that reader, they are also resolved whenever runs are merged.
    """

    def shrink(history: DataFrame) -> DataFrame:
        return _first_copies(history, subset, order) if subset else history

    return (
        rows.writeStream.foreachBatch(_save(out, shrink, fan)).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _first_copies(history: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    return dedupe_first(history.withColumn("_newest", -F.col("batch")), subset, ["_newest", *order]).drop("_newest")


def current_dataset(
    spark: SparkSession,
    out: str,
    subset: Sequence[str],
    order: Sequence[str],
    nonzero_columns: Sequence[str],
) -> DataFrame:
    """The cleaned dataset over all batches; newer batches come first, as on re-running the builder."""
    return nonzero(_first_copies(stored(spark, out), subset, order), nonzero_columns)
