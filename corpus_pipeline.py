"""From raw documents to token counts: five stages, each written as Parquet before the next reads it.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All but the last return
the columns of ``docs``; other columns of the input pass through. Rows without an id are judged by their
text as others are; where copies of a text have ids, one of these stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.llm import bpe, jaccard_join, line_dedup, mixing, quality_model
from trackframe.llm.common import free_name, table
from trackframe.llm.queries import vocabulary
from trackframe.registry.tables import Registry
from trackframe.session import stage

WIDTH, PERCENT = 5, 80
MAX_REPEATS = 1.25


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of these documents, accepts."""
    model = quality_model.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return quality_model.add_score(docs, model, score).where(F.col(score) >= quality_model.ACCEPT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that occur earlier; a document goes if nothing else was in it."""
    removed = free_name(docs, "n_removed_lines")
    rows = line_dedup.drop_repeated_lines(docs, removed=removed)
    rows = rows.where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies (five words, Jaccard 0.8): that with the smallest id, if any has one.

    Rows are numbered and written with their numbers, so rows that share an id, or have none, are copies of
    each other like any others.
    """
    key, component = free_name(docs, "row_key"), free_name(docs, "row_component")
    docs = stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    groups = jaccard_join.near_documents(docs, WIDTH, PERCENT, id_col=key).select(F.col("doc_id").alias(key), F.col("component_id").alias(component))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("row")))
    kept = docs.select(key, "doc_id").join(groups, key).groupBy(component).agg(first.alias("first")).select(F.col("first.row").alias(key))
    return docs.join(kept, key, "left_semi").drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of all sources, as even as a limit of repetitions allows."""
    return mixing.mixed_rows(docs, max_repeats=MAX_REPEATS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, one row per document of the mixture."""
    return bpe.encode_decode(docs, vocabulary("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

# The classifier is learnt, so SQL has no twin of the pipeline; tests follow it by brute force.
ORACLE_SQL = None

registry = Registry()


@registry.add("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
