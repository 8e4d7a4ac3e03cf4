"""The registered query of every operator of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    jaccard_join,
    license_scan,
    line_dedup,
    mixing,
    periodic_runs,
    prefix_trie,
    quality_model,
    quality_rules,
    suffix_dedup,
    token_file,
)
from trackframe.llm.common import table
from trackframe.registry.tables import Registry

registry = Registry()


def vocabulary(name: str) -> str:
    """Where the installed file of a public tokenizer lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@registry.add("op2_bpe_encode_decode")
def op2_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(
        table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256")
    )


MAX_REPEATS = 1.25


@registry.add("op3_temperature_mix", mixing.sql(MAX_REPEATS))
def op3_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), max_repeats=MAX_REPEATS)


@registry.add("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registry.add("op10_line_rules", quality_rules.SQL)
def op10_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, folder, "documents"), with_text=False)


@registry.add("op6_repair_token_file")
def op6_repair_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return token_file.write_and_read(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@registry.add("op4_repeated_bytes")
def op4_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), with_kept=False)


@registry.add("op9_line_dedup", line_dedup.SQL)
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), "n_removed_lines")


@registry.add("op5_embedding_near_dedup")
def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@registry.add("op1_licence_scan", license_scan.SQL)
def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, folder, "documents"))


@registry.add("op7_ngram_jaccard_join")
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_documents(table(spark, folder, "documents"))


@registry.add("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = periodic_runs.with_cycles(table(spark, folder, "documents"))
    return periodic_runs.digest(periodic_runs.find_runs(rows, with_text=False))


@registry.add("op12_prefix_trie", prefix_trie.SQL)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, folder, "conversations"))
    return prefix_trie.trie_report(*prefix_trie.rebuilt(turns))


@registry.add("op13_benchmark_matches", decontaminate.SQL)
def op13_benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
