"""The pipeline, stage by stage, against plain versions of what each stage decides."""

import os

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.brute import EDGES, jaccard, repeated_lines
from trackframe.llm import quality_model
from trackframe.llm.queries import vocabulary
from trackframe.session import stage

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@needs_tables
def test_stages_follow_their_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = stage(pipeline.keep_quality(spark, docs, FOLDER))
    accepted = {r.doc_id for r in quality_model.classify(docs, labels).where("predicted = 1").collect()}
    assert good.columns == docs.columns and {d for d, _ in rows_of(good)} == accepted and good.count() == len(accepted)
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(clean - accepted) <= 0.02 * len(clean)

    lines = stage(pipeline.drop_lines(spark, good, FOLDER))
    want = [(d, t) for d, t, n in repeated_lines(rows_of(good), 3) if not n or t.strip()]
    assert lines.columns == docs.columns and sorted(rows_of(lines), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    alone = stage(pipeline.drop_near_copies(spark, lines, FOLDER))
    kept = {d for d, _, c in jaccard(rows_of(lines), 5, 80) if d == c}
    assert alone.columns == docs.columns and sorted(d for d, _ in rows_of(alone)) == sorted(kept)

    mixed = stage(pipeline.mix_sources(spark, alone, FOLDER))
    assert mixed.columns == docs.columns and set(rows_of(mixed)) <= set(rows_of(alone))
    per_source = {}
    for r in alone.collect():
        per_source[r.source] = per_source.get(r.source, 0) + len(r.text.split())
    used = {}
    for r in mixed.collect():
        used[r.source] = used.get(r.source, 0) + len(r.text.split())
    assert all(used[s] <= pipeline.MAX_REPEATS * n for s, n in per_source.items() if s in used)

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    counts = sorted((d, len(library.encode(t, add_special_tokens=False).ids)) for d, t in rows_of(mixed))
    assert sorted((r.doc_id, r.n_tokens) for r in pipeline.encode(spark, mixed, FOLDER).collect()) == counts


@needs_tables
def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, function in pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER))
    assert sorted(pipeline.run(spark, FOLDER).collect()) == sorted(docs.collect())


@needs_tables
@pytest.mark.parametrize("rows", [EDGES, []])
def test_stages_take_hard_rows_and_clashing_columns(spark, rows):
    schema = COLUMNS + ", score string, kept_id string, packs string, epochs string"
    docs = spark.createDataFrame([(d, t, None, None if d and d % 2 else "s", None if t is None else len(t), *"abcd") for d, t in rows], schema)
    for name, function in pipeline.STAGES:
        out = stage(function(spark, docs, FOLDER))
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert {(r.doc_id, r.score, r.epochs) for r in out.collect()} <= {(r.doc_id, r.score, r.epochs) for r in docs.collect()}
        docs = out


def test_rows_of_one_id_are_copies_of_each_other(spark):
    """A third of the rows shares an id, as many have none: one row of each group of copies stays."""
    text = " ".join(f"w{i}" for i in range(80))
    near = text.replace("w40", "other")
    rows = [(1, text)] * 300 + [(None, near)] * 300 + [(7, near), (8, "a text of its own"), (None, "alone here too"), (None, "alone here too"), (9, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0, "x") for d, t in rows], COLUMNS + ", row_key string")
    out = pipeline.drop_near_copies(spark, docs.repartition(5), FOLDER)
    assert out.columns == docs.columns and sorted(rows_of(out), key=str) == sorted([(1, text), (8, "a text of its own"), (9, None), (None, "alone here too")], key=str)
