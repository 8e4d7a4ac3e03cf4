import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import EDGES, WORD, frame
from trackframe.llm import quality_model as model
from trackframe.llm import quality_rules as rules
from trackframe.llm.words import dup_lines, repeat_words

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in model.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(got[x.doc_id].predicted, x.quality) for x in labels.collect() if got[x.doc_id].held_out]
    assert len(held) > 900 and sum(p == q for p, q in held) / len(held) > 0.98
    clean = [p for p, q in held if q == 1]
    assert sum(clean) / len(clean) > 0.98


def test_scores_do_not_depend_on_other_columns_or_order(spark):
    texts = [(i, ("good words here " if i % 2 else "bad### bad### bad### ") * (3 + i % 5)) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(3, None, 0), (None, 1, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    rows = texts + EDGES
    a = model.classify(frame(spark, rows, clash=("score", "y", "x")), labels).collect()
    b = model.classify(frame(spark, rows[::-1]).repartition(3), labels).collect()
    key = lambda r: str(tuple(r))
    assert sorted(a, key=key) == sorted(b, key=key) and len(a) == len(rows)
    assert all(r.predicted == r.doc_id % 2 for r in a if r.doc_id is not None and r.doc_id < 80)
    assert all(not r.held_out for r in a if r.doc_id is None)


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in model.classify(frame(spark, EDGES), none).collect()} == {0.5}
    assert model.classify(frame(spark, []), none).count() == 0
    one = spark.createDataFrame([(903, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in model.classify(frame(spark, EDGES), one).collect())


def test_trees_walked_together_equal_one_row_at_a_time():
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    trees = model.fit_trees(x, y, trees=12, depth=3)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    got = trees.score(x)
    assert np.allclose(got, [walk(row) for row in x]) and ((got > 0.5) == y).mean() > 0.95
    assert len(trees.score(x[:0])) == 0


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    docs = frame(spark, [(i, "w " * (1 + i % 2 * 9)) for i in range(200)])
    assert model.fit_quality(docs, labels, max_rows=10, trees=1) is not None


def test_a_repeated_id_is_learnt_once(spark, monkeypatch):
    """Labels without a document and 3,000 rows of one id: the fit gets one row for each id that has a document."""
    seen = []
    monkeypatch.setattr(model, "fit_trees", lambda x, y, **_: seen.append((len(x), y.tolist())))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(4, 1)], "doc_id long, quality int")
    docs = frame(spark, [(i, "w " * (1 + i % 7)) for i in range(100)] + [(4, f"more {i}") for i in range(3000)])
    model.fit_quality(docs, labels)
    learnt = spark.range(100).where(~model.held_out("id")).count()
    assert seen[0][0] == learnt
    model.fit_quality(docs, labels, max_rows=20)
    assert seen[1][0] == 20


def test_statistics_of_odd_texts_are_finite():
    x = model.statistics(pa.array([t for _, t in EDGES], pa.string()))
    assert x.shape == (len(EDGES), len(model.FEATURES)) and np.isfinite(x).all()
    assert model.statistics(pa.array([], pa.string())).shape == (0, len(model.FEATURES))


def brute_repeat(words, width=3):
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(width)}
    return len(covered)


def test_base_figures_equal_brute_force(spark):
    r = np.random.default_rng(4)
    rows = EDGES + [(i, "".join(r.choice(list("aab \n#|é!."), r.integers(0, 400)))) for i in range(60)]
    got = {(x.doc_id, x.text): x for x in rules.clean_lines(frame(spark, rows, clash=("kept", "n_words"))).collect()}
    assert len(got) <= len(rows)
    by_id = {x.doc_id: x for x in got.values() if x.doc_id is not None}
    for doc, text in rows:
        if doc is None:
            continue
        words, lines = WORD.findall(text or ""), (text or "").split("\n")
        worded = [x for x in lines if WORD.search(x)]
        x = by_id[doc]
        repeated = brute_repeat(words)
        assert (x.n_words, x.word_chars) == (len(words), sum(map(len, words)))
        assert x.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert x.n_dup_lines == len(worded) - len(set(worded))
        assert x.n_repeat_words == repeated
        assert x.base_failed == (len(words) < 50 or 100 * repeated > 50 * len(words))
        assert not (x.base_failed and x.kept)


def test_repeated_windows_with_overlap():
    assert repeat_words([b"a"] * 4) == 4 and repeat_words([b"a"] * 3) == 0
    assert repeat_words(b"a b c x a b c".split()) == 6
    assert dup_lines([b"a", b" ", b"a", b" ", b"a"]) == 2


@pytest.mark.parametrize(("line", "fails"), [
    ("A plain sentence with words.", False), ("a### b### c###", True), ("BUY NOW!! CHEAP!!", True), ("Really! Yes.", False),
    ("home | news | about | more", True), ("one bar | in a line of many words", False), ("We use cookies here.", True), ("w w w w w", True), ("one two one two", False),
])
def test_line_rules(line, fails):
    raw = line.encode()
    assert rules.line_fails(raw, raw.split()) is fails


def test_a_text_that_loses_too_much_is_rejected_and_others_are_cleaned(spark):
    good = "\n".join(" ".join(f"{w}{i}" for w in ("some", "different", "words", "make", "this", "line")) + "." for i in range(12))
    bad = "\n".join(f"MENU {i} | HOME {i} | NEWS {i} | MORE {i}" for i in range(12))
    out = {r.doc_id: r for r in rules.clean_lines(frame(spark, [(1, good + "\nAll rights reserved."), (2, good + "\n" + bad)])).collect()}
    assert out[1].kept and out[1].text == good and out[1].n_failed_lines == 1
    assert not out[2].kept and not out[2].base_failed and out[2].text == good
    assert rules.clean_lines(frame(spark, [])).count() == 0
