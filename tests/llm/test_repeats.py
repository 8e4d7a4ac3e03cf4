import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import EDGES, frame, repeated_bytes, repeated_lines
from trackframe.llm import line_dedup, suffix_dedup


def patched_texts(n, seed, parts, glue):
    r = random.Random(seed)
    out = []
    for i in range(n):
        text = ""
        for _ in range(r.randint(0, 6)):
            x = r.choice(parts)
            a = r.randint(0, max(len(x) - 5, 1))
            text += x[a : a + r.randint(5, 250)] + glue(r)
        out.append((i * 7 % 121, text))
    return out


@pytest.mark.parametrize(("depth", "gram"), [(100, 32), (20, 8), (5, 5)])
def test_repeated_bytes_equal_brute_force(spark, depth, gram):
    r = random.Random(3)
    parts = ["".join(r.choice("ab é") for _ in range(400)) for _ in range(8)]
    rows = patched_texts(100, 3, parts, lambda r: "".join(r.choice("xyz") for _ in range(r.randint(0, 9))))
    rows += [r for r in EDGES if r[0] is not None] + [(None, parts[0]), (950, parts[0]), (951, "a" * 99), (952, "a" * 100)]
    out = suffix_dedup.remove_repeats(frame(spark, rows, clash=("doc", "packs", "n_bytes")), depth, gram)
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.sha2("kept", 256).alias("again")).collect()
    assert sorted((tuple(x[:5]) for x in got), key=str) == repeated_bytes(rows, depth)
    assert all(x.again == x.kept_sha256 for x in got)


def test_blocks_of_any_size_give_the_same_bytes(spark, monkeypatch):
    r = random.Random(4)
    parts = ["".join(r.choice("ab ") for _ in range(300)) for _ in range(4)]
    rows = patched_texts(40, 5, parts, lambda r: "-")
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    got = suffix_dedup.remove_repeats(frame(spark, rows), 30, 10, with_kept=False).collect()
    assert sorted(map(tuple, got), key=str) == repeated_bytes(rows, 30)


def test_rows_that_repeat_id_and_text_are_judged_alike(spark):
    text = " ".join(map(str, range(100, 150)))[:150]
    out = suffix_dedup.remove_repeats(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 150)]
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("run", "gram"), [(3, 2), (2, 1), (4, 4), (5, 2), (1, 1)])
def test_repeated_lines_equal_brute_force(spark, run, gram):
    r = random.Random(6)
    lines = ["line %d." % i for i in range(25)] + ["", "  ", " line 3. "]
    rows = [(i * 7 % 121, "\n".join(r.choice(lines[:9] if i % 3 else lines) for _ in range(r.randint(0, 14)))) for i in range(120)]
    rows += [r for r in EDGES if r[0] is not None] + [(None, rows[5][1])]
    out = line_dedup.drop_repeated_lines(frame(spark, rows, clash=("doc", "ver", "packs")), run, gram)
    assert out.columns == ["doc_id", "text", "doc", "ver", "packs", "n_removed_lines"]
    got = sorted(((x.doc_id, x.text, x.n_removed_lines) for x in out.collect()), key=str)
    assert got == repeated_lines(rows, run)


def test_long_lines_repeat_alone(spark):
    """A line of 50 words, and two lines that hold as many, go without a third."""
    r = random.Random(8)
    passage = " ".join(r.choice("abcdefgh") + str(i) for i in range(60))
    left, right = passage[: len(passage) // 2].strip(), passage[len(passage) // 2 :].strip()
    rows = [(i, f"own {i}\n{passage}\nend {i}") for i in range(20)] + [(20 + i, f"{left}\n\n {right}") for i in range(20)]
    rows += [(50, passage), (51, passage[:-1]), (52, f"{passage}\n{passage}"), (53, " ".join(passage.split()[:49])), (54, " ".join(passage.split()[:49])), (None, passage)]
    rows += [(60, " ".join(passage.split()[:50])), (61, "x\n" + " ".join(passage.split()[:50])), (62, "q\n" * 20_000 + passage)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows).repartition(7)).collect()
    got = sorted(((x.doc_id, x.text, x.n_removed_lines) for x in out), key=str)
    assert got == repeated_lines(rows, 3)
    by_id = {d: n for d, _, n in got}
    assert by_id[0] == 0 and all(by_id[i] == 1 for i in range(1, 20)) and by_id[20] == 0 and by_id[21] == 2
    assert (by_id[52], by_id[53], by_id[54], by_id[61]) == (2, 0, 0, 1)


@pytest.mark.parametrize("least", [3, 7])
def test_runs_by_words_equal_brute_force(spark, least):
    r = random.Random(9)
    lines = ["a", "b c", "d e f", "g h i j", "k l m n o p q", ""]
    rows = [(i * 7 % 201, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9)))) for i in range(200)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows), 4, 2, least_words=least).collect()
    assert sorted(((x.doc_id, x.text, x.n_removed_lines) for x in out), key=str) == repeated_lines(rows, 4, least)


def test_many_rows_without_an_id_are_told_apart(spark):
    """A few thousand null ids: 16 bits of a hash can't tell them apart; an equal start is decided by the text's hash."""
    head = [(1, "first shared line\nsecond shared line\nthird shared line")]
    rows = head + [(None, f"own {i} a\nown {i} b\nown {i} c\n" * (1 + i % 3) + (head[0][1] if i % 2 else "end")) for i in range(3000)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text, r.n_removed_lines) for r in out), key=str) == repeated_lines(rows, 3)
    shared = "".join(chr(97 + i * i % 23) for i in range(60))
    rows = [(i, f"{i:05d}" + shared) for i in range(1, 3000, 2)]
    rows += [(None, "#" * (2 + i % 5) + (f"{i:05d}" + shared if i % 2 else hashlib.sha256(b"%d" % i).hexdigest())) for i in range(3000)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), 40, 8, with_kept=False).collect()
    assert sorted(map(tuple, got), key=str) == repeated_bytes(rows, 40)


def test_equal_places_of_rows_without_an_id_are_repeats(spark):
    rows = [(None, "a a\nb b\nc c\n" + f"x{i}") for i in range(2000)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows)).collect()
    assert sorted(r.n_removed_lines for r in out) == [0] + [3] * 1999


def test_repeated_rows_and_empty_tables_of_lines(spark):
    text = "a a\nb b\nc c\nd d"
    out = line_dedup.drop_repeated_lines(frame(spark, [(1, text), (1, text), (2, text + "\ne")])).collect()
    assert sorted((r.doc_id, r.n_removed_lines, r.text) for r in out) == [(1, 0, text), (1, 0, text), (2, 4, "e")]
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(frame(spark, []), run=2, gram=3)
