import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import EDGES, WORD, frame
from trackframe.llm import periodic_runs
from trackframe.llm.periodic_runs import WaveletTree, digest, find_runs, numbered, runs_of, with_cycles


def plain_runs(words, shortest=12):
    """Every maximal stretch of every period, longest periods last; the first period of a stretch is its smallest."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_cycle(doc, words):
    h = zlib.crc32(b"%d" % doc) if doc is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(doc, text):
    words = plain_cycle(doc, WORD.findall(text or ""))
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc, len(runs), *longest, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def periodic_words(r):
    words = [str(r.randrange(r.choice([1, 2, 3, 30]))) for _ in range(r.randint(0, 120))]
    for _ in range(r.randint(0, 4)):
        a, p = r.randint(0, len(words)), r.randint(1, 20)
        words = words[:a] + words[a : a + p] * r.randint(1, 6) + words[a + r.randint(0, 3) :]
    return words


def special_texts():
    f, g = ["a"], ["a", "b"]
    for _ in range(9):
        f, g = g, g + f
    return [
        ["a"] * 40 + ["b"] + ["a"] * 40, ["a", "b"] * 30 + ["b", "a"] * 30, g, ["a"] * 11, ["a"] * 12, ["a", "b"] * 6,
        list("abcdefg") * 2, list("abcdef") * 2, list("abcde") * 2 + ["a"], ["x"] * 12 + ["y"] * 12 + ["x"] * 12,
        ["p", "q"] * 9 + ["p"] + ["p", "q"] * 9,
    ]


def test_runs_equal_brute_force():
    r = random.Random(2)
    for _ in range(60):
        texts = [[w.encode() for w in periodic_words(r)] for _ in range(8)] + [[w.encode() for w in r.choice(special_texts())]]
        symbols, starts = numbered(texts)
        start, length, period = runs_of(symbols)
        of = np.searchsorted(starts, start, "right") - 1
        for i, words in enumerate(texts):
            got = [(int(s - starts[i]), int(n), int(q)) for s, n, q, o in zip(start, length, period, of) if o == i]
            assert got == plain_runs(words)


def test_wavelet_tree_answers_range_successors():
    r = np.random.default_rng(3)
    values = r.permutation(200)
    tree = WaveletTree(values, 8)
    low = r.integers(0, 200, 500)
    high = np.minimum(low + r.integers(0, 60, 500), 200)
    x = r.integers(0, 201, 500)
    want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(low, high, x)]
    assert tree.successor(low, high, x).tolist() == want


def test_query_rows_equal_brute_force(spark):
    r = random.Random(4)
    rows = [(i, r.choice([" ", "\n", " \t"]).join(periodic_words(r))) for i in range(150)]
    rows += [(1000 + i, " ".join(w)) for i, w in enumerate(special_texts())] + EDGES + [(5, rows[5][1]), (5, rows[5][1])]
    docs = frame(spark, rows, clash=("runs", "_w", "_h", "n_words", "collapsed"))
    out = digest(find_runs(with_cycles(docs), with_text=False))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted((plain_row(*x) for x in rows), key=str)


def test_slices_of_any_size_and_the_collapsed_text(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 64)
    rows = [(1, "go " + "on and " * 8 + "stop"), (2, None), (None, "x " * 12), (3, "a b c")]
    out = find_runs(frame(spark, rows)).orderBy(F.col("doc_id").asc_nulls_first())
    got = [(x.doc_id, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in out.collect()]
    assert got == [
        (None, 12, [(0, 12, 1)], "x"), (1, 18, [(1, 16, 2)], "go on and stop"), (2, 0, [], ""), (3, 3, [], "a b c"),
    ]
    assert find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        find_runs(frame(spark, []), shortest=8)


def test_very_long_texts(spark):
    """2 MB of prose, and 200,000 words that go round, of one and of 30,000 words."""
    r = random.Random(5)
    prose = " ".join(f"w{r.randrange(50_000)}" for _ in range(330_000))
    ring = [f"v{i}" for i in range(30_000)]
    rows = [(1, prose), (2, "x " * 200_000), (3, " ".join(ring * 6 + ring[:20_000])), (4, "a " * 100_000 + "b " + "a " * 100_000)]
    out = {x.doc_id: [tuple(y) for y in x.runs] for x in find_runs(frame(spark, rows)).collect()}
    assert out == {1: [], 2: [(0, 200_000, 1)], 3: [(0, 200_000, 30_000)], 4: [(0, 100_000, 1), (100_001, 100_000, 1)]}
