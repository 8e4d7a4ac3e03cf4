import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import EDGES, frame
from trackframe.llm import decontaminate
from trackframe.llm.decontaminate import digest, drop_contaminated, find_matches, longest_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_matches(docs, items, window):
    """(id, words, spans, items) of every row."""
    windows = {}
    for item, text in items:
        words = plain_words(text)
        k = min(window, len(words))
        for i in range(len(words) - k + 1) if k else ():
            windows.setdefault(tuple(words[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, own = plain_words(text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if (found := windows.get(tuple(words[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    own |= found
        starts = [i for i in sorted(hit) if i - 1 not in hit]
        spans = [(s, next(j for j in range(s, len(words) + 1) if j not in hit) - s) for s in starts]
        out.append((doc, len(words), spans, sorted(str(x) for x in own - {None})))
    return sorted(out, key=str)


def plain_longest(docs, items, window):
    best = {}
    for item, text in items:
        words = plain_words(text)
        for s in range(len(words)):
            for doc, other in docs:
                own = plain_words(other)
                for t in range(len(own)):
                    n = 0
                    while s + n < len(words) and t + n < len(own) and words[s + n] == own[t + n]:
                        n += 1
                    if n >= min(window, len(words)):
                        key = (-n, s, doc is None, doc or 0, t)
                        best[item] = min(best.get(item, key), key)
    return sorted(((str(i), -k[0], k[1], None if k[2] else k[3], k[4]) for i, k in best.items()), key=str)


def passages(seed, n, window):
    """Items over few words, so that windows repeat, and documents that hold parts of them."""
    r = random.Random(seed)
    items = [(i, " ".join(r.choice(["a", "b", "C", "d4", "é", "你"]) for _ in range(r.choice([1, 2, window - 1, window, 3 * window])))) for i in range(14)]
    items += [(3, "x, Y. z"), (20, items[-1][1]), (21, None), (22, " ,. "), (23, ""), (20, items[-1][1]), (24, "İx ſ"), (25, "only once here")]
    docs = []
    for i in range(n):
        text = " ".join(r.choice(["a", "B", "c", "D4", "e", "É"]) for _ in range(r.randint(0, 12)))
        for _ in range(r.randint(0, 2)):
            words = (r.choice(items)[1] or "").split()
            a = r.randint(0, len(words))
            text += r.choice([" ", "-", "\n"]) + ", ".join(words[a : a + r.randint(0, 20)]).upper()
        docs.append((i * 7 % 301, text))
    return docs + EDGES + [(5, "x y Z"), (5, "x y Z"), (None, "x y z, x y z")], items


def collected(out):
    return sorted(((x.doc_id, x.n_words, [tuple(y) for y in x.spans], x["items"]) for x in out.collect()), key=str)


@pytest.mark.parametrize("window", [4, 10])
def test_matches_equal_brute_force(spark, window):
    docs, items = passages(window, 200, window)
    got = find_matches(frame(spark, docs, clash=("spans", "items", "item_id")), frame(spark, items, "item_id", clash=("doc_id", "id")), window)
    assert collected(got) == plain_matches(docs, items, window)


def test_blocks_and_shards_of_any_size_find_the_same(spark, monkeypatch):
    docs, items = passages(6, 120, 5)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 80)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 100)
    monkeypatch.setattr(decontaminate, "CHAIN", 2)
    items = items[:12]
    got = find_matches(frame(spark, docs).repartition(3), frame(spark, items, "item_id"), 5)
    assert collected(got) == plain_matches(docs, items, 5)


def test_an_item_without_an_id_hits_but_is_not_listed(spark):
    out = find_matches(frame(spark, [(1, "say one two three now")]), frame(spark, [(None, "One, two; three!")], "item_id")).first()
    assert [tuple(x) for x in out.spans] == [(1, 3)] and out["items"] == []


def test_longest_matches_equal_brute_force(spark, monkeypatch):
    docs, items = passages(8, 60, 4)
    items = list(dict(reversed(items)).items())
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 300)
    got = longest_matches(frame(spark, docs), frame(spark, items, "item_id"), 4)
    assert sorted(map(tuple, got.collect()), key=str) == plain_longest(docs, items, 4)


def test_dropped_documents_and_kept_columns(spark):
    docs, items = passages(9, 100, 10)
    table = frame(spark, docs, clash=("spans", "items", "N_words", "_spans"))
    got = drop_contaminated(table, frame(spark, items, "item_id"))
    assert got.columns == table.columns
    clean = [(d, t) for (d, t) in docs if not plain_matches([(d, t)], items, 10)[0][2]]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(clean, key=str)


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b"), (2, None)]), frame(spark, [], "item_id")
    assert collected(find_matches(docs, items)) == [(1, 2, [], []), (2, 0, [], [])]
    assert drop_contaminated(docs, items).count() == 2
    assert find_matches(frame(spark, []), frame(spark, [(1, "a")], "item_id")).count() == 0
    assert longest_matches(docs, items).count() == 0
    row = digest(find_matches(docs, items)).where("doc_id = 1").first()
    assert row.n_hit == 0 and not row.contaminated and row.items_sha256.startswith("e3b0c442")


def test_very_long_texts_and_a_passage_that_everyone_shares(spark):
    r = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(40))
    long = " ".join(f"w{r.randrange(50_000)}" for _ in range(300_000))
    docs = [(0, long + " " + passage + " " + long[:1000])] + [(i, f"head{i} " + passage + " tail") for i in range(1, 3001)]
    items = [(i, passage if i < 300 else f"q{i} r s") for i in range(400)] + [(400, "same " * 30)]
    docs.append((3001, "same " * 20_000))
    out = find_matches(frame(spark, docs).repartition(4), frame(spark, items, "item_id"))
    spans = out.select("doc_id", F.explode("spans").alias("s"), F.size("items").alias("k")).select("doc_id", "s.start", "s.length", "k")
    got = {x.doc_id: (x.start, x.length, x.k) for x in spans.collect()}
    assert got == {0: (300_000, 40, 300), 3001: (0, 20_000, 1)} | {i: (1, 40, 300) for i in range(1, 3001)}
