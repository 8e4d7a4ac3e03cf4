import random

import numpy as np
import pytest

from tests.llm.brute import EDGES, frame, jaccard
from trackframe.llm import jaccard_join as join


def edited(n, seed):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(300)]
    common = [" ".join(r.choice(words) for _ in range(14)) for _ in range(4)]
    texts, rows = [], []
    for i in range(n):
        if r.random() < 0.35 or not texts:
            text = " ".join(r.choice(words) for _ in range(r.choice([2, 3, 4, 5, 8, 30, 60, 120])))
        else:
            x = r.choice(texts[-60:]).split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                x[r.randrange(len(x))] = r.choice(words)
            text = " ".join(x + x[: r.randint(0, 5)] if r.random() < 0.2 else x)
        if r.random() < 0.3:
            text += "\n" + r.choice(common)
        texts.append(text)
        rows.append((i * 7 % 503, text if r.random() < 0.9 else text.upper()))
    return rows


@pytest.mark.parametrize(("width", "percent", "least", "held"), [(4, 85, 64, 50_000), (5, 80, 3, 10)])
def test_components_equal_brute_force(spark, monkeypatch, width, percent, least, held):
    """Also with many tokens at the end of the order, and buckets cut into parts."""
    monkeypatch.setattr(join, "OFTEN_LEAST", least)
    monkeypatch.setattr(join, "HELD", held)
    rows = edited(300, 5) + EDGES
    got = join.near_documents(frame(spark, rows, clash=("n", "g", "cells", "token")), width, percent).collect()
    assert sorted(map(tuple, got), key=str) == jaccard(rows, width, percent)


def test_groups_whose_prefixes_agree_but_not_all_members(spark):
    """Sets that differ only behind the prefix form one group; far members must still be told apart."""
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(base[:30] + [f"x{i}y{k}" for k in range(i % 4 * 3)] + base[30:])) for i in range(40)]
    got = join.near_documents(frame(spark, rows), 4, 85).collect()
    assert sorted(map(tuple, got), key=str) == jaccard(rows, 4, 85)


def test_a_member_behind_the_leader_of_a_group_links_in_a_bucket_of_two(spark):
    """Two linked texts share their prefix; a third links with the one that does not lead the group."""
    rows, seed = [], 0
    while len(rows) < 9:
        one = [f"s{seed}b{i}" for i in range(60)]
        two = one[:40] + [f"s{seed}x"] + one[41:]
        three = two[:10] + [f"s{seed}y"] + two[11:]
        a, b = (join.prefix(x, x[:0], 85).tolist() for x in join.shingle_sets([" ".join(t).encode() for t in (one, two)], 4))
        if a == b:
            rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate((one, two, three))]
        seed += 1
    got = sorted(map(tuple, join.near_documents(frame(spark, rows), 4, 85).collect()), key=str)
    assert got == jaccard(rows, 4, 85) and {c for _, _, c in got} == {0, 3, 6}


def test_pairs_of_a_large_cluster_of_edited_copies_do_not_grow_with_its_square(spark, monkeypatch):
    """Copies with edits of their own rarely link with the first one; others join them before all pairs are made."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(300):
        x = list(base)
        for k in r.sample(range(150), 2 if i else 4):
            x[k] = f"e{i}k{k}"
        rows.append((i, " ".join(x)))
    made, real = [], join.across

    def counted(*args):
        out = real(*args).distinct()
        made.append(out.count())
        return out

    monkeypatch.setattr(join, "across", counted)
    got = sorted(map(tuple, join.near_documents(frame(spark, rows), 4, 85).collect()), key=str)
    assert got == jaccard(rows, 4, 85)
    assert made[0] < 10 * len(rows)


def test_bounds_never_drop_a_link():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(r.integers(0, 1 << 63, r.integers(1, 3000)).astype(np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.95], r.integers(0, 1 << 63, r.integers(1, 60)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        links = 100 * both >= 85 * (len(a) + len(b) - both)
        one = lambda x: join.cells(x)[None, :]
        assert not links or join.may_link(np.array([len(a)]), np.array([len(b)]), one(a), one(b), 85)[0]
        assert not links or join.may_link_finely(len(a), len(b), join.fine_cells(a), join.fine_cells(b), 85)
        often = np.sort(r.choice(a, min(len(a), 20), replace=False))
        assert not links or len(np.intersect1d(join.prefix(a, often, 85), join.prefix(b, often, 85)))


def test_empty_table_and_repeated_rows(spark):
    assert join.near_documents(frame(spark, [])).count() == 0
    got = join.near_documents(frame(spark, [(3, "a b c d e"), (3, "a b c d e"), (1, "a b c d e"), (2, "q")])).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1), (2, 1, 2), (3, 2, 1), (3, 2, 1)]
