import hashlib
import math
from collections import defaultdict

import pytest

from tests.llm.brute import WORD
from trackframe.llm import mixing


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, source string" + extra)


def sizes(rows):
    out = defaultdict(int)
    for _, text, source in rows:
        out[source] += len(WORD.findall(text or ""))
    return {k: v for k, v in out.items() if v}


def make(seed=1):
    rows = []
    for s, (source, n) in enumerate([("big", 60), ("mid", 25), ("tiny", 6), (None, 9), ("empty", 3)]):
        rows += [(1000 * s + i, " ".join(["w"] * (0 if source == "empty" else 1 + i * 7 % 13)), source) for i in range(n)]
    return rows + [(5000, None, "big"), (5001, "", "tiny")]


def plain(rows, budget, exponent, seed=42):
    """Copies (id, source, epoch, start) by sorting each source in memory."""
    total = sizes(rows)
    out = []
    for source, tokens in total.items():
        take = math.floor(round(tokens**exponent / sum(t**exponent for t in total.values()), 12) * budget)
        for epoch in range(math.ceil(take / tokens)):
            at = epoch * tokens
            own = [(hashlib.md5(f"{seed}|{epoch}|{d}".encode()).hexdigest(), d, len(WORD.findall(t or ""))) for d, t, s in rows if s == source]
            for _, doc, n in sorted(own):
                if n and at + n <= take:
                    out.append((doc, source, epoch, at))
                at += n
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_window", [4096, 2])
def test_mixture_equals_sorting_in_memory(spark, monkeypatch, rows_per_window):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows_per_window)
    rows = make()
    budget = sum(sizes(rows).values())
    out = mixing.mix(docs(spark, rows), max_repeats=2.5, block_words=100)
    got = out.collect()
    totals = sizes(rows)
    repeats = lambda a: max(budget * t**a / sum(x**a for x in totals.values()) / t for t in totals.values())
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if repeats(mid) <= 2.5 else (mid, high)
    assert 0 < high < 1
    assert sorted(((r.doc_id, r.source, r.epoch, r.start) for r in got), key=str) == plain(rows, budget, high)
    # No source is used more often than allowed, and blocks hold it in its share.
    for source, tokens in totals.items():
        used = sum(r.n_tokens for r in got if r.source == source)
        assert used <= 2.5 * tokens + 1e-6
    blocks = {r.block for r in got}
    assert blocks == set(range(-(-budget // 100)))


def test_entropy_target_is_met_and_not_exceeded(spark):
    totals = spark.createDataFrame([("a", 10, 900), ("b", 5, 80), ("c", 1, 20)], "_source string, docs long, tokens long")
    a = mixing.find_exponent(totals, 1000, 0.8, None)
    weights = [t**a for t in (900, 80, 20)]
    shares = [w / sum(weights) for w in weights]
    assert -sum(p * math.log(p) for p in shares) == pytest.approx(0.8 * math.log(3), abs=1e-9)
    assert mixing.find_exponent(totals, 1000, 0.1, None) == 1.0


def test_limits_that_cannot_bind_or_be_met(spark):
    totals = spark.createDataFrame([("a", 10, 100), ("b", 5, 100)], "_source string, docs long, tokens long")
    assert mixing.find_exponent(totals, 200, None, 1.0) == 0.0
    with pytest.raises(ValueError):
        mixing.find_exponent(totals, 300, None, 1.0)
    with pytest.raises(ValueError):
        mixing.mix(docs(spark, make()))


def test_edges_clashing_columns_and_rows_that_come_back(spark):
    rows = make() + [(None, "q q", "mid"), (None, "r r r", "mid"), (3, "w", "big"), (3, "w", "big")]
    clashing = docs(spark, [(*r, "x", "y") for r in rows], ", epochs string, _source string")
    back = mixing.mixed_rows(clashing, max_repeats=2.5)
    assert back.columns == clashing.columns
    got = back.collect()
    assert {r.doc_id for r in got} <= {r[0] for r in rows} and all(r.epochs == "x" for r in got)
    assert {r.text for r in got if r.doc_id is None} == {"q q", "r r r"}
    assert mixing.mix(docs(spark, []), max_repeats=2.0).count() == 0
    assert mixing.mix(docs(spark, [(1, None, "a"), (2, "", None)]), target_entropy=0.9).count() == 0


def test_rows_of_one_id_keep_the_limit_and_share_no_key(spark):
    """A third of the rows shares an id, as many have none, some of them with equal texts."""
    rows = [(7, f"hot {i % 700} " + "w " * (i % 5), "a") for i in range(3000)] + [(None, f"none {i}", "a") for i in range(3000)]
    rows += [(i, "u " * (1 + i % 4), "b" if i % 9 else "c") for i in range(100, 3100)]
    total = sizes(rows)
    df = docs(spark, rows).repartition(6)
    mixed = mixing.mix(df, max_repeats=1.25)
    keys = mixed.groupBy("source", "epoch", "order_key").count()
    assert keys.where("count > 1").count() == 0
    used = {r.source: r.n for r in mixed.groupBy("source").agg({"n_tokens": "sum"}).toDF("source", "n").collect()}
    assert all(used[s] <= 1.25 * total[s] + 1e-6 for s in used) and sum(used.values()) >= 0.99 * sum(total.values())
    back = sizes([tuple(r) for r in mixing.mixed_rows(df, max_repeats=1.25).collect()])
    assert all(back[s] <= 1.25 * total[s] + 1e-6 for s in back) and sum(back.values()) >= 0.99 * sum(total.values())


def test_plan_is_native(spark):
    plan = mixing.mix(docs(spark, make()), max_repeats=2.5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
