import random

import pytest
from pyspark.sql import functions as F

from trackframe.operators import position
from trackframe.operators.logs import log_records, phase_split
from trackframe.session import attach
from trackframe.operators.position import cut_points, neighbour, number_rows, running_totals


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [(rng.choice("aaab"), i, rng.random()) for i in rng.sample(range(1000), 400)]
    return data, spark.createDataFrame(data, "g string, k long, v double").withColumn("b", F.floor(F.col("k") / 64))


def by_group(data):
    out = {}
    for g, k, v in sorted(data, key=lambda r: r[1]):
        out.setdefault(g, []).append((k, v))
    return out


def test_number_rows(rows):
    data, df = rows
    got = {(r.g, r.k): (r._rn, r._n) for r in number_rows(df, ["g"], ["k"], ["b"]).collect()}
    for g, items in by_group(data).items():
        for i, (k, _) in enumerate(items):
            assert got[g, k] == (i + 1, len(items))


def test_cut_points(rows):
    data, df = rows
    cuts = cut_points(df, ["g"], ["k"], ["b"], {"none": F.lit(0), "half": F.expr("_n div 2"), "all": F.col("_n")})
    got = {r.g: r for r in cuts.collect()}
    for g, items in by_group(data).items():
        assert got[g].none is None
        assert got[g].half.k == items[len(items) // 2 - 1][0]
        assert got[g]["all"].k == items[-1][0]


def test_neighbour_and_running_totals(rows):
    data, df = rows
    near = neighbour(df, ["g"], ["k"], ["b"], F.col("k"), "prev")
    near = neighbour(near, ["g"], ["k"], ["b"], F.col("k"), "next", step=1)
    got = {(r.g, r.k): (r.prev, r.next) for r in near.collect()}
    sums = running_totals(df, ["g"], ["k"], ["b"], {"s": F.col("v"), "c": F.lit(1)})
    sums = {(r.g, r.k): (r.s, r.c) for r in sums.collect()}
    for g, items in by_group(data).items():
        total = 0.0
        for i, (k, v) in enumerate(items):
            total += v
            before = items[i - 1][0] if i else None
            after = items[i + 1][0] if i + 1 < len(items) else None
            assert got[g, k] == (before, after)
            assert sums[g, k][1] == i + 1
            assert sums[g, k][0] == pytest.approx(total)


def read_sequentially(lines, patterns):
    state, current, out = 0, [], []
    for text in lines:
        for i, p in enumerate(patterns):
            if p in text and state == i:
                current.append(float(text.split(":")[2].strip()))
                state += 1
        if state == 3:
            out.append(tuple(current))
            state, current = 0, []
    return out


@pytest.mark.parametrize("seed", range(4))
def test_log_records_equal_a_sequential_reader(spark, seed):
    rng = random.Random(seed)
    # Logs of different habits: well formed, random, mostly backwards, repeating, two patterns in a line.
    words = ["Alpha", "Beta", "Gamma", "noise", "Alpha Beta", "Gamma Beta", "Alpha Gamma", "Alpha Beta Gamma"]
    logs = {
        "formed": ["Alpha", "Beta", "Gamma", "noise"] * 40,
        "random": [rng.choice(words[:4]) for _ in range(300)],
        "backwards": (["Alpha", "Gamma", "Beta"] * 60) + ["Alpha"],
        "mixed": [rng.choice(words) for _ in range(300)],
        "runs": [w for _ in range(60) for w in [rng.choice(words[:3])] * rng.randint(1, 6)],
        "backwards-broken": [w for _ in range(30) for w in rng.choice([["Gamma", "Beta", "Alpha"], ["Beta"], ["Alpha", "Beta"]])],
    }
    patterns = ["Alpha", "Beta", "Gamma"]
    lines = [(name, i, f"{i}: {w}: {i}.5") for name, log in logs.items() for i, w in enumerate(log)]
    df = spark.createDataFrame(lines, "log string, k long, value string")
    for width in (1, 7, 1000):
        bucketed = df.withColumn("b", F.floor(F.col("k") / width))
        records = log_records(bucketed, patterns, ["a", "b_", "c"], ["log"], ["k"], ["b"])
        got = {}
        for r in sorted(records.collect(), key=lambda r: (r.log, r.record)):
            got.setdefault(r.log, []).append((r.a, r.b_, r.c))
        for name in logs:
            want = read_sequentially([v for n, _, v in lines if n == name], patterns)
            assert got.get(name, []) == want, (name, width)


def test_stray_line_and_marker(spark):
    text = [
        "1: Gamma seen early: 5", "2: Alpha: 1.5", "2: Beta: 2.5", "note", "2: Gamma: 10",
        "3: Alpha: 3", "3: Alpha: 99", "3: Beta: 4", "3: Gamma: 7.5", "4: Alpha: 5", "4: Beta: 6", "4: Gamma: 20", "5: Alpha: 1",
    ]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "f string, k long, value string")
    df = df.withColumn("b", F.floor(F.col("k") / 4))
    records = log_records(df, ["Alpha", "Beta", "Gamma"], ["x", "y", "z"], ["f"], ["k"], ["b"])
    out = phase_split(records, ["f"], "record", "z", 7.5).orderBy("record").collect()
    assert [(r.x, r.y, r.z, r.phase) for r in out] == [(1.5, 2.5, 10.0, 1), (3.0, 4.0, 7.5, 2), (5.0, 6.0, 20.0, 2)]


def test_joins_without_broadcast_give_the_same_rows(spark):
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as k")
    small = spark.range(0, 40).selectExpr("id as k", "id * 2 as v")
    for how in ("inner", "left", "left_anti", "left_semi"):
        plain, salted = (sorted(tuple(r) for r in attach(rows, small, ["k"], how, n).fillna(-1).collect()) for n in (100, 5))
        assert plain == salted, how


@pytest.mark.parametrize("level", [20, 100])
def test_sums_of_sums_give_the_same_positions(spark, rows, monkeypatch, level):
    """Tiny buckets, and levels of a few rows: the same results, and no range larger than a level."""
    data, df = rows
    sizes = []
    real = position._ranges

    def watched(table, group, bucket):
        found, part = real(table, group, bucket)
        if part:
            sizes.append(found.groupBy(part).count().agg(F.max("count")).first()[0])
        else:
            sizes.append(found.count())
        return found, part

    monkeypatch.setattr(position, "LEVEL_ROWS", level)
    monkeypatch.setattr(position, "_ranges", watched)
    df = df.withColumn("b", F.floor(F.col("k") / 3))
    numbered = {(r.g, r.k): (r._rn, r._n) for r in number_rows(df, ["g"], ["k"], ["b"]).collect()}
    near = neighbour(neighbour(df, ["g"], ["k"], ["b"], F.col("k"), "prev"), ["g"], ["k"], ["b"], F.col("k"), "next", step=1)
    near = {(r.g, r.k): (r.prev, r.next) for r in near.collect()}
    sums = {(r.g, r.k): r.s for r in running_totals(df, ["g"], ["k"], ["b"], {"s": F.col("k")}).collect()}
    cuts = {r.g: r.half.k for r in cut_points(df, ["g"], ["k"], ["b"], {"half": F.expr("_n div 2")}).collect()}
    for g, items in by_group(data).items():
        ks = [k for k, _ in items]
        assert cuts[g] == ks[len(ks) // 2 - 1]
        for i, k in enumerate(ks):
            assert numbered[g, k] == (i + 1, len(ks))
            assert near[g, k] == (ks[i - 1] if i else None, ks[i + 1] if i + 1 < len(ks) else None)
            assert sums[g, k] == sum(ks[: i + 1])
    assert max(sizes) <= level


def test_more_groups_than_a_level_has_rows(spark, monkeypatch):
    """Each group keeps a row on every level, so their number must not ask for one level more."""
    levels = []
    real = position._ranges

    def counted(table, group, bucket):
        levels.append(1)
        assert len(levels) <= 12, "levels without end"
        return real(table, group, bucket)

    monkeypatch.setattr(position, "LEVEL_ROWS", 20)
    monkeypatch.setattr(position, "_ranges", counted)
    data = [(g, k) for g in range(50) for k in range(2)] + [(99, k) for k in range(120)]
    df = spark.createDataFrame(data, "g long, k long").withColumn("b", F.col("k"))
    got = sorted(tuple(r) for r in number_rows(df, ["g"], ["k"], ["b"]).select("g", "k", "_rn", "_n").collect())
    assert got == sorted((g, k, k + 1, 120 if g == 99 else 2) for g, k in data)
    levels.clear()
    near = neighbour(df, ["g"], ["k"], ["b"], F.col("k"), "prev").select("g", "k", "prev").collect()
    assert {(r.g, r.k): r.prev for r in near} == {(g, k): k - 1 if k else None for g, k in data}
