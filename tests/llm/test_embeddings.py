import numpy as np
import pytest

from tests.llm.brute import union_find
from trackframe.llm import embedding_dedup as dedup
from trackframe.llm.common import components

NAN, INF = float("nan"), float("inf")


def brute(rows, threshold=0.93):
    usable = {
        i: np.array(x, float) for i, (v, label, x) in enumerate(rows)
        if v is not None and label is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)
    }
    links = [0] * len(rows)
    parent, find = union_find(len(rows))
    for i, a in usable.items():
        for j, b in usable.items():
            if i < j and rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i in usable:
        low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    comp = [low[find(i)] if i in usable else r[0] for i, r in enumerate(rows)]
    return sorted(((r[0], links[i], comp[i], r[0] == comp[i]) for i, r in enumerate(rows)), key=str)


def vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = r.normal(size=dim) if i % 3 == 0 else np.array(rows[r.integers(0, i)][2]) + (0 if i % 5 == 0 else r.normal(size=dim) * r.uniform(0.05, 0.4))
        rows.append((int(i * 37 % 601), int(i % 2), [float(np.float32(v)) for v in x]))
    return rows


@pytest.mark.parametrize("tile", [7, 2048])
def test_links_and_components_equal_brute_force(spark, tile):
    rows = vectors(240, 20, 1)
    first = rows[0][2]
    rows += [
        (900, 0, None), (901, None, first), (902, 0, [0.0] * 20), (903, 0, [NAN] + [1.0] * 19), (904, 0, [INF] * 20), (None, 0, first),
        (905, 0, [1.0, None] + [0.0] * 18), (906, 0, first[:8]), (907, 0, first[:8]), (908, 0, []), (909, 0, [2 * x for x in first]),
        (910, 1, [1e30] * 20), (911, 1, [1e-30] * 20),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, tile string")
    rows = [tuple(r)[:3] for r in df.collect()]
    got = dedup.near_duplicates(df, tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_pairs_at_the_threshold_and_text_labels(spark):
    # Cosines of exactly 0.6 and just below it; the same vectors under another label don't link.
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [3.0, 4.0]), (3, "b", [1.0, 0.0]), (4, "b", [3.0, 4.0 + 1e-9]), (5, "a", [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    assert sorted(map(tuple, dedup.near_duplicates(df, 0.6).collect()), key=str) == brute(rows, 0.6)


def test_empty_table(spark):
    assert dedup.near_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 260)]}}
