import numpy as np
import pytest
from pyspark.sql import functions as F

from trackframe import train as trainer
from trackframe.operators.knn import knn1, knn_lsh
from trackframe.plans import training
from trackframe.spec import FeatureSpec, Vocabulary

SPEC = FeatureSpec(numbers=("p", "q"), matrix=("r",), extra=("noise",), classes=("c1",))
CLASSES = Vocabulary({"1": (1,), "2": (2,), "3": (3,)})


def brute(train, test):
    out = {}
    for qid, q in test:
        d = [(((np.array(q) - np.array(x)) ** 2).sum(), tid, label) for tid, label, x in train]
        best = min(d)
        out[qid] = (best[1], best[2])
    return out


def frames(spark, train, test):
    return (
        spark.createDataFrame([(i, l, [float(v) for v in x]) for i, l, x in train], "id long, label string, x array<double>"),
        spark.createDataFrame([(i, [float(v) for v in x]) for i, x in test], "id long, x array<double>"),
    )


@pytest.mark.parametrize("pivots,block", [(1, 4096), (20, 50), (None, 7)])
def test_exact_neighbours_equal_brute_force(spark, pivots, block):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 20, (6, 4))
    # A third of the rows are copies of one point, and grid points give many ties.
    train = [(i, str(i % 3), centres[i % 6] + rng.normal(0, 1, 4)) for i in range(200)]
    train += [(1000 - i, "copy", centres[0]) for i in range(150)]
    train += [(2000 + i, "grid", np.array([i % 4, i // 4 % 4, 0, 0])) for i in range(64)]
    test = [(i, centres[i % 6] + rng.normal(0, 3, 4)) for i in range(60)] + [(100, centres[0]), (101, np.array([0.5, 0.5, 0, 0]))]
    got = {r.qid: (r.neighbour, r.label) for r in knn1(*frames(spark, train, test), "id", "label", "id", "x", pivots, block).collect()}
    assert got == brute(train, test)
    assert got[100] == (851, "copy")


def test_hashed_neighbours_lose_no_row_and_mostly_agree(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 5, (8, 6))
    train = [(i, str(i % 8), centres[i % 8] + rng.normal(0, 0.3, 6)) for i in range(300)]
    test = [(i, centres[i % 8] + rng.normal(0, 0.3, 6)) for i in range(80)] + [(999, np.full(6, 1e3))]
    got = {r.qid: r.label for r in knn_lsh(*frames(spark, train, test), "id", "label", "id", "x", bucket_length=4.0).collect()}
    want = {k: v[1] for k, v in brute(train, test).items()}
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) / len(want) > 0.95


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        c = 1 + i % 3
        p, q, r = rng.normal([0, 4, 8][c - 1], 0.5), rng.normal([9, 1, 5][c - 1], 0.5), rng.normal(c, 0.2)
        rows.append((float(p), float(q), float(r), float(rng.normal()), c))
    path = str(tmp_path_factory.mktemp("data") / "set")
    spark.createDataFrame(rows, "p double, q double, r double, noise double, c1 int").coalesce(3).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def parts(spark, dataset):
    return trainer.split_dataset(spark, dataset, SPEC, CLASSES)


@pytest.mark.parametrize("kind,params", [
    ("gb", {"trees": 3, "depth": 3}), ("rf", {"trees": 8, "depth": 5}), ("dense", {"hidden": [8], "epochs": 60}), ("knn", {}),
    ("merge", {"hidden": [8], "epochs": 60}),
])
def test_models_learn_and_survive_storage(spark, parts, tmp_path, kind, params):
    model = trainer.fit(kind, parts["train"], SPEC, CLASSES, **params)
    scored = trainer.score(kind, model, parts["test"], SPEC)
    counts = training.evaluate(scored)
    assert training.accuracy(counts).first().accuracy > 0.9
    path = training.save(model, kind, str(tmp_path), counts, parts["train"].count())
    assert path.rsplit("/", 1)[1].startswith(f"{kind}-2")
    loaded_kind, loaded = training.load(spark, path)
    assert loaded_kind == kind
    answers = lambda m: {r.row_id: r.predicted_label for r in trainer.score(kind, m, parts["test"], SPEC).collect()}
    assert answers(model) == answers(loaded)


def test_windowed_network(spark, dataset):
    parts = trainer.split_windows(spark, dataset, 3, SPEC, CLASSES)
    sizes = {n: p.count() for n, p in parts.items()}
    assert sizes == {"train": 270, "dev": 15, "test": 15}
    model = trainer.fit("ts", parts["train"], SPEC, CLASSES, hidden=[8], epochs=60)
    scaler = model.stages[0]
    assert scaler.getInputCols()[:4] == ["p_0", "q_0", "r_0", "p_1"]
    assert scaler.getOrDefault(scaler.low)[0] == scaler.getOrDefault(scaler.low)[3]
    assert training.accuracy(training.evaluate(trainer.score("ts", model, parts["test"]))).first().accuracy > 0.9
    with pytest.raises(ValueError):
        trainer.split_windows(spark, dataset, 0, SPEC, CLASSES)


def test_split_covers_the_dataset(parts):
    seen = [r.row_id for p in parts.values() for r in p.select("row_id").collect()]
    assert len(seen) == len(set(seen)) == 900


def test_fitted_models_carry_no_training_plan(parts):
    model = trainer.fit("rf", parts["train"], SPEC, CLASSES, trees=2, depth=2)
    assert not [s for s in model.stages if getattr(s, "hasSummary", False)]


def test_grids_are_whole():
    sizes = {k: {p: len(v) for p, v in grid.items()} for k, grid in trainer.GRIDS.items()}
    assert sizes == {"gb": {"trees": 4, "depth": 5, "rate": 3}, "rf": {"depth": 5}, "dense": {"epochs": 16}}
    assert trainer.GRIDS["rf"]["depth"] == [26, 29, 32, 35, 38]


def test_training_stops_when_dev_no_longer_improves(spark, parts):
    pipeline = training.label_pipeline("dense", ["p", "q"], CLASSES.labels, params={"hidden": [6], "epochs": 400})
    model, scores = pipeline.fit_with_dev(parts["train"], parts["dev"], patience=20, step=10)
    assert len(scores) < 40 and max(scores) > 0.9 and max(scores[-2:]) <= max(scores[:-2])
    assert training.accuracy(training.evaluate(model.transform(parts["test"]))).first().accuracy > 0.9


def test_trees_take_missing_features_and_networks_refuse_them(spark, parts):
    holes = parts["train"].withColumn("q", F.when(F.col("row_id") % 3 > 0, F.col("q"))).withColumn("p", F.when(F.col("row_id") % 5 > 0, F.col("p")).otherwise(float("nan")))
    for kind, params in (("rf", {"trees": 8, "depth": 6}), ("gb", {"trees": 3, "depth": 4})):
        model = training.label_pipeline(kind, ["p", "q", "r"], CLASSES.labels, params=params).fit(holes)
        assert model.transform(holes).where("predicted_label is null").count() == 0
        assert training.accuracy(training.evaluate(model.transform(holes))).first().accuracy > 0.9
    with pytest.raises(Exception, match="(?i)null|nan"):
        training.label_pipeline("dense", ["p", "q"], CLASSES.labels, params={"hidden": [4], "epochs": 5}).fit(holes)


def test_neighbours_of_rows_that_cannot_be_compared(spark):
    nan, inf = float("nan"), float("inf")
    train = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "b", [5.0, 5.0]), (3, "c", [nan, 1.0]), (4, "d", None), (5, "e", [1.0])], "id long, label string, x array<double>")
    test = spark.createDataFrame([(10, [1.0, 0.0]), (11, None), (12, [nan, 0.0]), (13, [1.0]), (14, [None, 1.0]), (15, [inf, 1.0]), (16, [4.0, 5.0])], "id long, x array<double>")
    want = {10: "a", 16: "b", 11: None, 12: None, 13: None, 14: None, 15: None}
    assert {r.qid: r.label for r in knn1(train, test, "id", "label", "id", "x").collect()} == want
    assert {r.qid: r.label for r in knn_lsh(train, test, "id", "label", "id", "x", bucket_length=2.0).collect()} == want
    with pytest.raises(ValueError):
        knn1(train.where("id > 2").withColumn("x", F.lit(None).cast("array<double>")), test, "id", "label", "id", "x")


def test_queries_meet_each_block_once_where_cells_do_not_prune(spark):
    rng = np.random.default_rng(8)
    train = [(i, "x", rng.normal(size=64)) for i in range(300)]
    test = [(i, rng.normal(size=64)) for i in range(60)]
    found = knn1(*frames(spark, train, test), "id", "label", "id", "x", block_rows=150)
    assert {r.qid: (r.neighbour, r.label) for r in found.collect()} == brute(train, test)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "cell" in plan and plan.count("MapInArrow") == 0  # nothing was routed to cells


def test_clusters_in_many_dimensions_are_pruned(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 3, (40, 48))
    train = [(i, str(i % 40), centres[i % 40] + rng.normal(0, 0.2, 48)) for i in range(4000)]
    test = [(i, centres[i % 40] + rng.normal(0, 0.2, 48)) for i in range(200)] + [(500, rng.normal(0, 3, 48))]
    found = knn1(*frames(spark, train, test), "id", "label", "id", "x", compared=True).collect()
    assert {r.qid: (r.neighbour, r.label) for r in found} == brute(train, test)
    assert sum(r.compared for r in found) < 0.1 * len(train) * len(test)


def test_probing_further_buckets_reaches_the_promised_recall(spark):
    rng = np.random.default_rng(10)
    train = [(i, str(i), rng.normal(size=24)) for i in range(1500)]
    test = [(i, rng.normal(size=24)) for i in range(150)]
    want = brute(train, test)
    share = {}
    for recall in (0.5, 0.97):
        got = knn_lsh(*frames(spark, train, test), "id", "label", "id", "x", bucket_length=0.2, tables=3, recall=recall).collect()
        share[recall] = sum(r.neighbour == want[r.qid][0] for r in got) / len(test)
    assert share[0.97] >= 0.95 and share[0.97] >= share[0.5] >= 0.4


def test_reduction_and_encoding(spark, parts):
    reduced = training.label_pipeline("rf", ["p", "q", "r"], CLASSES.labels, components=2, params={"trees": 4, "depth": 4})
    assert training.accuracy(training.evaluate(reduced.fit(parts["train"]).transform(parts["test"]))).first().accuracy > 0.9
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "kind string, v double")
    rows = training.subset_encoder(["kind"], ["v"]).fit(df).transform(df).collect()
    assert [list(r.encoded) for r in rows] == [[1, 0, 1], [0, 1, 2], [1, 0, 3]]


@pytest.mark.parametrize("kind,grid,params", [
    ("rf", {"depth": [1, 4]}, {"trees": 4}),
    ("gb", {"trees": [1, 5], "depth": [2, 3]}, {}),
    ("dense", {"epochs": [1, 60]}, {"hidden": [8]}),
])
def test_grid_search_lists_every_combination(parts, kind, grid, params):
    rows = parts["train"]
    if kind != "dense":
        rows = rows.withColumn("q", F.when(F.col("row_id") % 10 > 0, F.col("q")))  # missing features are searched too
    table, best = training.grid_search(rows, ["p", "q"], "label", CLASSES.labels, kind, grid, ["_file", "_blk", "_pos"], ["_file", "_blk"], params=params)
    rows = {r.params: r for r in table.collect()}
    wanted = {f"depth={d}, trees={t}" for d in (2, 3) for t in (1, 5)} if kind == "gb" else {f"{n}={v}" for n, values in grid.items() for v in values}
    assert set(rows) == wanted and set(best) == set(grid)
    top = rows[", ".join(f"{n}={v}" for n, v in sorted(best.items()))]
    assert top.mean_score == max(r.mean_score for r in rows.values()) > 0.9 and top.sd_score < 0.2


def test_trainer_arguments():
    assert trainer.parse(["-d", "x", "-m", "knn"]).model == "knn"
    assert trainer.model_features("dense")[-1] == "rCov9" and trainer.model_features("gb")[-1] == "sCov36"
