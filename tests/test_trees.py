"""Growers of trees against a plain recursive tree, and ensembles grown in different ways against each other."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from trackframe.plans import training, trees
from trackframe.plans.tree_models import DeepForest, SoftmaxBoosting, TreeModel
from trackframe.plans.trees import Ensemble, Growing, Rule, binned, boost, grow_forest, grow_here, held_out_accuracy, spread, to_bins

NAN = float("nan")


def worth(s, rule):
    if rule.measure == "gradient":
        return s[0] ** 2 / (s[1] + trees.GRID) / trees.GRID
    n = sum(s)
    if rule.measure == "gini":
        return sum(c * c for c in s) / n if n else 0
    return sum(c * np.log(c) for c in s if c) - (n * np.log(n) if n else 0)


def plain_tree(bins, stats, rule, depth=0):
    """Nested (feature, bin, missing left, left, right), or the sums of a leaf."""
    total = stats.sum(0)
    best = None
    size = lambda s: s[2] if rule.measure == "gradient" else s.sum()
    pure = size(total) < 2 if rule.measure == "gradient" else total.max() == total.sum()
    for f in range(bins.shape[1]) if depth < rule.depth and not pure else ():
        column = bins[:, f]
        for b in sorted(set(column[column > 0].tolist())):
            known = (column > 0) & (column <= b)
            for side in (True, False):
                left = known | ((column == 0) & side)
                ok = all(size(stats[x].sum(0)) > 0 for x in (left, ~left))
                if rule.measure == "gradient":
                    ok = ok and all(stats[x, 1].sum() >= trees.GRID for x in (left, ~left))
                gain = worth(stats[left].sum(0), rule) + worth(stats[~left].sum(0), rule) - worth(total, rule)
                if ok and gain > rule.least_gain and (best is None or gain > best[0] + 1e-9 * max(abs(best[0]), 1)):
                    best = (gain, f, b, side, left)
    if best is None:
        return total.tolist()
    _, f, b, side, left = best
    return f, b, plain_tree(bins[left], stats[left], rule, depth + 1), plain_tree(bins[~left], stats[~left], rule, depth + 1)


def nested(grown, node=0):
    if grown.feature[node] < 0:
        return grown.stats[node].tolist()
    return int(grown.feature[node]), int(grown.bin[node]), nested(grown, grown.left[node]), nested(grown, grown.right[node])


@pytest.mark.parametrize("measure", ["entropy", "gini", "gradient"])
def test_trees_equal_a_plain_recursive_tree(measure):
    r = np.random.default_rng(3)
    for width, depth in ((3, 20), (5, 3), (1, 6), (2, 0)):
        bins = r.integers(0, 7, (300, width)).astype(np.uint8)
        label = (bins.sum(1).astype(int) + r.integers(0, 2, 300)) % 3
        rule = Rule(measure, depth)
        if measure == "gradient":
            stats = np.stack([np.round((label - 1) * trees.GRID * r.random(300)), np.full(300, trees.GRID / 4), np.ones(300)], 1)
            grown = Growing(rule, 3, 1, spread(np.arange(1)))
            grown.stats[0] = stats.sum(0)
            grow_here(grown, np.zeros(300, int), bins, None, stats)
        else:
            stats = np.eye(3)[label]
            grown = Growing(rule, 3, 1, spread(np.arange(1)))
            grown.stats[0] = stats.sum(0)
            grow_here(grown, np.zeros(300, int), bins, label, np.ones(300))
        assert nested(grown) == plain_tree(bins, stats, rule)


def table(spark, n=3000):
    """Three classes: two by a rule over two features, one where a third feature is missing."""
    rows = spark.range(0, n, 1, 4).select("id", *[(F.abs(F.xxhash64("id", F.lit(i))) % 12).cast("double").alias(f"f{i}") for i in range(4)])
    rows = rows.withColumn("f1", F.when(F.col("id") % 7 != 0, F.col("f1")))
    label = F.when(F.col("f1").isNull(), 2).when((F.col("f0") > 3) & (F.col("f2") <= 5), 1).otherwise(0)
    x = F.array(*[F.col(f"f{i}") for i in range(4)])
    return rows.select("id", label.alias("label"), x.alias("x"), (F.col("id") % 3).alias("fold"), array_to_vector(F.transform(x, lambda v: F.coalesce(v, F.lit(NAN)))).alias("features"))


def arrays(groups):
    """Trees without the numbers of their nodes, root by root."""

    def shown(g, node):
        if g.feature[node] < 0:
            return tuple(np.round(g.value[node], 9).tolist())
        return int(g.feature[node]), int(g.bin[node]), bool(g.missing_left[node]), shown(g, g.left[node]), shown(g, g.right[node])

    return [shown(g, t) for g in groups for t in range(g.trees)]


def test_levels_on_spark_and_subtrees_in_tasks_give_the_same_trees(spark, monkeypatch):
    data = binned(table(spark), "x", "label", 3)
    found = {}
    for local in (1 << 15, 400, 10):
        monkeypatch.setattr(trees, "LOCAL_ROWS", local)
        forest = grow_forest(data, 5, 12, share=0.5)
        found[local] = arrays(forest), arrays(boost(data, 2, depth=3)[0])
    assert found[1 << 15] == found[400] == found[10]
    monkeypatch.setattr(trees, "DENSE_CELLS", 1)
    assert arrays(grow_forest(data, 5, 12, share=0.5)) == found[400][0]
    assert arrays(grow_forest(data, 5, 12, share=0.5, at_once=2)) == found[400][0]


def test_forest_cut_off_at_a_depth_is_the_forest_of_that_depth(spark):
    data = binned(table(spark), "x", "label", 3, F.col("fold"))
    deep = Ensemble(data.edges, 3, grow_forest(data, 4, 9, share=0.5, held_out=1), False)
    accuracy = held_out_accuracy(data, deep, 1, [1, 3, 9])
    values = np.random.default_rng(1).integers(-1, 13, (200, 4)).astype(float)
    for depth in (1, 3, 9):
        own = Ensemble(data.edges, 3, grow_forest(data, 4, depth, share=0.5, held_out=1), False)
        cut = deep.truncated(depth)
        scores = [sum(e.scores(g, values) for g in e.packed()) for e in (own, cut)]
        assert np.allclose(*scores)
        assert held_out_accuracy(data, own, 1, [depth])[depth] == accuracy[depth]
    assert accuracy[9] > 0.99 > accuracy[1]


def test_rounds_seen_on_the_way_equal_separate_fits(spark):
    data = binned(table(spark, 900), "x", "label", 3, F.col("fold"))
    groups, seen = boost(data, 12, depth=2, held_out=0, checks=[1, 4])
    assert sorted(seen) == [1, 4, 10, 12]
    for rounds in (1, 4):
        own, end = boost(data, rounds, depth=2, held_out=0)
        assert arrays(own) == arrays(groups[:rounds]) and end == {rounds: seen[rounds]}


def test_boosting_stops_on_held_out_rows_and_keeps_the_best_rounds(spark):
    data = binned(table(spark, 900), "x", "label", 3, F.col("fold"))
    groups, seen = boost(data, 100, depth=3, held_out=2, patience=15)
    best = min(k for k, v in seen.items() if v == max(seen.values()))
    assert len(groups) == best and max(seen) <= best + 30 and max(seen.values()) == 1.0


def test_models_survive_storage_and_missing_features(spark, tmp_path):
    rows = table(spark, 900)
    for number, estimator in enumerate((DeepForest(3, trees=5, depth=40), SoftmaxBoosting(3, rounds=4, depth=4, rate=0.3))):
        model = estimator.fit(rows)
        model.write().overwrite().save(f"{tmp_path}/{number}")
        model.write().overwrite().save(f"{tmp_path}/{number}")
        loaded = TreeModel.load(f"{tmp_path}/{number}")
        both = model.transform(rows).select("id", "label", "prediction").join(loaded.transform(rows).select("id", F.col("prediction").alias("again")), "id")
        assert both.where("prediction <> again").count() == 0
        assert both.where("prediction = label").count() > 870
        odd = spark.createDataFrame([(1, None), (2, [NAN] * 4), (3, [1e9, -1e9, float("inf"), 0.0])], "id long, x array<double>")
        odd = odd.select("id", F.when(F.col("x").isNotNull(), array_to_vector(F.coalesce("x", F.array(*[F.lit(0.0)] * 4)))).alias("features"))
        got = {x.id: x.prediction for x in model.transform(odd).collect()}
        assert got[1] is None and got[2] == 2.0 and got[3] is not None


def test_bins_of_few_many_and_no_values(spark):
    values = spark.range(3000).select(F.array(F.col("id").cast("double"), (F.col("id") % 3).cast("double"), F.lit(None).cast("double"), F.lit(1.0)).alias("x"), F.lit(0).alias("label"))
    data = binned(values, "x", "label", 1)
    assert [len(e) for e in data.edges][1:] == [2, 0, 0] and 200 < len(data.edges[0]) < 255
    assert to_bins(np.array([[0.0, 1.0, NAN, 1.0], [2999.0, 5.0, 3.0, NAN]]), data.edges).tolist()[0] == [1, 2, 0, 1]
    assert data.rows.select(F.max(F.octet_length("bins"))).first()[0] == 4
    with pytest.raises(ValueError, match="no rows"):
        binned(values.limit(0), "x", "label", 1)


def test_a_hot_value_and_a_constant_label(spark):
    """A third of all rows are alike; a single class leaves only roots."""
    rows = table(spark).withColumn("x", F.when(F.col("id") % 3 == 0, F.array(*[F.lit(1.0)] * 4)).otherwise(F.col("x")))
    data = binned(rows.withColumn("label", F.lit(0)), "x", "label", 2)
    assert arrays(grow_forest(data, 2, 5)) == [(1.0, 0.0)] * 2
    data = binned(rows.withColumn("label", F.when(F.col("id") % 3 == 0, 0).otherwise(1)), "x", "label", 2, F.col("fold") * 0)
    forest = Ensemble(data.edges, 2, grow_forest(data, 3, 32, share=1.0), False)
    assert held_out_accuracy(data, forest, 0, [32])[32] > 0.99


def test_default_forest_is_as_deep_as_asked():
    assert training.random_forest(3, 3).settings["depth"] == 32
    assert training.random_forest(3, 3, depth=38).settings == {"trees": 1000, "depth": 38, "share": 0.2, "measure": "entropy"}
