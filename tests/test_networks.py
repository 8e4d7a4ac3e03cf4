"""Gradients against differences, training in pieces, stopping and storage."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from trackframe.plans import networks, training
from trackframe.plans.networks import DenseNetwork, NetworkModel, Settings, Weights, fit_network, gradient, train_piece


def test_gradients_equal_differences():
    r = np.random.default_rng(4)
    weights = Weights.drawn((3, 5, 4, 3), 1)
    weights.flat += r.normal(0, 0.1, len(weights.flat))
    x, label = r.normal(size=(7, 3)), r.integers(0, 3, 7)
    for keep in ([], [(r.random((7, 5)) > 0.3) / 0.7, None], [None, (r.random((7, 4)) > 0.5) / 0.5]):
        _, g = gradient(weights, x, label, keep)
        for i in r.choice(len(g), 40, replace=False):
            losses = []
            for step in (1e-6, -1e-6):
                moved = Weights(weights.sizes, weights.flat.copy())
                moved.flat[i] += step
                losses.append(gradient(moved, x, label, keep)[0])
            assert abs((losses[0] - losses[1]) / 2e-6 - g[i]) < 1e-5


def test_default_layers():
    network = training.dense_network(52, 6)
    assert network.sizes == (52, *[34] * 10, 14, 6) and network.settings.dropped == (1, 3, 5, 7)
    assert (network.settings.epochs, network.settings.batch, network.settings.dropout) == (1000, 512, 0.1)


def table(spark, n):
    rows = spark.range(0, n, 1, 3).select("id", *[((F.abs(F.xxhash64("id", F.lit(i))) % 1000) / 500 - 1).alias(f"f{i}") for i in range(2)])
    label = F.when(F.col("f0") > 0.2, 2).when(F.col("f1") > F.col("f0"), 1).otherwise(0)
    return rows.select("id", label.alias("label"), array_to_vector(F.array("f0", "f1")).alias("features"), (F.col("id") % 4).alias("part"))


SETTINGS = Settings((16, 16), 40, dropout=0.05, dropped=(0,), rate=0.01)


def test_one_piece_equals_one_machine_and_steps_do_not_matter(spark):
    rows, pieces = DenseNetwork(2, 3, SETTINGS).pieces(table(spark, 600))
    assert pieces == 1
    whole, _ = fit_network(rows, pieces, (2, 16, 16, 3), SETTINGS, step=40)
    parts, _ = fit_network(rows, pieces, (2, 16, 16, 3), SETTINGS, held_out=9, step=7)
    assert np.allclose(whole.flat, parts.flat)
    found = rows.toArrow()
    x = np.array(found.column("x").to_pylist())
    start = Weights.drawn((2, 16, 16, 3), 42).flat
    state, steps = train_piece(np.stack([start, 0 * start, 0 * start]), 0, (2, 16, 16, 3), x, found.column("label").to_numpy(), SETTINGS, [(42, e, 0) for e in range(40)])
    assert np.allclose(state[0], whole.flat) and steps == 40 * -(-600 // 18)


def test_many_pieces_are_averaged_and_learn(spark, monkeypatch):
    monkeypatch.setattr(networks, "PIECE_ROWS", 300)
    rows, pieces = DenseNetwork(2, 3, SETTINGS).pieces(table(spark, 3000), "part")
    assert pieces == 10
    weights, seen = fit_network(rows, pieces, (2, 16, 16, 3), SETTINGS, held_out=3, step=20)
    assert sorted(seen) == [20, 40] and seen[40] > 0.95
    again, _ = fit_network(rows.repartition(5, "piece").sortWithinPartitions("piece"), pieces, (2, 16, 16, 3), SETTINGS, held_out=3, step=40)
    assert np.isfinite(weights.flat).all() and np.isfinite(again.flat).all()


def test_epochs_seen_on_the_way_equal_separate_fits(spark):
    rows, pieces = DenseNetwork(2, 3, SETTINGS).pieces(table(spark, 800), "part")
    _, seen = fit_network(rows, pieces, (2, 8, 3), SETTINGS, held_out=1, step=40, checks=[10, 25])
    for epochs in (10, 25):
        own = Settings(SETTINGS.hidden, epochs, SETTINGS.dropout, SETTINGS.dropped, rate=SETTINGS.rate)
        assert fit_network(rows, pieces, (2, 8, 3), own, held_out=1, step=epochs)[1] == {epochs: seen[epochs]}


def test_stopping_keeps_the_best_and_storage_keeps_the_weights(spark, tmp_path):
    rows = table(spark, 800)
    network = DenseNetwork(2, 3, Settings((8,), 500, rate=0.02))
    model, seen = network.fit_with_dev(rows.where("part < 3"), rows.where("part = 3"), patience=20, step=5)
    assert len(seen) < 100 and max(seen.values()) > 0.9
    model.write().overwrite().save(f"{tmp_path}/m")
    loaded = NetworkModel.load(f"{tmp_path}/m")
    assert np.array_equal(loaded.weights.flat, model.weights.flat)
    right = loaded.transform(rows.where("part = 3")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right == max(seen.values())


def test_missing_features_and_empty_tables_are_refused(spark):
    rows = table(spark, 50)
    hole = rows.withColumn("features", array_to_vector(F.array(F.lit(float("nan")), F.lit(1.0))))
    network = DenseNetwork(2, 3, SETTINGS)
    with pytest.raises(ValueError, match="NaN"):
        network.fit(hole)
    with pytest.raises(ValueError, match="no rows"):
        network.fit(rows.limit(0))
    with pytest.raises(Exception, match="NaN"):
        network.fit(rows).transform(hole).collect()
