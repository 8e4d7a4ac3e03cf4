import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackframe.functions.columns import argmax, divide_by_row_max, nan_to_null, one_hot, reshape
from trackframe.operators import sample, stats
from trackframe.operators.clean import at_least, exclude_when, nonzero, sigma_filter, sigma_filter_single_pass
from trackframe.operators.scale import MinMaxColumns, MinMaxColumnsModel, minmax_scale
from trackframe.operators.sequence import seq_split, truncate_multiple
from trackframe.plans.training import class_folds


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows."""
    rng = random.Random(3)
    data = [(i, rng.choice("aaaaaaab" + "c" * (i % 2)), rng.gauss(10, 3), float(rng.randint(0, 4))) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, label string, v double, w double").repartition(7)
    return pd.DataFrame(data, columns=["id", "label", "v", "w"]), df.withColumn("b", F.floor(F.col("id") / 100))


def ids(df):
    return {r.id for r in df.select("id").collect()}


def test_sample_and_erase_complement_each_other(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(sample, "BUCKET_ROWS", 10)  # several hex digits, many buckets
    quota = {"a": 700, "b": 10**9, "c": 0, "z": 4}
    taken = ids(sample.sample_n_per_class(df, "label", quota, ["id"]))
    left = ids(sample.erase_n(df, "label", quota, ["id"]))
    by_label = pdf.groupby("label").id.apply(set)
    assert len(taken & by_label["a"]) == 700 and taken >= by_label["b"] and not taken & by_label["c"]
    assert taken | left == set(pdf.id) and not taken & left
    assert taken == ids(sample.sample_n_per_class(df.repartition(3), "label", quota, ["id"]))
    assert taken != ids(sample.sample_n_per_class(df, "label", quota, ["id"], seed=7))


def test_splits_are_disjoint_stable_and_sized(skewed):
    pdf, df = skewed
    approx = {r.id: r.split for r in sample.random_split(df, ["id"]).collect()}
    assert approx == {r.id: r.split for r in sample.random_split(df.repartition(16), ["id"]).collect()}
    assert set(approx) == set(pdf.id) and 0.87 < sum(s == "train" for s in approx.values()) / 3000 < 0.93
    exact = pd.Series({r.id: r.split for r in sample.random_split_exact(df, ["id"]).collect()}).value_counts()
    assert exact.to_dict() == {"train": 2700, "dev": 150, "test": 150}


def test_seq_split_keeps_time_order_and_whole_windows(skewed):
    pdf, df = skewed
    got = seq_split(df, "label", ["id"], ["b"], steps=4).toPandas()
    for label, rows in got.sort_values("id").groupby("label"):
        sizes = rows.split.value_counts()
        assert list(rows.split) == sorted(rows.split, key=["train", "dev", "test"].index)
        train = int(len(rows) * 0.9) // 4 * 4
        assert sizes["train"] == train and sizes["dev"] == int((len(rows) - train) * 0.5) // 4 * 4
    assert (truncate_multiple(df, ["label"], ["id"], ["b"], 7).groupBy("label").count().toPandas()["count"] % 7 == 0).all()


def test_class_folds_are_consecutive_and_even(skewed):
    got = class_folds(skewed[1], "label", ["id"], ["b"], 3).toPandas().sort_values("id")
    for _, rows in got.groupby("label"):
        assert list(rows.fold) == sorted(rows.fold)
        assert rows.fold.value_counts().max() - rows.fold.value_counts().min() <= 1


def test_profile_equals_pandas(spark, skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(stats, "HISTOGRAM_BUCKETS", 4)  # several rounds
    wide = df.withColumn("far", F.when(F.col("id") == 0, 1e300).when(F.col("id") == 1, -1e308).otherwise(F.col("v")))
    got = {(r.label, r.feature, r.percentile): r for r in stats.profile(wide, "label", ["v", "w", "far"]).collect()}
    pdf = pdf.assign(far=np.where(pdf.id == 0, 1e300, np.where(pdf.id == 1, -1e308, pdf.v)))
    for label, rows in pdf.groupby("label"):
        for c in ("v", "w", "far"):
            for p in stats.PROFILE_PERCENTILES:
                r = got[label, c, p]
                assert r.value == pytest.approx(np.percentile(rows[c], p * 100), rel=1e-9), (label, c, p)
                assert (r.n, r.lowest, r.highest) == (len(rows), rows[c].min(), rows[c].max())


def test_profile_with_tables_too_large_to_broadcast(spark, skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr("trackframe.session.MAX_BROADCAST_BYTES", -1)
    got = {(r.label, r.percentile): r.value for r in stats.profile(df, "label", ["v"], [0.1, 0.5]).collect()}
    for label, rows in pdf.groupby("label"):
        assert got[label, 0.5] == pytest.approx(rows.v.median())


def test_profile_of_infinite_and_alike_values(spark):
    inf = float("inf")
    values = {"a": [inf, 1.0, -inf, 0.0, -0.0, 5e-324, 1.7976931348623157e308], "b": [2.0] * 50, "c": [-(2.0**k) for k in range(-20, 20)], "d": [3.5]}
    df = spark.createDataFrame([(k, v) for k, own in values.items() for v in own], "label string, v double")
    got = {(r.label, r.percentile): r for r in stats.profile(df, "label", ["v"], [0.0, 0.25, 0.5, 1.0]).collect()}
    for label, own in values.items():
        for p in (0.0, 0.25, 0.5, 1.0):
            with np.errstate(invalid="ignore"):
                want = np.percentile(own, p * 100)
            low, high = sorted(own)[int(np.floor(p * (len(own) - 1)))], sorted(own)[int(np.ceil(p * (len(own) - 1)))]
            assert got[label, p].value == (low if low == high else pytest.approx(want))
    assert got["b", 0.5].sd == 0 and got["d", 0.5].sd is None
    assert got["c", 0.5].sd == pytest.approx(np.std(values["c"], ddof=1))


def test_sketches_of_parts_merge(spark, skewed):
    pdf, df = skewed
    stored = None
    for part in range(3):
        own = stats.sketches(df.where(F.col("id") % 3 == part), "label", ["v", "w"], 2048)
        stored = own if stored is None else stored.unionByName(own)
    for r in stats.sketched_percentiles(stats.merged_sketches(stored, "label"), "label", [0.1, 0.5, 0.9]).collect():
        own = np.sort(pdf[pdf.label == r.label][r.feature])
        assert (r.n, r.lowest, r.highest) == (len(own), own[0], own[-1])
        rank, slack = r.percentile * len(own), 0.005 * len(own) + 1
        assert np.searchsorted(own, r.value) <= rank + slack and np.searchsorted(own, r.value, "right") >= rank - slack


def sequential(pdf, columns, k, minimum):
    for c in columns:
        mean, sd = pdf[c].mean(), pdf[c].std()
        pdf = pdf[pdf[c] >= minimum[c]] if c in minimum else pdf[(pdf[c] <= mean + k * sd) & (pdf[c] >= mean - k * sd)]
    return set(pdf.id)


def test_sigma_filters(spark, skewed):
    pdf, df = skewed
    want = set().union(*[sequential(rows, ["v", "w", "id"], 1.2, {"id": 50}) for _, rows in pdf.groupby("label")])
    assert ids(sigma_filter(df, ["v", "w", "id"], ["label"], 1.2, {"id": 50})) == want
    assert ids(sigma_filter(df, ["v"], k=1.0)) == sequential(pdf, ["v"], 1.0, {})
    one = ids(sigma_filter_single_pass(df, ["v", "id"], ["label"], 1.2, {"id": 50}))
    assert one == {i for _, rows in pdf.groupby("label") for i in sequential(rows, ["v"], 1.2, {}) if i >= 50}
    lonely = spark.createDataFrame([(1, "a", 2.0)], "id long, label string, v double")
    assert ids(sigma_filter(lonely, ["v"], ["label"])) == set()  # one row has no deviation


def test_filters_on_missing_and_nan(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, math.nan), (4, 300.0), (5, 299.9), (6, -0.0)], "id long, v double")
    clean = nan_to_null(df)
    assert ids(nonzero(clean, ["v"])) == {2, 3, 4, 5}
    assert ids(at_least(df, {"v": 300})) == ids(at_least(clean, {"v": 300})) == {4}
    assert ids(exclude_when(clean, F.col("v") >= 299)) == {1, 2, 3, 6}


def test_minmax_scaler_constant_column_no_clipping_and_storage(spark, tmp_path):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, c double")
    rest = spark.createDataFrame([(20.0, 7.0)], "a double, c double")
    got, other = minmax_scale(train, rest, columns=["a", "c"])
    assert sorted(map(tuple, got.collect())) == [(0.0, 0.0), (1.0, 0.0)] and other.first() == (2.0, 2.0)
    model = MinMaxColumns(inputCols=["a"], outputCols=["s"]).fit(train)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert MinMaxColumnsModel.load(str(tmp_path / "m")).transform(rest).first().s == 2.0


def test_array_functions(spark):
    df = spark.createDataFrame([([2.0, 4.0, math.nan, -8.0],), ([0.0, -1.0, 0.0, 0.0],)], "x array<double>")
    first, second = [r[0] for r in df.select(divide_by_row_max(F.col("x"))).collect()]
    assert first[:2] == [0.5, 1.0] and math.isnan(first[2]) and first[3] == -2.0
    assert math.isnan(second[0]) and second[1] == -math.inf
    assert df.select(reshape(F.col("x"), 2, 2)).first()[0][0] == [2.0, 4.0]
    tie = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert tie.select(argmax(F.col("s"))).first()[0] == 1
    assert tie.select(one_hot(F.lit("b"), ["c", "b", "a"])).first()[0] == [0.0, 1.0, 0.0]


def test_reports(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 3 + [("b", "b")] * 2 + [("c", "b")]
    counts = stats.outcome_counts(spark.createDataFrame(pairs, "truth string, pred string"))
    grid = {r.truth: (r.p_a, r.p_b, r.p_c) for r in stats.confusion(counts, ["c", "b", "a"]).collect()}
    assert grid == {"a": (5, 3, 0), "b": (0, 2, 0), "c": (0, 1, 0)}
    report = {r.label: r for r in stats.class_report(counts).collect()}
    assert report["b"].precision == pytest.approx(2 / 6) and report["b"].recall == 1.0
    assert (report["c"].precision, report["c"].recall, report["c"].f1, report["c"].support) == (0.0, 0.0, 0.0, 1)
    assert report["macro avg"].recall == pytest.approx((5 / 8 + 1 + 0) / 3)
    assert report["weighted avg"].recall == pytest.approx(7 / 11) == report["accuracy"].f1
    assert stats.accuracy(counts).first().accuracy_pct == pytest.approx(63.64)


def test_observed_counts_need_no_job_of_their_own(spark):
    df, seen = stats.observe_rows(spark.range(20), "rows")
    df.where("id > 5").write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 20


def test_confusion_counts_every_row(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "zz"), ("new", "a"), (None, "a"), ("b", None), ("b", "b")]
    counts = stats.outcome_counts(spark.createDataFrame(rows, "truth string, pred string"))
    table = stats.confusion(counts, ["a", "b", "never"])
    got = {r.truth: {c: r[c] for c in table.columns if c != "truth"} for r in table.collect()}
    assert set(got) == {"a", "b", "never", "new", "zz", None}
    assert sum(sum(r.values()) for r in got.values()) == len(rows)
    assert got["b"] == {"p_a": 0, "p_b": 1, "p_never": 0, "p_new": 0, "p_zz": 1, "p_null": 1} and got[None]["p_a"] == 1


@pytest.mark.parametrize("bucket_rows", [50_000, 3])
def test_exact_split_without_one_task_over_all_rows(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(sample, "BUCKET_ROWS", bucket_rows)
    df = spark.range(1000).withColumnRenamed("id", "k")
    split = sample.random_split_exact(df, ["k"])
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 900, "dev": 50, "test": 50}
    assert "SinglePartition" not in split._jdf.queryExecution().executedPlan().toString()
    assert sample.random_split_exact(df.limit(0), ["k"]).count() == 0
    assert {r.split for r in sample.random_split_exact(spark.createDataFrame([(1,)], "k long"), ["k"]).collect()} == {"test"}
