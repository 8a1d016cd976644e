"""Model preparation, metrics, training and explanation."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from adperf.ml import explain, metrics, neighbours, permute, prep, select, train
from adperf.plans import catalogue, layers

NUMERICS = ["cost_per_click", "ad_video_length", "avg_watch_duration"]
AD = "Ad_Reference_ID"
VECTORS = ["label", "features"]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return layers.model_frame(spark, sf_dir)


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double")


def area(df):
    return metrics.auc(df, "y", "s").first()["auc"]


def test_auc_cases(spark):
    assert area(frame(spark, [(1, 0.9), (0, 0.1)])) == 1.0
    assert area(frame(spark, [(1, 0.1), (0, 0.9)])) == 0.0
    assert area(frame(spark, [(1, 0.5), (0, 0.5)])) == 0.5
    assert area(frame(spark, [(1, 0.5), (1, 0.7)])) == 0.5


def test_auc_against_pair_counting(spark):
    rng = random.Random(1)
    data = [(rng.randrange(2), round(rng.random(), 2)) for _ in range(300)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert area(frame(spark, data)) == pytest.approx(wins / len(pos) / len(neg))


def test_youden_takes_the_highest_score_on_ties(spark):
    df = frame(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2)])
    row = metrics.youden(df, "y", "s").first()
    assert row["threshold"] == 0.9 and row["youden_j"] == 0.5


def test_binary_metrics_without_positive_predictions(spark):
    df = frame(spark, [(1, 0.0), (0, 0.0)]).withColumn("p", F.lit(0))
    row = metrics.binary_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["mae"] == pytest.approx(1 / 3) and row["r2"] == pytest.approx(0.5)
    flat = spark.createDataFrame([(1.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first()["r2"] == 0.0


@pytest.mark.parametrize("hot", [{}, {"share": 0.01, "min_rows": 0}])
def test_split_keeps_every_class_in_train(spark, hot):
    data = [(f"k{i}", 0) for i in range(200)] + [("p1", 1), ("p2", 1), ("q1", 2)]
    df = spark.createDataFrame(data, "k string, label int")
    got = prep.split(df, "label", "k", **hot)
    counts = {(r["label"], r["split"]): r["n"] for r in got.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert counts[(1, "train")] == 1 and counts[(1, "test")] == 1
    assert counts[(2, "train")] == 1 and (2, "test") not in counts
    assert 20 <= counts[(0, "test")] <= 60
    again = prep.split(df.repartition(7), "label", "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_move_rows(spark):
    train_rows = spark.createDataFrame([("a",), ("b",)], "k string")
    test_rows = spark.createDataFrame([("c",), ("d",)], "k string")
    more, less = prep.move_rows(train_rows, test_rows, test_rows.filter("k = 'c'"), "k")
    assert sorted(r[0] for r in more.collect()) == ["a", "b", "c"] and [r[0] for r in less.collect()] == ["d"]


def test_unseen_categories_get_a_code(spark):
    fit = prep.indexers(["c"]).fit(spark.createDataFrame([("b",), ("a",)], "c string"))
    coded = fit.transform(spark.createDataFrame([("a",), ("b",), ("zzz",)], "c string"))
    assert [r["c_index"] for r in coded.collect()] == [0.0, 1.0, 2.0]


def test_oversample_mixes_neighbours(spark):
    data = [(f"m{i}", 1, float(i)) for i in range(10)] + [(f"n{i}", 0, 0.0) for i in range(50)]
    df = spark.createDataFrame(data, "k string, label int, v double")
    got = prep.oversample(df, "label", "k", ["v"], times=4, slices=2)
    counts = {r["label"]: r["n"] for r in got.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 50, 1: 50}
    new = got.filter("label = 1").agg(F.min("v"), F.max("v")).first()
    assert new[0] >= 0.0 and new[1] <= 9.0


def test_oversample_does_not_depend_on_the_ranges(spark):
    data = [(f"m{i}", 1, float(i * i % 17)) for i in range(12)] + [(f"n{i}", 0, 0.0) for i in range(60)]
    df = spark.createDataFrame(data, "k string, label int, v double")
    results = [sorted(map(tuple, prep.oversample(df, "label", "k", ["v"], slices=s).collect())) for s in (1, 3, 7, None)]
    assert all(r == results[0] for r in results)
    assert sum(r[1] for r in results[0]) == 60
    even = df.filter("label = 1 or k < 'n2'")
    assert prep.oversample(even, "label", "k", ["v"]).count() == even.count()


def test_variation_gate(rows):
    assert train.can_model(rows, "roas")
    flat = rows.withColumn("flat", F.lit(2.0))
    results, models = train.train_regression(flat, flat, "flat")
    assert models == {} and results.first()["model"].startswith("skipped")


def test_linear_contributions_add_up(rows):
    prepared = prep.Prepared(rows, NUMERICS)
    ready = prepared.transform(rows.withColumn("label", F.col("roas")))
    model = train.regressors()["LinearRegression"].fit(ready)
    parts = explain.linear_contributions(model, ready, prepared.features, AD)
    total = parts.groupBy(AD).agg(F.sum("contribution").alias("c"))
    joined = model.transform(ready).join(total, AD).select((F.col("prediction") - F.col("c")).alias("d"))
    low, high = joined.agg(F.min("d"), F.max("d")).first()
    assert low == pytest.approx(model.intercept, abs=1e-6) and high == pytest.approx(model.intercept, abs=1e-6)


def test_permutation_importance_finds_the_signal(spark):
    rng = random.Random(2)
    data = [(f"k{i}", rng.random(), rng.random(), rng.choice("ab")) for i in range(400)]
    df = spark.createDataFrame(data, "k string, x double, noise double, c string").withColumn("t", F.col("x") * 10)
    prepared = prep.Prepared(df, ["x", "noise"], ["c"], {})
    ready = prepared.transform(df.withColumn("label", F.col("t")))
    model = RandomForestRegressor(numTrees=10, maxDepth=5, seed=1).fit(ready)
    got = {r["feature"]: r["importance"] for r in explain.permutation_importance(model, prepared, df, "k", "t", ["x", "noise"]).collect()}
    assert got["x"] > 0.5 and abs(got["noise"]) < 0.1


def test_training_beats_the_mean(spark):
    rng = random.Random(4)
    data = [(f"k{i}", rng.random(), rng.choice("ab")) for i in range(300)]
    df = spark.createDataFrame(data, "k string, x double, c string").withColumn("t", F.col("x") * 3 + 1)
    df = df.withColumn("win", (F.col("x") > 0.5).cast("int"))
    parts = prep.split(df, "win", "k")
    fit_on, held = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    prepared = prep.Prepared(fit_on, ["x"], ["c"], {})
    linear = {"LinearRegression": train.regressors()["LinearRegression"]}
    results, _ = train.train_regression(fit_on, held, "t", prepared, linear)
    assert {r["model"] for r in results.collect()} == {"LinearRegression", "Ensemble"}
    assert min(r["r2"] for r in results.collect()) > 0.99
    logistic = {"LogisticRegression": train.classifiers()["LogisticRegression"]}
    binary, _ = train.train_binary(fit_on, held, "win", prepared, logistic)
    assert {r["model"] for r in binary.collect()} == {"LogisticRegression", "Ensemble", "LogisticRegression_Optimized"} or len(binary.collect()) == 3
    assert max(r["auc"] for r in binary.collect()) > 0.95


def test_random_settings_are_distinct_and_repeatable():
    from pyspark.ml.regression import GBTRegressor

    estimator = GBTRegressor()
    first = train.draw_params(estimator, train.BOOST_SPACE)
    assert first == train.draw_params(estimator, train.BOOST_SPACE)
    assert len(first) == 10 and len({tuple(sorted(m.values())) for m in first}) == 10


def test_selection_and_labels(spark):
    results = spark.createDataFrame(
        [("ctr", "a", 0.2), ("ctr", "b", 0.4), ("roas", "a", -0.1), ("roas", "b", -0.1)], "target string, model string, r2 double"
    )
    best = select.select_best(results, "r2")
    assert {(r["target"], r["model"]) for r in best.collect()} == {("ctr", "b"), ("roas", "a")}
    base = spark.createDataFrame([("ctr", 0.2)], "target string, r2 double")
    got = {r["target"]: r for r in select.compare(best, base).collect()}
    assert got["ctr"]["improvement_pct"] == pytest.approx(100.0) and got["ctr"]["status"] == "GREAT" and got["ctr"]["fit"] == "EXCELLENT"
    assert got["roas"]["improvement_pct"] == 0.0 and got["roas"]["status"] == "NEGATIVE" and got["roas"]["fit"] == "POOR"
    assert [r["target"] for r in select.poor_targets(best).collect()] == ["roas"]


def test_results_and_split_are_stored(spark, rows, tmp_path):
    parts = prep.split(rows, "high_performance", AD)
    train.save_split(parts, str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split")).count() == rows.count()
    results = spark.createDataFrame([("ctr", "a", 0.2)], "target string, model string, r2 double")
    for _ in range(2):
        train.save_results(results, "model_results_test", "v1", "test", "2024-02-15 06:00:00")
    assert spark.table("model_results_test").count() == 2
    spark.sql("DROP TABLE model_results_test")


def nearest_by_brute_force(data, k):
    v = np.array([r[1:] for r in data])
    s = v.std(0, ddof=1)
    z = (v - v.mean(0)) / np.where(s > 0, s, 1)
    far = np.sqrt(((z[:, None] - z[None]) ** 2).sum(2)).round(9)
    return {r[0]: sorted((far[i, j], data[j][0]) for j in range(len(data)) if j != i)[:k] for i, r in enumerate(data)}


@pytest.mark.parametrize(("n", "equal", "pivots"), [(250, 125, 256), (250, 0, 3), (200, 0, 1), (3, 0, 256), (40, 40, 256)])
def test_neighbours_equal_brute_force(spark, n, equal, pivots):
    rng = np.random.default_rng(n + equal)
    data = [(f"k{i:04d}", float(rng.normal()), float(rng.integers(0, 9)), float(rng.normal() ** 3)) for i in range(n)]
    data += [(f"d{i:04d}", *data[0][1:]) for i in range(equal)]  # a third share one point
    df = spark.createDataFrame(data, "k string, a double, b double, c double").repartition(3)
    found = neighbours.nearest(df, "k", ["a", "b", "c"], 4, pivots).collect()
    want = nearest_by_brute_force(data, 4)
    assert {r.key: [x.key for x in r.neighbours] for r in found} == {k: [x for _, x in v] for k, v in want.items()}
    for r in found:
        assert [x.distance for x in r.neighbours] == pytest.approx([d for d, _ in want[r.key]], abs=1e-8)


@pytest.mark.parametrize("levels", [0, 6])
def test_neighbours_across_many_cells(spark, monkeypatch, levels):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 16)
    rng = np.random.default_rng(levels)
    drawn = rng.integers(0, levels, (1500, 3)).astype(float) + (rng.random((1500, 3)) < 0.2) / 4 if levels else rng.normal(size=(1500, 3)) ** 3
    data = [(f"k{i:04d}", *map(float, r)) for i, r in enumerate(drawn)]
    df = spark.createDataFrame(data, "k string, a double, b double, c double").repartition(3)
    found = neighbours.nearest(df, "k", ["a", "b", "c"], 4).collect()
    want = nearest_by_brute_force(data, 4)
    assert {r.key: [x.key for x in r.neighbours] for r in found} == {k: [x for _, x in v] for k, v in want.items()}


def test_cells_stay_small_however_many_points():
    for n in (20_000, 160_000):
        points = np.random.default_rng(n).normal(size=(n, 3)) ** 3
        sample = points[::max(1, n // (n // 512 * 16))]
        cells = neighbours._Tree.cut(sample, n // 512, 16).cells(points)
        assert np.bincount(cells).max() < 4 * 512


def test_neighbours_of_few_and_unknown_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan"))], "k string, v double")
    assert [(r.key, r.neighbours) for r in neighbours.nearest(df, "k", ["v"]).collect()] == [("a", [])]
    assert neighbours.nearest(df.limit(0), "k", ["v"]).collect() == []
    flat = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "k string, v double")
    assert {r.key: [x.key for x in r.neighbours] for r in neighbours.nearest(flat, "k", ["v"]).collect()} == {"a": ["b"], "b": ["a"]}


def test_smote_fills_between_neighbours(spark):
    data = [(f"m{i}", 1, float(i % 2 * 100 + i / 10), "x") for i in range(12)] + [(f"n{i}", 0, 0.0, "y") for i in range(60)]
    df = spark.createDataFrame(data, "k string, label int, v double, c string")
    more = neighbours.smote(df, "label", "k", ["v"], k=3)
    made = more.exceptAll(df).collect()
    assert len(made) == 48 and {r.label for r in made} == {1} and {r.c for r in made} == {"x"}
    # the minority lies in two far groups: neighbours are of the same group, so nothing lies between
    assert all(0 <= r.v <= 1.1 or 100 <= r.v <= 101.2 for r in made)
    assert sorted(more.collect()) == sorted(neighbours.smote(df.repartition(5), "label", "k", ["v"], k=3).collect())
    even = df.filter("label = 1 or k < 'n2'")
    assert neighbours.smote(even, "label", "k", ["v"]).count() == even.count()
    assert neighbours.smote(df.filter("label = 0"), "label", "k", ["v"]).count() == 60


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 12, 100, 1000, 1023])
def test_permutations_are_one_to_one(spark, n):
    found = [spark.range(n).select(permute.place(F.col("id"), n, F.lit(s))).collect() for s in ("a", "b")]
    for rows in found:
        assert sorted(r[0] for r in rows) == list(range(n))
    if n >= 100:
        assert found[0] != found[1]
        assert sum(i == r[0] for i, r in enumerate(found[0])) < 10
        turns = np.corrcoef(np.arange(n), [r[0] for r in found[0]])[0, 1]
        assert abs(turns) < 0.35


def test_exchanged_columns_keep_their_values(spark):
    df = spark.createDataFrame([(f"k{i}", float(i), i * 2) for i in range(50)], "k string, a double, b int")
    trials = permute.exchanged(df, "k", ["a", "b"], 2).collect()
    assert len(trials) == 50 * 5
    for column, repeat in (("", 0), ("a", 0), ("a", 1), ("b", 0), ("b", 1)):
        rows = sorted((r for r in trials if (r.trial.column, r.trial.repeat) == (column, repeat)), key=lambda r: int(r.k[1:]))
        for c, want in (("a", [float(i) for i in range(50)]), ("b", [2 * i for i in range(50)])):
            got = [r[c] for r in rows]
            assert sorted(got) == want and (got == want) == (c != column)


def test_boosted_classes(spark):
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(6)
    data = [(f"k{i}", rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame(data, "k string, x double, y double").withColumn("code", F.floor(F.col("x") * 3))
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    model = train.BoostedClasses.fit(df, "code", 4, maxIter=3)  # the fourth class has no rows
    rows = model.transform(df).collect()
    assert np.mean([r.prediction == r.code for r in rows]) > 0.95
    assert all(abs(sum(r.scores) - 1) < 1e-9 and r.scores[3] == 0.0 for r in rows)


def test_training_rows_are_dealt_evenly_and_in_order(spark):
    data = [(float(i % 7), Vectors.dense(float(i * 37 % 101), float(i % 3))) for i in range(4001)]
    df = spark.createDataFrame(data, VECTORS).coalesce(1)
    got = [[(tuple(r["features"]), r["label"]) for r in part] for part in train.dealt(df).rdd.glom().collect()]
    assert len(got) == spark.sparkContext.defaultParallelism
    assert max(map(len, got)) <= 1.1 * min(map(len, got))
    assert all(part == sorted(part) for part in got)
    assert sorted(x for part in got for x in part) == sorted((tuple(v), y) for y, v in data)
    assert train.dealt(df.limit(0)).count() == 0


def test_more_training_rows_make_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(train, "ROWS_IN_TASK", 100)
    df = spark.createDataFrame([(float(i), Vectors.dense(float(i))) for i in range(900)], VECTORS)
    cores = spark.sparkContext.defaultParallelism
    assert train.dealt(df).rdd.getNumPartitions() == cores * -(-900 // (100 * cores))


class _Seen:
    """An estimator that notes the rows of the partitions it is fitted on."""

    def __init__(self, inner):
        self.inner, self.sizes = inner, None

    def fit(self, df):
        self.sizes = [len(part) for part in df.rdd.glom().collect()]
        return self.inner.fit(df)


def test_models_are_fitted_on_all_cores(spark):
    data = [(f"k{i}", float(i % 50), "ab"[i % 2], float(i % 50) * 2 + i % 3, int(i % 50 > 25)) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, x double, c string, t double, win int").coalesce(1)
    prepared = prep.Prepared(df, ["x"], ["c"], {})
    linear = _Seen(train.regressors()["LinearRegression"])
    logistic = _Seen(train.classifiers()["LogisticRegression"])
    train.train_regression(df, df, "t", prepared, {"LinearRegression": linear})
    train.train_binary(df, df, "win", prepared, {"LogisticRegression": logistic})
    for seen in (linear, logistic):
        assert len(seen.sizes) == spark.sparkContext.defaultParallelism and min(seen.sizes) >= 400 and sum(seen.sizes) == 2000


def test_copies_for_permutations_hold_only_what_a_prediction_takes(spark, monkeypatch):
    data = [(f"k{i}", float(i % 20), float(i % 7), "ab"[i % 2], "wide" * 50, float(i % 20) * 3) for i in range(200)]
    df = spark.createDataFrame(data, "k string, x double, z double, c string, note string, t double")
    prepared = prep.Prepared(df, ["x"], ["c"], {"xz": ("x", "z")})
    model = train.regressors()["LinearRegression"].fit(prepared.transform(df.withColumn("label", F.col("t"))))
    taken = []

    def noted(rows, *args):
        taken.extend(rows.columns)
        return permute.exchanged(rows, *args)

    monkeypatch.setattr(explain, "exchanged", noted)
    got = {r["feature"]: r["importance"] for r in explain.permutation_importance(model, prepared, df, "k", "t", ["x", "z"]).collect()}
    assert sorted(taken) == ["c_index", "k", "label", "x", "xz", "z"]
    assert set(got) == {"x", "z"} and got["x"] > 0.5


def test_random_search_fits_on_all_cores(spark, sf_dir, monkeypatch):
    class Stop(Exception):
        pass

    sizes = []

    def search(df, *args):
        sizes.extend(len(part) for part in df.rdd.glom().collect())
        raise Stop

    narrow = layers.model_frame(spark, sf_dir).coalesce(1)
    monkeypatch.setattr(layers, "model_frame", lambda *args: narrow)
    monkeypatch.setattr(train, "search", search)
    with pytest.raises(Stop):
        catalogue.QUERIES["l13_random_search"](spark, sf_dir)
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 2 * min(sizes)
