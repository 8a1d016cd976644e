"""Training on MLlib: baselines, forests, boosting, ensembles, search, validation."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.ml import metrics, prep
from adperf.operators import tables, windows
from adperf.sources.staging import stage

SEED = 42

# Search space and number of draws.
FOREST_SPACE = {
    "numTrees": [50, 100, 200],
    "maxDepth": [5, 8, 10],
    "minInstancesPerNode": [1, 2, 4],
}
BOOST_SPACE = {
    "maxIter": [20, 50, 100],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.05, 0.1, 0.2],
}
SEARCH_DRAWS = 10
SEARCH_FOLDS = 3

#: Training rows of one task; fewer if that leaves cores without any.
ROWS_IN_TASK = 500_000


# ---- estimators ---------------------------------------------------------------------------


def regressors(features: str = "features") -> dict[str, object]:
    return {
        "LinearRegression": LinearRegression(featuresCol=features, labelCol="label"),
        "RandomForest": RandomForestRegressor(
            featuresCol=features, labelCol="label", numTrees=100, maxDepth=10, seed=SEED
        ),
        "GradientBoosting": GBTRegressor(
            featuresCol=features, labelCol="label", maxIter=50, maxDepth=5, stepSize=0.1, seed=SEED
        ),
    }


def classifiers(features: str = "features", weight: str | None = "weight") -> dict[str, object]:
    common = {"featuresCol": features, "labelCol": "label"}
    if weight:
        common["weightCol"] = weight
    return {
        "LogisticRegression": LogisticRegression(family="binomial", maxIter=100, **common),
        "RandomForest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=SEED, **common),
        "GradientBoosting": GBTClassifier(maxIter=50, maxDepth=5, stepSize=0.1, seed=SEED, **common),
    }


def multinomial(features: str = "features") -> LogisticRegression:
    """Model of a label with several classes."""
    return LogisticRegression(featuresCol=features, labelCol="label", family="multinomial")


class BoostedClasses:
    """Boosted trees for a label with any number of classes: one model for each class against the rest.

    The models are fitted side by side.  A class's score is its model's probability as a
    share of all models' probabilities; the first of the highest scores is the prediction.
    """

    def __init__(self, models: Sequence[Model], classes: int):
        self.models, self.classes = list(models), classes

    @classmethod
    def fit(cls, df: DataFrame, label: str, classes: int, parallelism: int = 4, **settings) -> BoostedClasses:
        """`df` has `features` and class codes from 0; a class without rows is never predicted."""
        known = dealt(df.select("features", F.col(label).cast("int").alias("code"))).persist()
        given = {r[0] for r in known.select("code").distinct().collect()}  # one value for a class
        options = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": SEED} | settings

        def one(code: int) -> Model | None:
            if code not in given:
                return None
            rows = known.select("features", (F.col("code") == code).cast("double").alias("label"))
            return GBTClassifier(**options).fit(rows)

        with ThreadPoolExecutor(parallelism) as pool:
            models = list(pool.map(one, range(classes)))
        known.unpersist()
        return cls(models, classes)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `scores`, one for each class with sum 1, and `prediction`."""
        parts = []
        for code, model in enumerate(self.models):
            if model is None:
                df = df.withColumn(f"_p{code}", F.lit(0.0))
            else:
                df = score(model, df, f"_p{code}")
            parts.append(f"_p{code}")
        total = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
        scored = df.withColumn("scores", F.array(*[F.col(p) / total for p in parts])).drop(*parts)
        return scored.withColumn(
            "prediction", (F.array_position("scores", F.array_max("scores")) - 1).cast("double"))


def majority_class(train: DataFrame, test: DataFrame, label: str, into: str = "prediction") -> DataFrame:
    """Predict the most frequent training class, the smallest on ties."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    winner = counts.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label)))).scalar()
    return test.withColumn(into, winner)


def mean_baseline(train: DataFrame, test: DataFrame, target: str, into: str = "prediction") -> DataFrame:
    return test.withColumn(into, train.agg(F.avg(target)).scalar())


def group_mean_predictions(
    df: DataFrame, targets: Sequence[str], groups: Sequence[str], **hot
) -> DataFrame:
    """Targets predicted by group means, as (target, model, y, p) rows.

    The simplest models there are; every trained one should beat them.
    """
    parts = []
    for g in groups:
        stats = {f"_mean_{t}": F.avg(t) for t in targets}
        rows = windows.group_stats_onto_rows(df.select(g, *targets), [g], stats, **hot)
        cells = [
            F.struct(
                F.lit(t).alias("target"),
                F.lit(f"{g}_mean").alias("model"),
                F.col(t).cast("double").alias("y"),
                F.col(f"_mean_{t}").alias("p"),
            )
            for t in targets
        ]
        parts.append(rows.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


# ---- training rows --------------------------------------------------------------------------


def dealt(df: DataFrame, features: str = "features") -> DataFrame:
    """The rows in equal shares for all cores, each share in the order of its features.

    Trees pass over the rows again and again, so a frame of few or unequal partitions
    would leave cores idle in every pass.  Neighbours in the order lead to the same nodes
    of a tree, which keeps those and their statistics in the processor's cache.
    """
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    rounds = max(1, -(-df.count() // (cores * ROWS_IN_TASK)))
    others = [c for c in df.columns if c != features]
    return df.repartition(cores * rounds).sortWithinPartitions(vector_to_array(features), *others)


# ---- scoring columns ------------------------------------------------------------------------


def score(model: Model, df: DataFrame, into: str) -> DataFrame:
    """Prediction of a regressor, or probability of class 1 of a classifier, as one column."""
    scored = model.transform(df)
    made = [c for c in ("rawPrediction", "probability", "prediction") if c in scored.columns]
    if "probability" in made:
        value = vector_to_array(F.col("probability"))[1]
    else:
        value = F.col("prediction")
    return scored.withColumn(into, value).drop(*made)


def score_all(models: Mapping[str, Model], df: DataFrame) -> DataFrame:
    for name, model in models.items():
        df = score(model, df, f"score_{name}")
    return df


def vote(df: DataFrame, columns: Sequence[str], into: str = "score_Ensemble") -> DataFrame:
    """Mean of predictions or probabilities."""
    return df.withColumn(into, reduce(lambda a, b: a + b, [F.col(c) for c in columns]) / len(columns))


# ---- evaluation -----------------------------------------------------------------------------


def evaluate_regression(scored: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    """Metrics of every scored model in one pass."""
    long = scored.select(
        F.col("label"),
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"score_{n}").alias("p")) for n in names])
        ).alias("s"),
    ).select("label", "s.*")
    return metrics.regression_metrics(long, "label", "p", ["model"]).select(
        F.lit(target).alias("target"), "model", "n", "rmse", "mae", "r2"
    )


def evaluate_binary(
    scored: DataFrame, name: str, target: str, threshold: float | Column = 0.5
) -> DataFrame:
    """Threshold metrics and AUC of one scored classifier, in one row."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    flagged = metrics.apply_threshold(scored, f"score_{name}", limit)
    area = metrics.auc(scored, "label", f"score_{name}").scalar()
    return metrics.binary_metrics(flagged, "label", "predicted").select(
        F.lit(target).alias("target"), F.lit(name).alias("model"), "n",
        "accuracy", "precision", "recall", "f1", area.alias("auc"),
    )


# ---- whole runs -----------------------------------------------------------------------------


def can_model(df: DataFrame, target: str) -> bool:
    """Whether the target varies; one aggregate, one boolean to the driver."""
    return bool(tables.variation(df, [target]).select("varies").first()[0])


def skipped(df: DataFrame, target: str, reason: str = "no variation in target") -> DataFrame:
    """Placeholder metrics row for a target that cannot be modelled."""
    return df.sparkSession.createDataFrame(
        [(target, f"skipped: {reason}", 0, None, None, None)],
        "target string, model string, n long, rmse double, mae double, r2 double",
    )


def train_regression(
    train: DataFrame,
    test: DataFrame,
    target: str,
    prepared: prep.Prepared | None = None,
    estimators: Mapping[str, object] | None = None,
    positive_only: bool = False,
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit the regressors, add the mean of the best two, return metrics and models.

    `positive_only` keeps rows with a positive target in train and test.
    """
    if positive_only:
        train, test = train.filter(F.col(target) > 0), test.filter(F.col(target) > 0)
    if not can_model(train, target):
        return skipped(train, target), {}
    prepared = prepared or prep.Prepared(train)
    fit_on = prepared.transform(train.withColumn("label", F.col(target).cast("double")))
    fit_on = dealt(fit_on.select("label", "features")).persist()
    models = {n: e.fit(fit_on) for n, e in (estimators or regressors()).items()}
    fit_on.unpersist()
    held_out = prepared.transform(test.withColumn("label", F.col(target).cast("double")))
    scored = score_all(models, dealt(held_out.select("label", "features")))
    scored = stage(scored.select("label", *[f"score_{n}" for n in models]), "test_scores")
    single = evaluate_regression(scored, list(models), target)
    ranked = [r["model"] for r in single.orderBy(F.desc("r2"), "model").limit(2).collect()]
    scored = vote(scored, [f"score_{n}" for n in ranked])
    return evaluate_regression(scored, [*models, "Ensemble"], target), models


def train_binary(
    train: DataFrame,
    test: DataFrame,
    target: str,
    prepared: prep.Prepared | None = None,
    estimators: Mapping[str, object] | None = None,
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit class-weighted classifiers and their soft vote; metrics per model.

    One more row gives the best model at the threshold chosen on train by
    Youden's J.
    """
    prepared = prepared or prep.Prepared(train)

    def ready(df: DataFrame) -> DataFrame:
        coded = prepared.transform(df.withColumn("label", F.col(target).cast("double")))
        return coded.select("label", "features")

    weighted = dealt(prep.add_class_weight(ready(train), "label")).persist()
    models = {n: e.fit(weighted) for n, e in (estimators or classifiers()).items()}
    columns = [f"score_{n}" for n in models]

    def scores(df: DataFrame, name: str) -> DataFrame:
        voted = vote(score_all(models, df), columns)
        return stage(voted.select("label", *columns, "score_Ensemble"), name)

    on_train = scores(weighted, "train_scores")
    weighted.unpersist()
    on_test = scores(dealt(ready(test)), "test_scores")
    results = stage(
        reduce(
            DataFrame.unionByName,
            [evaluate_binary(on_test, n, target) for n in [*models, "Ensemble"]],
        ),
        "binary_results",
    )
    best = results.orderBy(F.desc("auc"), "model").first()["model"]
    threshold = metrics.youden(on_train, "label", f"score_{best}").select("threshold").scalar()
    tuned = evaluate_binary(on_test, best, target, threshold).withColumn(
        "model", F.lit(f"{best}_Optimized")
    )
    return results.unionByName(tuned), models


# ---- search and validation --------------------------------------------------------------------


def draw_params(estimator, space: Mapping[str, Sequence], draws: int = SEARCH_DRAWS, seed: int = SEED):
    """Distinct random settings of an estimator."""
    rng = random.Random(seed)
    seen, maps = set(), []
    names = sorted(space)
    limit = 1
    for n in names:
        limit *= len(space[n])
    while len(maps) < min(draws, limit):
        choice = tuple(rng.choice(list(space[n])) for n in names)
        if choice not in seen:
            seen.add(choice)
            maps.append({estimator.getParam(n): v for n, v in zip(names, choice)})
    return maps


def search(
    train: DataFrame,
    estimator,
    space: Mapping[str, Sequence],
    regression: bool = True,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    parallelism: int = 4,
    fold_col: str | None = None,
):
    """Best of some random settings by cross-validation (r2 or area under ROC)."""
    evaluator = (
        RegressionEvaluator(metricName="r2")
        if regression
        else BinaryClassificationEvaluator(metricName="areaUnderROC")
    )
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=draw_params(estimator, space, draws),
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=SEED,
    )
    if fold_col:
        validator = validator.setFoldCol(fold_col)
    return validator.fit(train)


def cross_validate(df: DataFrame, estimator, key: str, folds: int = 5, regression: bool = True) -> DataFrame:
    """Score per fold with its mean and standard deviation; folds are drawn by key."""
    marked = stage(prep.add_folds(df, key, folds), "folds")
    parts = []
    for k in range(folds):
        model = estimator.fit(marked.filter(F.col("fold") != k))
        scored = score(model, marked.filter(F.col("fold") == k), "p")
        if regression:
            value = metrics.regression_metrics(scored, "label", "p").select(F.col("r2").alias("score"))
        else:
            value = metrics.auc(scored, "label", "p").select(F.col("auc").alias("score"))
        parts.append(value.select(F.lit(k).alias("fold"), "score"))
    scores = reduce(DataFrame.unionByName, parts)
    return scores.agg(
        F.count(F.lit(1)).alias("folds"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std")
    )


def select_features(model, names: Sequence[str], threshold: float | None = None) -> list[int]:
    """Positions of features whose importance reaches the threshold, by default the mean."""
    weights = model.featureImportances.toArray()
    limit = weights.mean() if threshold is None else threshold
    return [i for i in range(len(names)) if weights[i] >= limit]


def keep_features(df: DataFrame, positions: Sequence[int], into: str = "selected") -> DataFrame:
    return VectorSlicer(inputCol="features", outputCol=into, indices=list(positions)).transform(df)


def save_results(results: DataFrame, name: str, version: str, environment: str, run_ts: str, mode="append") -> None:
    """Results table with version, environment and time."""
    from adperf.sources import io

    stamped = results.withColumns(
        {
            "version": F.lit(version),
            "environment": F.lit(environment),
            "training_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    )
    io.write_table(stamped, name, mode=mode)


def save_split(df: DataFrame, path: str) -> None:
    """Train and test rows under one path, one folder each."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
