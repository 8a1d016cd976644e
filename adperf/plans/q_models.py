"""Queries: model preparation, metrics, training, selection, explanation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.ml import explain, metrics, neighbours, permute, prep, select, train
from adperf.operators import tables, windows
from adperf.plans import layers, oracle
from adperf.plans.registry import query
from adperf.sources.adapters import impressions

AD = "Ad_Reference_ID"
LABEL = "high_performance"
NUMERICS = ["cost_per_click", "ad_video_length", "avg_watch_duration"]
#: What is known of an ad of the impression log before its launch; watch time is not.
INPUTS = ["cost_per_click", "ad_video_length"]
TARGETS = ["ctr", "roas", "conversion_rate"]
GROUPS = ["ad_category", "ad_device", "ad_type"]

# The training rows as SQL.
oracle.CTES["model_rows"] = """
SELECT t.*, k.Ad_Category_Standard AS ad_category, k.Ad_Device_Cleaned AS ad_device,
  k.Ad_Location_Cleaned AS ad_location, k.Ad_Type_Standard AS ad_type,
  k.Cost_Per_Click_Cleaned AS cost_per_click, k.ad_video_length_cleaned AS ad_video_length,
  CASE WHEN roas > 12 THEN 1 ELSE 0 END AS high_performance
FROM (
  SELECT Ad_Reference_ID, sum(user_clicked_cleaned) / count(User_ID) AS ctr,
    avg(Watch_Duration_Cleaned) AS avg_watch_duration,
    CASE WHEN sum(Cost_Per_Click_Cleaned * user_clicked_cleaned) > 0
      THEN sum(order_value * is_converted) / sum(Cost_Per_Click_Cleaned * user_clicked_cleaned) ELSE 0 END AS roas,
    CASE WHEN sum(user_clicked_cleaned) > 0 THEN sum(is_converted) / sum(user_clicked_cleaned) ELSE 0 END
      AS conversion_rate
  FROM impressions GROUP BY Ad_Reference_ID) t
JOIN silver_catalog k ON t.Ad_Reference_ID = k.Ad_Reference_ID"""

_DRAW = "CAST('0x' || substr(md5(Ad_Reference_ID), 1, 8) AS BIGINT) / 4294967296.0"


_SPLIT_SQL = f"""SELECT *, CASE
    WHEN row_number() OVER (PARTITION BY high_performance ORDER BY draw DESC, Ad_Reference_ID DESC) = 1 THEN 'train'
    WHEN row_number() OVER (PARTITION BY high_performance ORDER BY draw, Ad_Reference_ID) = 1 THEN 'test'
    WHEN draw < 0.2 THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, {_DRAW} AS draw FROM model_rows)"""


# ---- preparation --------------------------------------------------------------------------


@query(
    "l1_stratified_split",
    f"""SELECT Ad_Reference_ID, CAST(high_performance AS BIGINT) AS high_performance, split
    FROM ({_SPLIT_SQL})""",
)
def _(spark, d):
    """Train and test rows drawn by key, every class in train."""
    return prep.split(layers.model_frame(spark, d), LABEL, AD).select(AD, LABEL, "split")


@query(
    "l2_class_balance",
    """SELECT CAST(high_performance AS BIGINT) AS high_performance, count(*) AS n,
      round(count(*) * 100.0 / (SELECT count(*) FROM model_rows), 6) AS pct,
      round((SELECT count(*) FROM model_rows) / (2.0 * count(*)), 6) AS weight
    FROM model_rows GROUP BY model_rows.high_performance""",
)
def _(spark, d):
    """Rows, share and balanced weight per class."""
    return prep.class_balance(layers.model_frame(spark, d), LABEL)


@query(
    "l2_imbalance_ratio",
    """SELECT count(*) FILTER (WHERE high_performance = 1) AS positives,
      count(*) FILTER (WHERE high_performance = 0) AS negatives,
      round(count(*) FILTER (WHERE high_performance = 0) / count(*) FILTER (WHERE high_performance = 1), 6) AS ratio
    FROM model_rows""",
)
def _(spark, d):
    """Negatives per positive."""
    return prep.imbalance_ratio(layers.model_frame(spark, d), LABEL)


@query(
    "l4_category_codes",
    """SELECT Ad_Reference_ID, CAST(dense_rank() OVER (ORDER BY ad_category) - 1 AS DOUBLE) AS ad_category_index,
      CAST(dense_rank() OVER (ORDER BY ad_device) - 1 AS DOUBLE) AS ad_device_index,
      CAST(dense_rank() OVER (ORDER BY ad_type) - 1 AS DOUBLE) AS ad_type_index FROM model_rows""",
)
def _(spark, d):
    """Alphabetical codes of the categorical inputs."""
    rows = layers.model_frame(spark, d)
    coded = prep.indexers(GROUPS).fit(rows).transform(rows)
    return coded.select(AD, *[f"{g}_index" for g in GROUPS])


@query(
    "l5_standardised",
    "SELECT Ad_Reference_ID, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev({c}) OVER (), 6) AS {c}" for c in NUMERICS)
    + " FROM model_rows",
)
def _(spark, d):
    """Numeric inputs with mean 0 and standard deviation 1."""
    rows = layers.model_frame(spark, d)
    vectors = VectorAssembler(inputCols=NUMERICS, outputCol="raw").transform(rows)
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    scaled = scaler.fit(vectors).transform(vectors)
    values = vector_to_array("scaled")
    return scaled.select(AD, *[values[i].alias(c) for i, c in enumerate(NUMERICS)])


def _split(spark, d):
    marked = prep.split(layers.model_frame(spark, d), LABEL, AD)
    return marked.filter("split = 'train'"), marked.filter("split = 'test'")


def _prepared(train_rows):
    return prep.Prepared(train_rows, INPUTS)


@query("l6_feature_assembly")
def _(spark, d):
    """Assembled, standardised feature vectors with interactions."""
    train_rows, test_rows = _split(spark, d)
    vectors = _prepared(train_rows).transform(test_rows)
    return vectors.select(AD, vector_to_array("features").alias("features"))


@query(
    "l9_majority_baseline",
    """SELECT Ad_Reference_ID, CAST((SELECT high_performance FROM model_rows GROUP BY 1
      ORDER BY count(*) DESC, 1 LIMIT 1) AS BIGINT) AS prediction FROM model_rows""",
)
def _(spark, d):
    """The most frequent class as prediction."""
    rows = layers.model_frame(spark, d)
    return train.majority_class(rows, rows, LABEL).select(AD, "prediction")


@query(
    "l16_oversample",
    f"""WITH few AS (SELECT * FROM model_rows WHERE high_performance = 1),
    sizes AS (SELECT count(*) FILTER (high_performance = 1) AS few, count(*) FILTER (high_performance <> 1) AS many
      FROM model_rows),
    placed AS (SELECT few.*, {" + ".join(f"({c} - avg({c}) OVER ()) / stddev({c}) OVER ()" for c in NUMERICS)} AS p FROM few),
    paired AS (SELECT *, row_number() OVER w AS i, {", ".join(
        f"coalesce(lead({c}) OVER w, lag({c}) OVER w, {c}) AS next_{c}" for c in NUMERICS)}
      FROM placed WINDOW w AS (ORDER BY p, Ad_Reference_ID)),
    copied AS (SELECT paired.*, unnest(range(1, 1 + CAST(floor(i * wanted / few) - floor((i - 1) * wanted / few) AS BIGINT))) AS copy
      FROM paired, (SELECT *, CASE WHEN many > 3 * few THEN many - few ELSE 0 END AS wanted FROM sizes)),
    mixed AS (SELECT *, CAST('0x' || substr(md5(Ad_Reference_ID || '/' || copy), 1, 8) AS BIGINT) / 4294967296.0 AS mix FROM copied)
    SELECT CAST(high_performance AS BIGINT) AS high_performance, count(*) AS n,
      {", ".join(f"round(sum({c}), 6) AS {c}" for c in NUMERICS)}
    FROM (SELECT high_performance, {", ".join(NUMERICS)} FROM model_rows UNION ALL
      SELECT high_performance, {", ".join(f"{c} + (next_{c} - {c}) * mix" for c in NUMERICS)} FROM mixed) x
    GROUP BY 1""",
)
def _(spark, d):
    """Rows and sums per class after synthetic minority rows have brought the classes to parity."""
    more = prep.oversample(layers.model_frame(spark, d), LABEL, AD, NUMERICS)
    return more.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in NUMERICS])


@query(
    "s5_move_between_splits",
    f"""SELECT CASE WHEN split = 'test' AND x.roas > 40 THEN 'train' ELSE split END AS split, count(*) AS n
    FROM ({_SPLIT_SQL}) x GROUP BY 1""",
)
def _(spark, d):
    """Rows moved from test to train by key; rows per split."""
    train_rows, test_rows = _split(spark, d)
    moved = test_rows.filter(F.col("roas") > 40)
    new_train, new_test = prep.move_rows(train_rows, test_rows, moved, AD)
    return tables.union_counts({"train": new_train, "test": new_test}, "split")


# ---- metrics ------------------------------------------------------------------------------

_MEANS = " UNION ALL ".join(
    f"SELECT '{t}' AS target, '{g}_mean' AS model, {t} AS y, avg({t}) OVER (PARTITION BY {g}) AS p FROM model_rows"
    for t in TARGETS
    for g in GROUPS
)
_RESULTS = f"""SELECT target, model, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM ({_MEANS}) GROUP BY ALL"""


def _results(spark, d) -> DataFrame:
    """Results table of the group-mean models, written as training would write it."""
    predicted = train.group_mean_predictions(layers.model_frame(spark, d), TARGETS, GROUPS)
    return layers.stage(
        metrics.regression_metrics(predicted, "y", "p", ["target", "model"]), "results"
    )


@query(
    "l17_regression_metrics",
    f"SELECT target, model, n, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM ({_RESULTS})",
)
def _(spark, d):
    """rmse, mae and r2 of group-mean predictions."""
    return _results(spark, d)


@query(
    "l12_vote",
    """SELECT Ad_Reference_ID, round((avg(roas) OVER (PARTITION BY ad_category) + avg(roas) OVER (PARTITION BY ad_device)) / 2, 6)
      AS vote FROM model_rows""",
)
def _(spark, d):
    """Mean of two predictions as one."""
    rows = layers.model_frame(spark, d).select(AD, "ad_category", "ad_device", "roas")
    for g in ("ad_category", "ad_device"):
        rows = windows.group_stats_onto_rows(rows, [g], {f"score_{g}": F.avg("roas")})
    return train.vote(rows, ["score_ad_category", "score_ad_device"], "vote").select(AD, "vote")


_SCORED = """SELECT user_clicked_cleaned AS y, Watch_Duration_Cleaned / 50 AS s,
  CASE WHEN Watch_Duration_Cleaned / 50 >= 0.5 THEN 1 ELSE 0 END AS p FROM impressions"""


def _scored(spark, d) -> DataFrame:
    return impressions(spark, d).select(
        F.col("user_clicked_cleaned").alias("y"),
        (F.col("Watch_Duration_Cleaned") / 50).alias("s"),
        (F.col("Watch_Duration_Cleaned") / 50 >= 0.5).cast("int").alias("p"),
    )


@query(
    "l18_binary_metrics",
    f"""SELECT n, round((tp + tn) / n, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
      round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
      round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
      count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM ({_SCORED}))""",
)
def _(spark, d):
    """accuracy, precision, recall and f1."""
    return metrics.binary_metrics(_scored(spark, d), "y", "p")


def _auc_sql(scored: str) -> str:
    return f"""SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
      / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS auc
    FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM ({scored}))"""


@query("l18_auc", _auc_sql(_SCORED))
def _(spark, d):
    """Area under the ROC curve, few distinct scores."""
    return metrics.auc(_scored(spark, d), "y", "s")


_FINE = "SELECT user_clicked_cleaned AS y, order_value * 1000 AS s FROM impressions"


def _fine(spark, d) -> DataFrame:
    return impressions(spark, d).select(
        F.col("user_clicked_cleaned").alias("y"), (F.col("order_value") * 1000).alias("s")
    )


@query("l18_auc_distinct_scores", _auc_sql(_FINE))
def _(spark, d):
    """Area under the ROC curve, about as many scores as rows."""
    return metrics.auc(_fine(spark, d), "y", "s")


@query(
    "l18_multiclass_metrics",
    """WITH x AS (SELECT platform_source_cleaned AS y,
        CASE WHEN user_clicked_cleaned = 1 THEN 'asia' ELSE platform_source_cleaned END AS p FROM impressions),
      c AS (SELECT l, (SELECT count(*) FROM x WHERE y = l) AS t, (SELECT count(*) FROM x WHERE p = l) AS s,
        (SELECT count(*) FROM x WHERE y = l AND p = l) AS h FROM (SELECT y AS l FROM x UNION SELECT p FROM x)),
      f AS (SELECT *, 2.0 * h / (t + s) AS f1 FROM c)
    SELECT round(sum(h) / sum(t), 6) AS accuracy, round(sum(f1 * t) / sum(t), 6) AS weighted_f1, round(avg(f1), 6) AS macro_f1 FROM f""",
)
def _(spark, d):
    """accuracy, weighted and macro f1 of a label with several classes."""
    guess = F.when(F.col("user_clicked_cleaned") == 1, "asia").otherwise(F.col("platform_source_cleaned"))
    rows = impressions(spark, d).select(F.col("platform_source_cleaned").alias("y"), guess.alias("p"))
    return metrics.multiclass_metrics(rows, "y", "p")


@query(
    "a24_confusion_matrix",
    f"SELECT CAST(y AS BIGINT) AS actual, CAST(p AS BIGINT) AS predicted, count(*) AS n FROM ({_SCORED}) GROUP BY y, p",
)
def _(spark, d):
    """Rows per actual and predicted class."""
    return metrics.confusion(_scored(spark, d), "y", "p")


_ROC = """SELECT s AS score, pos, neg, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
    sum(pos) OVER w / sum(pos) OVER () AS tpr, sum(neg) OVER w / sum(neg) OVER () AS fpr
  FROM (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM ({scored}) GROUP BY s)
  WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(
    "w12_roc_points",
    f"""SELECT round(score, 6) AS score, pos, neg, CAST(cum_pos AS BIGINT) AS cum_pos, CAST(cum_neg AS BIGINT) AS cum_neg,
      round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM ({_ROC.format(scored=_FINE)})""",
)
def _(spark, d):
    """ROC points over about as many scores as rows."""
    return metrics.roc(_fine(spark, d), "y", "s")


@query(
    "l19_youden_threshold",
    f"""SELECT round(score, 6) AS threshold, round(tpr - fpr, 6) AS youden_j FROM ({_ROC.format(scored=_FINE)})
    ORDER BY round(tpr - fpr, 12) DESC, score DESC LIMIT 1""",
)
def _(spark, d):
    """Score that separates best."""
    return metrics.youden(_fine(spark, d), "y", "s")


# ---- training -----------------------------------------------------------------------------


@query(
    "l7_linear_fit",
    """SELECT round(regr_slope(roas, ctr), 6) AS slope, round(regr_intercept(roas, ctr), 6) AS intercept FROM model_rows""",
)
def _(spark, d):
    """Least-squares line of return on click rate."""
    rows = layers.model_frame(spark, d)
    vectors = VectorAssembler(inputCols=["ctr"], outputCol="features").transform(rows)
    model = LinearRegression(labelCol="roas", solver="normal").fit(vectors)
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    return rows.limit(1).select(F.lit(slope).alias("slope"), F.lit(intercept).alias("intercept"))


FIVE_TARGETS = ["ctr", "roas", "conversion_rate", "avg_ded_score", "cost_efficiency_score"]


def _gold_split(spark, d):
    marked = prep.split(layers.gold(spark, d), LABEL, AD)
    return marked.filter("split = 'train'"), marked.filter("split = 'test'")


def _inputs_for(target, train_rows):
    """All inputs known before the launch, but for the target itself."""
    return prep.Prepared(train_rows, [c for c in prep.NUMERIC_FEATURES if c != target])


@query("l7_linear_regression_targets")
def _(spark, d):
    """Linear baseline of each of the five targets on held-out ads."""
    train_rows, test_rows = _gold_split(spark, d)
    linear = {"LinearRegression": train.regressors()["LinearRegression"]}
    parts = [
        train.train_regression(train_rows, test_rows, t, _inputs_for(t, train_rows), linear, t == "roas")[0]
        for t in FIVE_TARGETS
    ]
    return reduce(DataFrame.unionByName, parts)


_GOLD_SPLIT_SQL = _SPLIT_SQL.replace("model_rows", "gold")


@query(
    "l7_five_target_facts",
    f"""SELECT target, (SELECT count(*) FROM ({_GOLD_SPLIT_SQL}) WHERE split = 'train') AS train_rows, true AS unbiased, true AS orthogonal
    FROM (SELECT unnest({FIVE_TARGETS}) AS target)""",
)
def _(spark, d):
    """Least squares of each target: residuals of the training ads add up to 0 and are uncorrelated with the inputs."""
    train_rows, _test = _gold_split(spark, d)
    parts = []
    for t in FIVE_TARGETS:
        prepared = _inputs_for(t, train_rows)
        ready = prepared.transform(train_rows.withColumn("label", F.col(t).cast("double"))).select("label", "features")
        fitted = LinearRegression(labelCol="label", solver="normal").fit(ready).transform(ready)
        rest, x = F.col("label") - F.col("prediction"), vector_to_array("features")
        size = F.greatest(F.max(F.abs("label")), F.lit(1.0))
        parts.append(fitted.agg(
            F.lit(t).alias("target"), F.count(F.lit(1)).alias("train_rows"), (F.abs(F.avg(rest)) < 1e-6 * size).alias("unbiased"),
            F.bool_and(F.lit(True)).alias("_"),
            *[F.abs(F.avg(rest * x[i])) < 1e-6 * size for i in range(len(prepared.features))],
        ).drop("_"))
    named = [p.toDF("target", "train_rows", "unbiased", *[f"o{i}" for i in range(len(p.columns) - 3)]) for p in parts]
    return reduce(DataFrame.unionByName, [
        p.select("target", "train_rows", "unbiased", reduce(lambda a, b: a & b, [F.col(c) for c in p.columns[3:]]).alias("orthogonal"))
        for p in named])


_CODES = {c: f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE)" for c in prep.CATEGORICAL_FEATURES}
_ALL_INPUTS = [*prep.NUMERIC_FEATURES, *[f"{c}_index" for c in prep.CATEGORICAL_FEATURES], *prep.INTERACTIONS]


@query(
    "l6_prelaunch_inputs",
    "SELECT Ad_Reference_ID, "
    + ", ".join(
        f"round(CASE WHEN stddev({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev({c}) OVER () ELSE 0 END, 6) AS {c}" for c in _ALL_INPUTS)
    + " FROM (SELECT *, "
    + ", ".join(f"{a} * {b} AS {n}" for n, (a, b) in prep.INTERACTIONS.items())
    + f" FROM (SELECT Ad_Reference_ID, {', '.join(prep.NUMERIC_FEATURES)}, "
    + ", ".join(f"{code} AS {c}_index" for c, code in _CODES.items())
    + " FROM gold))",
)
def _(spark, d):
    """The eight inputs known before the launch and their products, coded, assembled and standardised."""
    rows = layers.gold(spark, d)
    prepared = prep.Prepared(rows)
    values = vector_to_array("features")
    return prepared.transform(rows).select(AD, *[values[i].alias(c) for i, c in enumerate(prepared.features)])


def _regressions(spark, d):
    def run():
        train_rows, test_rows = _split(spark, d)
        return train.train_regression(
            train_rows, test_rows, "roas", _prepared(train_rows), train.regressors(), positive_only=True)[0]

    return layers.layer(spark, d, "regression_results", run)


@query("l10_regression_training")
def _(spark, d):
    """Linear, forest, boosted and ensemble regressors of the return."""
    return _regressions(spark, d)


@query(
    "l10_training_facts",
    f"""SELECT unnest(['Ensemble', 'GradientBoosting', 'LinearRegression', 'RandomForest']) AS model, n, true AS consistent
    FROM (SELECT count(*) AS n FROM ({_SPLIT_SQL}) x WHERE split = 'test' AND roas > 0)""",
)
def _(spark, d):
    """Every model is scored on all held-out ads; errors are consistent with each other."""
    ok = (F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0) & (F.col("r2") <= 1)
    return _regressions(spark, d).select("model", "n", ok.alias("consistent"))


def _classifications(spark, d):
    def run():
        train_rows, test_rows = _split(spark, d)
        return train.train_binary(train_rows, test_rows, LABEL, _prepared(train_rows), train.classifiers())[0]

    return layers.layer(spark, d, "binary_results", run)


@query("l8_binary_training")
def _(spark, d):
    """Class-weighted classifiers, soft vote and tuned threshold."""
    return _classifications(spark, d)


@query(
    "l8_training_facts",
    f"""SELECT CAST(5 AS BIGINT) AS models, count(*) AS n, true AS same_rows, true AS in_range, true AS tuned_is_best
    FROM ({_SPLIT_SQL}) WHERE split = 'test'""",
)
def _(spark, d):
    """Four classifiers and the tuned one on the same held-out ads; the tuned one is the one of the largest area."""
    found = _classifications(spark, d)
    shares = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "auc")]
    plain = ~F.col("model").endswith("_Optimized")
    return found.agg(
        F.count(F.lit(1)).alias("models"), F.max("n").alias("n"), (F.min("n") == F.max("n")).alias("same_rows"),
        F.bool_and(reduce(lambda a, b: a & b, shares)).alias("in_range"),
        (F.max(F.when(plain, F.col("auc"))) == F.max(F.when(~plain, F.col("auc")))).alias("tuned_is_best"))


@query("l8_multinomial_training")
def _(spark, d):
    """Model of a label with several classes."""
    train_rows, test_rows = _split(spark, d)
    prepared = prep.Prepared(train_rows, INPUTS, ["ad_device", "ad_type"], {})
    label = prep.indexers(["ad_category"]).setOutputCols(["label"]).fit(train_rows)
    model = train.multinomial().fit(prepared.transform(label.transform(train_rows)))
    scored = model.transform(prepared.transform(label.transform(test_rows)))
    return metrics.multiclass_metrics(scored, "label", "prediction")


@query("l13_random_search")
def _(spark, d):
    """Cross-validated score of each drawn setting."""
    train_rows, _test = _split(spark, d)
    ready = _prepared(train_rows).transform(train_rows.withColumn("label", F.col("roas")))
    forest = RandomForestRegressor(featuresCol="features", labelCol="label", seed=train.SEED)
    space = {"numTrees": [20, 50, 100], "maxDepth": [3, 5, 8], "minInstancesPerNode": [1, 2, 5]}
    found = train.search(train.dealt(ready.select("label", "features")).persist(), forest, space)
    settings = [
        ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name))
        for m in found.getEstimatorParamMaps()
    ]
    return spark.createDataFrame(
        list(zip(settings, [float(x) for x in found.avgMetrics])), "setting string, r2 double"
    )


@query("l14_cross_validation")
def _(spark, d):
    """Mean and deviation of r2 over five folds."""
    rows = layers.model_frame(spark, d)
    ready = _prepared(rows).transform(rows.withColumn("label", F.col("roas")))
    linear = train.regressors()["LinearRegression"]
    return train.cross_validate(ready.select(AD, "label", "features"), linear, AD)


@query("l15_feature_selection")
def _(spark, d):
    """Features whose forest importance reaches the mean."""
    rows = layers.model_frame(spark, d)
    prepared = _prepared(rows)
    ready = prepared.transform(rows.withColumn("label", F.col("roas")))
    fit_on = train.dealt(ready.select("label", "features")).persist()
    model = train.regressors()["RandomForest"].fit(fit_on)
    fit_on.unpersist()
    chosen = train.select_features(model, prepared.features)
    kept = train.keep_features(ready, chosen).select(F.size(vector_to_array("selected")).alias("width"))
    return kept.groupBy("width").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "features", F.lit(",".join(prepared.features[i] for i in chosen))
    )


@query(
    "l20_variation_gate",
    """SELECT 'flat' AS target, 'skipped: no variation in target' AS model, CAST(0 AS BIGINT) AS n,
      CAST(NULL AS DOUBLE) AS rmse, CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS r2""",
)
def _(spark, d):
    """A constant target gives a placeholder row instead of a model."""
    train_rows, test_rows = _split(spark, d)
    flat = [df.withColumn("flat", F.lit(1.0)) for df in (train_rows, test_rows)]
    return train.train_regression(*flat, "flat")[0]


# ---- selection ----------------------------------------------------------------------------


def _best(spark, d) -> DataFrame:
    return select.select_best(_results(spark, d), "r2")


_BEST = f"""SELECT target, model, r2 FROM ({_RESULTS}) x
  QUALIFY row_number() OVER (PARTITION BY target ORDER BY x.r2 DESC, model) = 1"""


def _binary_results(spark, d) -> DataFrame:
    rows = layers.model_frame(spark, d)
    parts = []
    for g in GROUPS:
        scored = train.group_mean_predictions(rows, [LABEL], [g])
        parts.append(metrics.auc(scored, "y", "p").select(
            F.lit(LABEL).alias("target"), F.lit(f"{g}_mean").alias("model"), "auc"))
    return reduce(DataFrame.unionByName, parts)


_AUCS = " UNION ALL ".join(
    f"SELECT '{g}_mean' AS model, auc FROM ("
    + _auc_sql(
        f"SELECT high_performance AS y, avg(high_performance) OVER (PARTITION BY {g}) AS s FROM model_rows"
    )
    + ")"
    for g in GROUPS
)


@query(
    "l22_model_selection",
    f"""SELECT target, model, 'R2' AS metric, round(r2, 6) AS value FROM ({_BEST})
    UNION ALL SELECT * FROM (SELECT 'high_performance', model, 'AUC', round(auc, 6) FROM ({_AUCS}) y ORDER BY y.auc DESC, model LIMIT 1)""",
)
def _(spark, d):
    """Best model per target."""
    return select.selection_table(_results(spark, d), _binary_results(spark, d))


_COMPARED = f"""SELECT b.target, b.model, b.r2, coalesce(k.r2, 0) AS baseline,
  CASE WHEN coalesce(k.r2, 0) <> 0 THEN round((b.r2 - k.r2) / abs(k.r2) * 100, 6) + 0.0 ELSE 0 END AS improvement_pct
  FROM ({_BEST}) b LEFT JOIN (SELECT * FROM ({_RESULTS}) WHERE model = 'ad_device_mean' AND target <> 'ctr') k ON b.target = k.target"""


def _compared(spark, d) -> DataFrame:
    results = _results(spark, d)
    baseline = results.filter("model = 'ad_device_mean' AND target <> 'ctr'")
    return select.compare(select.select_best(results, "r2"), baseline)


@query(
    "j5_best_vs_baseline",
    f"SELECT target, model, round(r2, 6) AS r2, round(baseline, 6) AS baseline FROM ({_COMPARED})",
)
def _(spark, d):
    """Best model next to its baseline, 0 without one."""
    return _compared(spark, d).select("target", "model", "r2", "baseline")


@query(
    "l23_improvement",
    f"""SELECT target, round(improvement_pct, 4) AS improvement_pct,
      CASE WHEN r2 > 0.3 THEN 'EXCELLENT' WHEN r2 > 0.15 THEN 'GOOD' WHEN r2 > 0 THEN 'FAIR' ELSE 'POOR' END AS fit,
      CASE WHEN improvement_pct > 50 THEN 'GREAT' WHEN improvement_pct > 10 THEN 'GOOD' WHEN improvement_pct > 0 THEN 'MODEST'
        ELSE 'NEGATIVE' END AS status FROM ({_COMPARED})""",
)
def _(spark, d):
    """Improvement over the baseline, labelled."""
    return _compared(spark, d).select(
        "target", F.round("improvement_pct", 4).alias("improvement_pct"), "fit", "status"
    )


@query(
    "l24_model_matrix",
    "SELECT model, "
    + ", ".join(f"round(max(r2) FILTER (WHERE target = '{t}'), 6) AS {t}" for t in TARGETS)
    + f" FROM ({_RESULTS}) GROUP BY model",
)
def _(spark, d):
    """r2 per model and target."""
    return select.model_matrix(_results(spark, d), TARGETS)


@query("l24_win_counts", f"SELECT model, count(*) AS targets FROM ({_BEST}) GROUP BY 1")
def _(spark, d):
    """Targets won per model."""
    return select.win_counts(_best(spark, d))


@query(
    "l24_top_targets",
    f"SELECT target, model, round(r2, 6) AS r2 FROM ({_BEST}) z ORDER BY z.r2 DESC, target LIMIT 3",
)
def _(spark, d):
    """Targets predicted best."""
    return select.top_targets(_best(spark, d))


# ---- explanation ----------------------------------------------------------------------------


def _fitted(spark, d):
    rows = layers.model_frame(spark, d)
    prepared = _prepared(rows)
    ready = prepared.transform(rows.withColumn("label", F.col("roas"))).select(AD, "label", "features")
    fit_on = train.dealt(ready.select("label", "features")).persist()
    models = {n: e.fit(fit_on) for n, e in train.regressors().items() if n in ("LinearRegression", "RandomForest")}
    fit_on.unpersist()
    return rows, prepared, ready, models


@query("l25_permutation_importance")
def _(spark, d):
    """Loss of r2 per input when its values are exchanged between the rows."""
    rows, prepared, _ready, models = _fitted(spark, d)
    columns = [*INPUTS, *[f"{c}_index" for c in prepared.categoricals]]
    return explain.permutation_importance(models["RandomForest"], prepared, rows, AD, "roas", columns)


@query("j6_importance_side_by_side")
def _(spark, d):
    """Importances of several models per feature."""
    _rows, prepared, _ready, models = _fitted(spark, d)
    frames = [explain.importances(m, prepared.features, n) for n, m in models.items()]
    return explain.combined_importances(frames).select(
        "feature",
        *[F.try_element_at("by_model", F.lit(n)).alias(n) for n in models],
        "mean_importance",
    )


@query(
    "l26_contributions_add_up",
    "SELECT Ad_Reference_ID, true AS adds_up FROM model_rows",
)
def _(spark, d):
    """Contributions of a row against its prediction less the intercept."""
    _rows, prepared, ready, models = _fitted(spark, d)
    model = models["LinearRegression"]
    parts = explain.linear_contributions(model, ready, prepared.features, AD)
    total = parts.groupBy(AD).agg(F.sum("contribution").alias("total"))
    predicted = model.transform(ready).select(AD, (F.col("prediction") - F.lit(float(model.intercept))).alias("wanted"))
    return predicted.join(total, AD).select(AD, (F.abs(F.col("wanted") - F.col("total")) < 1e-6).alias("adds_up"))


@query("l26_linear_contributions")
def _(spark, d):
    """Contribution of every feature to every row's linear prediction."""
    _rows, prepared, ready, models = _fitted(spark, d)
    return explain.linear_contributions(models["LinearRegression"], ready, prepared.features, AD)


@query(
    "j6_importance_facts",
    "SELECT CAST(9 AS BIGINT) AS features, true AS sums_to_one, true AS not_negative, true AS mean_of_both",
)
def _(spark, d):
    """Importances of the forest add up to 1; those side by side are of the same features, none is negative."""
    _rows, prepared, _ready, models = _fitted(spark, d)
    wide = explain.combined_importances([explain.importances(m, prepared.features, n) for n, m in models.items()])
    forest, linear = (F.try_element_at("by_model", F.lit(n)) for n in ("RandomForest", "LinearRegression"))
    return wide.agg(
        F.count(F.lit(1)).alias("features"), (F.abs(F.sum(forest) - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and((forest >= 0) & (linear >= 0)).alias("not_negative"),
        F.bool_and(F.abs((forest + linear) / 2 - F.col("mean_importance")) < 1e-9).alias("mean_of_both"))


_TRIALS = 2


@query(
    "l25_exchanged_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(r AS BIGINT) AS repeat, count(*) AS n, round(sum({c}), 6) AS total,
      round(sum({c} * {c}), 6) AS squares, round(min({c}), 6) AS least, round(max({c}), 6) AS most, true AS moved
    FROM model_rows, (SELECT unnest(range({_TRIALS})) AS r) GROUP BY r""" for c in NUMERICS),
)
def _(spark, d):
    """A column's values after an exchange are those before it, on other rows."""
    rows = layers.model_frame(spark, d).select(AD, *NUMERICS)
    trials = permute.exchanged(rows, AD, NUMERICS, _TRIALS).filter("trial.column <> ''")
    own = rows.select(AD, *[F.col(c).alias(f"own_{c}") for c in NUMERICS])
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("v"), F.col(f"own_{c}").alias("own")) for c in NUMERICS])
    long = trials.join(own, AD).select("trial", F.explode(cells).alias("x")).filter("x.name = trial.column")
    return long.groupBy(F.col("trial.column").alias("column_name"), F.col("trial.repeat").alias("repeat")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("x.v").alias("total"), F.sum(F.col("x.v") * F.col("x.v")).alias("squares"),
        F.min("x.v").alias("least"), F.max("x.v").alias("most"),
        F.bool_or(F.col("x.v") != F.col("x.own")).alias("moved"))


# ---- neighbours -----------------------------------------------------------------------------

_SCALED = ", ".join(f"({c} - avg({c}) OVER ()) / stddev({c}) OVER () AS z_{c}" for c in NUMERICS)
_NEAREST = f"""z AS (SELECT *, {_SCALED} FROM model_rows WHERE high_performance = 1),
  near AS (
    SELECT a.Ad_Reference_ID, b.Ad_Reference_ID AS neighbour, {', '.join(f'b.{c} AS to_{c}' for c in NUMERICS)},
      round(sqrt({' + '.join(f'(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})' for c in NUMERICS)}), 9) AS distance
    FROM z a JOIN z b ON a.Ad_Reference_ID <> b.Ad_Reference_ID),
  nearest AS (
    SELECT *, row_number() OVER (PARTITION BY Ad_Reference_ID ORDER BY distance, neighbour) AS place
    FROM near QUALIFY place <= 5)"""


@query("l16_nearest_neighbours", f"WITH {_NEAREST} SELECT Ad_Reference_ID, place, neighbour, CAST(round(distance * 1e9) AS BIGINT) AS billionths FROM nearest")
def _(spark, d):
    """The five nearest minority ads of every minority ad, exactly and without forming all pairs."""
    few = layers.model_frame(spark, d).filter(F.col(LABEL) == 1)
    found = neighbours.nearest(few, AD, NUMERICS)
    return found.select(F.col("key").alias(AD), F.posexplode("neighbours").alias("i", "n")).select(
        AD, (F.col("i") + 1).alias("place"), F.col("n.key").alias("neighbour"), F.round(F.col("n.distance") * 1e9).cast("long").alias("billionths"))


def _unit(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0"


_COPY = "m.Ad_Reference_ID || '/' || copy"


@query(
    "l16_smote",
    f"""WITH {_NEAREST},
    sizes AS (SELECT count(*) FILTER (high_performance = 1) AS few, count(*) FILTER (high_performance <> 1) AS many FROM model_rows),
    counted AS (SELECT *, row_number() OVER (ORDER BY Ad_Reference_ID) - 1 AS i FROM model_rows WHERE high_performance = 1),
    m AS (SELECT counted.*, unnest(range(1, 1 + CAST(floor((i + 1) * wanted / few) - floor(i * wanted / few) AS BIGINT))) AS copy
      FROM counted, (SELECT *, CASE WHEN many > 3 * few THEN many - few ELSE 2 * few END AS wanted FROM sizes)),
    drawn AS (SELECT m.*, {_unit(_COPY)} AS mix, 1 + CAST(floor({_unit("'which/' || " + _COPY)} * least(5, few - 1)) AS BIGINT) AS place
      FROM m, sizes),
    made AS (SELECT {', '.join(f'm.{c} + (n.to_{c} - m.{c}) * m.mix AS {c}' for c in NUMERICS)} FROM drawn m JOIN nearest n USING (Ad_Reference_ID, place))
    SELECT CAST(high_performance AS BIGINT) AS high_performance, count(*) AS n, {', '.join(f'round(sum({c}), 6) AS {c}' for c in NUMERICS)}
    FROM (SELECT high_performance, {', '.join(NUMERICS)} FROM model_rows UNION ALL SELECT 1, * FROM made) GROUP BY 1""",
)
def _(spark, d):
    """Rows and sums per class with synthetic ads between neighbours: to parity, or two for each if that is near."""
    rows = layers.model_frame(spark, d)
    sizes = prep.imbalance_ratio(rows, LABEL).first()
    times = None if sizes["negatives"] > 3 * sizes["positives"] else 2
    more = neighbours.smote(rows, LABEL, AD, NUMERICS, times=times)
    return more.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in NUMERICS])


# ---- several classes ------------------------------------------------------------------------

@query(
    "l11_boosted_classes",
    f"""SELECT count(*) AS n, round(max(own) / count(*), 6) AS majority_share, true AS scores_sum_to_one, true AS beats_majority
    FROM (SELECT x.split, count(*) FILTER (x.ad_category = (SELECT ad_category FROM ({_GOLD_SPLIT_SQL}) WHERE split = 'train'
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) OVER () AS own
      FROM ({_GOLD_SPLIT_SQL}) x WHERE x.split = 'test')""",
)
def _(spark, d):
    """Boosted trees of a label with seven classes against its most frequent one, on held-out ads."""
    train_rows, test_rows = _gold_split(spark, d)
    label = prep.indexers(["ad_category"]).setOutputCols(["code"]).fit(layers.gold(spark, d))
    # what clicks of an ad and its audience tell of its category
    prepared = prep.Prepared(
        train_rows, ["category_age_affinity", "avg_ded_score", "cost_per_click", "avg_user_age", "ctr"], ["ad_device", "ad_type_catalog"], {})
    model = train.BoostedClasses.fit(
        prepared.transform(label.transform(train_rows)), "code", len(label.labelsArray[0]), maxIter=10)
    scored = model.transform(prepared.transform(label.transform(test_rows)))
    common = train.majority_class(train_rows, test_rows, "ad_category", "common").agg(
        F.avg((F.col("ad_category") == F.col("common")).cast("int"))).scalar()
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    right = F.avg((F.col("prediction") == F.col("code")).cast("int"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.round(common, 6).alias("majority_share"),
        F.bool_and(F.abs(total - 1) < 1e-9).alias("scores_sum_to_one"), (right > common).alias("beats_majority"))
