"""Queries that train, search, compare and explain models on the customer frame.

Whatever is learnt, preparation and class weights included, is learnt on training rows;
metrics and explanations are those of held-out rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.prep import CATEGORICAL, HASHED, NUMERIC, model_rows, vectors
from patrona.catalogue.registry import on_base, query
from patrona.ml import explain, metrics, models, oversampling, prep
from patrona.ml.preparation import BalancedWeights, prepared_fold
from patrona.scale import row_value
from patrona.session import materialize

#: Sizes of the ensembles and searches.
TREES, QUICK_TREES, STARTS, DRAWS = 200, 100, 10, 10


def churn_rows(t):
    """(customer_id, inputs, label, fold) of all customers, written once; nothing is prepared yet."""
    return materialize(prep.stratified_folds(model_rows(t), "customer_id", "label", k=5), "churn-rows")


def churn_preparation():
    return prep.Preparation(NUMERIC, CATEGORICAL, impute=True)


VALUE_NUMERIC = ["age", "tenure_in_months", "monthly_charge", "number_of_referrals", "satisfaction_score"]


def value_rows(t):
    """(customer_id, inputs, label, fold): total charges from the other customer columns."""
    rows = (t.base("customer_id", *VALUE_NUMERIC, *CATEGORICAL, "total_charges")
            .where(F.col("total_charges").isNotNull()).withColumnRenamed("total_charges", "label"))
    return materialize(prep.fold_column(rows, "customer_id"), "value-rows")


def value_preparation():
    return prep.Preparation(VALUE_NUMERIC, CATEGORICAL, impute=True)


def hold_out(rows):
    """Train on folds 1-4, test on fold 0."""
    return rows.where(F.col("fold") != 0), rows.where(F.col("fold") == 0)


def _classified(model, test):
    scored = model.transform(test).select(
        "label", F.col("prediction").cast("int").alias("prediction"), models.probability().alias("score"))
    return (metrics.classification_metrics(scored, "label", "prediction")
            .withColumn("_r", row_value(metrics.ranking_metrics(scored, "label", "score")))
            .select("*", "_r.*").drop("_r"))


def _classifier(name, build):
    @query(name)
    def _(t):
        train, test = hold_out(churn_rows(t))
        return _classified(models.fit_pipeline(churn_preparation(), build(), train, BalancedWeights()), test)


_classifier("l01_balanced_logistic", models.logistic)
_classifier("l02_balanced_forest", lambda: models.forest_classifier(TREES))


def fit_boosted(train):
    """Boosted trees of the tuned depth and rate; marked training rows choose the number of rounds."""
    fitted = churn_preparation().fit(train)
    rows = materialize(models.mark_validation(fitted.transform(train), "customer_id"), "boosted-rows")
    return PipelineModel(stages=[fitted, models.rounds_by_validation(
        models.boosted_classifier(maxDepth=3, stepSize=0.1, subsamplingRate=0.8), rows)])


@query("l03_boosted_trees")
def _(t):
    train, test = hold_out(churn_rows(t))
    return _classified(fit_boosted(train), test)


@query("l02_forest_on_oversampled")
def _(t):
    train, test = prepared_fold(churn_preparation(), churn_rows(t), "fold", 0)
    model = models.forest_classifier(TREES, weight=None).fit(
        materialize(oversampling.oversample(train, "customer_id"), "oversampled"))
    scored = model.transform(test).select("label", models.probability().alias("score"))
    return metrics.roc_auc(scored, "label", "score")


@query("l02_high_spender_forest")
def _(t):
    numeric = ["age", "tenure_in_months", "total_revenue", "number_of_referrals"]  # without the charge itself
    rows = materialize(t.base("customer_id", *numeric, *CATEGORICAL, "monthly_charge").select(
        "customer_id", *numeric, *CATEGORICAL,
        F.when(F.col("monthly_charge") > 80, 1.0).otherwise(0.0).alias("label")), "spender-rows")
    train, test = prep.stratified_split(rows, "customer_id", "label")
    prepare = prep.Preparation(numeric, CATEGORICAL, impute=True)
    model = models.fit_pipeline(prepare, models.forest_classifier(QUICK_TREES, weight=None), train)
    scored = model.transform(test).select("label", F.col("prediction").cast("int").alias("prediction"))
    return metrics.classification_metrics(scored, "label", "prediction")


def _regressor(name, fit):
    @query(name)
    def _(t):
        train, test = prepared_fold(value_preparation(), value_rows(t), "fold", 0)
        return metrics.regression_metrics(fit(train).transform(test), "label", "prediction")


_regressor("l04_linear_regression", lambda train: models.linear().fit(train))
_regressor("l05_forest_regressor", lambda train: models.forest_regressor(QUICK_TREES).fit(train))
_regressor("l06_boosted_on_log", lambda train: models.fit_on_log(
    models.boosted_regressor(maxDepth=3), materialize(models.mark_validation(train, "customer_id"), "boosted-rows"),
    models.rounds_by_validation))


def _searched(rows, prepare, build, draws, evaluator, stratified=False):
    """Search on three folds of the training rows; the table ends with the metric on the held-out rows."""
    train, test = hold_out(rows)
    train = train.drop("fold")
    folded = (prep.stratified_folds(train, "customer_id", "label", k=3, seed=7) if stratified
              else prep.fold_column(train, "customer_id", k=3, seed=7))
    folded = materialize(models.mark_validation(folded, "customer_id"), "search-rows")
    return models.random_search(prepare, build, draws, folded, "fold", 3, evaluator, held_out=test,
                                parallelism=max(8, folded.sparkSession.sparkContext.defaultParallelism))


def _boosting(make):
    """Builder for draws whose ``maxIter`` is the most rounds; the validation rows end them earlier."""
    def build(params):
        rounds = params.pop("maxIter")
        return models.GrownInTasks(models.stopped_by_validation(make(**params), rounds))
    return build


@query("l07_search_boosted_classifier")
def _(t):
    return _searched(churn_rows(t), churn_preparation(), _boosting(models.boosted_classifier),
                     models.draw_params(models.BOOSTED_CLASSIFIER_SPACE, DRAWS),
                     models.ScoreEvaluator("average_precision"), stratified=True)[1]


@query("l07_search_forest_regressor")
def _(t):
    def build(params):
        forest = models.forest_regressor(params.pop("numTrees"), **params)
        return models.GrownInTasks(forest, otherwise=models.ForestInParts(forest))
    return _searched(value_rows(t), value_preparation(), build,
                     models.draw_params(models.FOREST_REGRESSOR_SPACE, 3), models.rmse_evaluator())[1]


@query("l07_search_boosted_regressor")
def _(t):
    return _searched(value_rows(t).withColumn("label", F.log1p("label")), value_preparation(),
                     _boosting(models.boosted_regressor), models.draw_params(models.BOOSTED_REGRESSOR_SPACE, DRAWS),
                     models.rmse_evaluator())[1]


@query("l08_compare_classifiers")
def _(t):
    weighted = BalancedWeights()
    return models.compare_classifiers({
        "logistic": lambda train: models.logistic().fit(weighted.fit(train).transform(train)),
        "forest": lambda train: models.forest_classifier(QUICK_TREES).fit(weighted.fit(train).transform(train))},
        churn_rows(t), "fold", 5, churn_preparation())


@query("l08_compare_regressors")
def _(t):
    return models.compare_regressors({
        "linear": models.linear().fit, "forest": models.forest_regressor(QUICK_TREES).fit,
        "boosted": lambda train: models.fit_on_log(
            models.stopped_by_validation(models.boosted_regressor()), models.mark_validation(train, "customer_id"))},
        value_rows(t), "fold", 5, value_preparation())


@query("l09_kmeans_clusters")
def _(t):
    rows = materialize(vectors(t), "vectors")
    return models.best_kmeans(rows, 3, starts=STARTS).transform(rows).select("vec_id", "cluster")


@query("l09_scan_k")
def _(t):
    return models.scan_k(materialize(vectors(t), "vectors"), starts=3)


@query("l10_pick_k")
def _(t):
    return models.pick_k(models.scan_k(materialize(vectors(t), "vectors"), starts=1))


def _mixture(t):
    """Customer vectors in the space of 95 % of the variance, and the mixture of five starts."""
    points, _model, _explained = prep.pca_keeping(vectors(t), 0.95, output="point")
    rows = materialize(points, "points")
    return models.best_mixture(rows, 3, starts=5, features="point").transform(rows)


@query("l11_gaussian_mixture")
def _(t):
    return _mixture(t).select("vec_id", "cluster_gmm", vector_to_array("cluster_gmm_probability").alias("probability"))


# Given centres for the distance and inertia checks.
CENTERS = [[0.1] * 64, [-0.1] * 64, [0.05, -0.05] * 32]
NEAREST = "least(" + ", ".join(f"list_distance(embedding::DOUBLE[], {c}::DOUBLE[])" for c in CENTERS) + ")"


@query("l12_centroid_distance", f"SELECT vec_id, {rnd(NEAREST)} AS dist_to_centroid FROM embeddings")
def _(t):
    return rounded(models.with_centroid_distance(vectors(t), CENTERS).select("vec_id", "dist_to_centroid"))


@query("e09_inertia", f"SELECT {rnd(f'sum(({NEAREST}) ** 2)')} AS inertia FROM embeddings")
def _(t):
    return rounded(models.inertia(vectors(t), CENTERS))


SILHOUETTE = """
SELECT {score} FROM (
  SELECT i, label, CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM (
    SELECT i, label, max(size) AS size, max(total / greatest(size - 1, 1)) FILTER (WHERE label = other) AS a,
      min(total / n) FILTER (WHERE label <> other) AS b FROM (
      SELECT x.vec_id AS i, x.label, y.label AS other, sum(d) AS total, count(*) AS n,
        count(*) FILTER (WHERE x.label = y.label) AS size FROM (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings) x, (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings) y,
        LATERAL (SELECT {distance} AS d) GROUP BY 1, 2, 3) GROUP BY 1, 2))"""


@query("e10_silhouette", SILHOUETTE.format(score=f"{rnd('avg(s)')} AS silhouette",
                                           distance="list_distance(x.e, y.e) ** 2"))
def _(t):
    rows = vectors(t).withColumn("label", F.col("label").cast("double"))
    return rounded(t.spark.createDataFrame([(models.silhouette(rows, "label"),)], "silhouette double"))


# Memberships of the check: 0.7 in the cluster of the label modulo 4, 0.3 in the one after it.
SOFT = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label % 4 AS c FROM embeddings),
cells AS (SELECT vec_id, e, c, 0.7e0 AS w FROM v UNION ALL SELECT vec_id, e, (c + 1) % 4, 0.3e0 FROM v),
far AS (
  SELECT x.vec_id, y.c, sum(y.w * list_distance(x.e, y.e) ** 2) AS total,
    sum(y.w) - coalesce(max(y.w) FILTER (WHERE x.vec_id = y.vec_id), 0) AS mass
  FROM v x JOIN cells y ON true GROUP BY 1, 2)
SELECT {value} AS silhouette FROM (
  SELECT m.w, f.total / f.mass AS a,
    (SELECT min(g.total / g.mass) FROM far g WHERE g.vec_id = m.vec_id AND g.c <> m.c) AS b
  FROM cells m JOIN far f ON f.vec_id = m.vec_id AND f.c = m.c)"""


@query("e10_soft_silhouette", SOFT.format(value=rnd("sum(w * (b - a) / greatest(a, b)) / sum(w)")))
def _(t):
    cluster = F.col("label") % 4
    rows = vectors(t).withColumn("members", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda c: F.when(
        c == cluster, 0.7).when(c == (cluster + 1) % 4, 0.3).otherwise(0.0)))
    return rounded(models.soft_silhouette(rows, "members"))


@query("e10_mixture_silhouette")
def _(t):
    """Silhouette of the mixture by its probabilities and by its most likely clusters."""
    rows = materialize(_mixture(t).select("point", vector_to_array("cluster_gmm_probability").alias("members"),
                                          models.hard_members("cluster_gmm", 3).alias("hard")), "mixture")
    return (models.soft_silhouette(rows, "members", "point").withColumn("labels", F.lit("soft"))
            .unionByName(models.soft_silhouette(rows, "hard", "point").withColumn("labels", F.lit("hard"))))


@query("e13_permutation_importance")
def _(t):
    """Loss of ROC area on held-out rows."""
    train, test = hold_out(churn_rows(t))
    prepared, _weights, model = models.fit_pipeline(churn_preparation(), models.logistic(), train, BalancedWeights()).stages
    names = prep.preprocessed_names(prepared, NUMERIC, CATEGORICAL)
    return explain.permutation_importance(model, materialize(prepared.transform(test), "held-out"), "customer_id", names)


@query("e13_shapley_summary")
def _(t):
    """Mean absolute contribution to the boosted model's score on held-out rows, from the mean training row."""
    train, test = hold_out(churn_rows(t))
    fitted = fit_boosted(train)
    prepared, model = fitted.stages
    names = prep.preprocessed_names(prepared, NUMERIC, CATEGORICAL)
    rows = prepared.transform(test).select("customer_id", "features")
    start = explain.mean_point(prepared.transform(train), "features")
    return explain.shapley_summary(explain.shapley_values(model, rows, "customer_id", names, start))


HELD_OUT = """
held_out AS (
  SELECT customer_id, churn FROM (
    SELECT customer_id, churn, h, quantile_disc(h, 0.2) OVER (PARTITION BY churn) AS cut FROM hashed) WHERE h <= cut)"""


@query("e13_shapley_adds_up", on_base("SELECT customer_id, true AS adds_up FROM held_out", HASHED, HELD_OUT))
def _(t):
    """The contributions of every held-out row add up to its score minus that of the starting point."""
    train, test = hold_out(churn_rows(t))
    prepared, _weights, fitted = models.fit_pipeline(
        churn_preparation(), models.logistic(), train, BalancedWeights()).stages
    names = prep.preprocessed_names(prepared, NUMERIC, CATEGORICAL)
    rows = materialize(prepared.transform(test).select("customer_id", "features"), "shapley-rows")
    values = explain.shapley_values(fitted, rows, "customer_id", names, [0.0] * len(names))
    gap = F.abs(F.col("contributions") - F.col("score") + F.col("start"))
    return explain.additivity(fitted, rows, values, "customer_id", [0.0] * len(names)).select(
        "customer_id", (gap < 1e-9).alias("adds_up"))


@query("l01_held_out_counts", on_base("""
SELECT count(*) AS n, sum(churn)::BIGINT AS n_positive, true AS within_range FROM held_out""", HASHED, HELD_OUT))
def _(t):
    """The confusion matrix of the logistic model counts the held-out rows, and no others."""
    train, test = hold_out(churn_rows(t))
    found = _classified(models.fit_pipeline(churn_preparation(), models.logistic(), train, BalancedWeights()), test)
    return found.select("n", (F.col("tp") + F.col("fn")).cast("long").alias("n_positive"),
                        (F.col("roc_auc").between(0, 1) & F.col("accuracy").between(0, 1)).alias("within_range"))


@query("l09_nearest_centre", "SELECT vec_id, true AS nearest FROM embeddings")
def _(t):
    """Every vector is in the cluster of its nearest centre."""
    rows = materialize(vectors(t), "vectors")
    model = models.best_kmeans(rows, 3, starts=1)
    centers = [c.tolist() for c in model.clusterCenters()]
    own = models.centroid_distance
    assigned = model.transform(rows).withColumn("values", vector_to_array("features"))
    to_own = F.lit(None).cast("double")
    for i, center in enumerate(centers):
        to_own = F.when(F.col("cluster") == i, own([center], "values")).otherwise(to_own)
    return assigned.select("vec_id", (to_own <= own(centers, "values") + 1e-9).alias("nearest"))


@query("l10_best_of_scan", "SELECT 9::BIGINT AS n_scanned, true AS best, count(*) AS n_rows FROM embeddings")
def _(t):
    """The k picked from the scan of 2 to 10 has the highest silhouette of all."""
    rows = materialize(vectors(t), "vectors")
    scan = materialize(models.scan_k(rows, starts=1), "scan")
    picked = models.pick_k(scan).select(F.col("silhouette")).scalar()
    return scan.agg(F.count("*").alias("n_scanned"), (F.max("silhouette") == F.max(picked)).alias("best")).withColumn(
        "n_rows", rows.agg(F.count("*")).scalar())


@query("l11_mixture_consistent", "SELECT vec_id, true AS sums_to_one, true AS most_likely FROM embeddings")
def _(t):
    """Probabilities of every vector sum to one and the cluster is the most likely one."""
    share = vector_to_array("cluster_gmm_probability")
    return _mixture(t).select("vec_id", share.alias("p"), "cluster_gmm").select(
        "vec_id", (F.abs(F.aggregate("p", F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9).alias("sums_to_one"),
        (F.get("p", F.col("cluster_gmm")) == F.array_max("p")).alias("most_likely"))
