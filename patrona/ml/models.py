"""Estimators with the package's defaults, searches, cross-validation and scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patrona.ml import metrics
from patrona.ml.preparation import PositiveWeight, prepared_fold, with_model
from patrona.ml.trees import GrownInTasks, TreesModel
from patrona.scale import hash_sample, hash_unit, row_value
from patrona.session import discard, materialize, scratch_path

SEED = 42

#: Tree nodes that one fit of a forest holds in the driver at a time: about 80 MB once fitted, twice that in the making.
FOREST_NODES = 1 << 18

# Search spaces of the tuned models. A pair is a range, a list is a choice.
BOOSTED_CLASSIFIER_SPACE = {
    "maxIter": [100, 200, 400], "maxDepth": [3, 5, 8, 12], "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.6, 0.8, 1.0], "featureSubsetStrategy": ["0.5", "0.7", "1.0"],
    "positiveWeight": [1, 5, 10, 20],
}
BOOSTED_REGRESSOR_SPACE = {
    "maxIter": [100, 200, 300], "maxDepth": [3, 5, 7], "stepSize": ("log", 0.01, 0.2),
    "subsamplingRate": [0.7, 0.9, 1.0],
}
FOREST_REGRESSOR_SPACE = {
    "numTrees": ("int", 50, 399), "maxDepth": ("int", 3, 29), "minInstancesPerNode": ("int", 1, 7),
    "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7"], "bootstrap": [True, False],
}


def logistic(weight: str | None = "weight", **params) -> LogisticRegression:
    """Logistic regression, balanced through a weight column."""
    model = LogisticRegression(featuresCol="features", labelCol="label", **params)
    return model.setWeightCol(weight) if weight else model


def forest_classifier(trees: int = 200, weight: str | None = "weight", **params) -> RandomForestClassifier:
    """Random-forest classifier."""
    model = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, seed=SEED, **params)
    return model.setWeightCol(weight) if weight else model


def boosted_classifier(weight: str | None = None, **params) -> GBTClassifier:
    """Boosted-tree classifier."""
    model = GBTClassifier(featuresCol="features", labelCol="label", seed=SEED, **params)
    return model.setWeightCol(weight) if weight else model


def linear(**params) -> LinearRegression:
    """Linear regression."""
    return LinearRegression(featuresCol="features", labelCol="label", **params)


def forest_regressor(trees: int = 100, **params) -> RandomForestRegressor:
    """Random-forest regressor."""
    return RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=trees, seed=SEED, **params)


class ForestInParts(Estimator):
    """A regression forest of any size, fitted and saved a few trees at a time.

    Spark keeps all nodes of a fit in the driver. A forest whose trees may have more than
    ``nodes`` nodes in all is fitted in parts of about that many, each with a seed of its
    own and on all rows; a smaller one is fitted as it stands.
    """

    def __init__(self, forest: RandomForestRegressor, nodes: int = FOREST_NODES):
        super().__init__()
        self.forest, self.nodes = forest, nodes

    def _fit(self, train: DataFrame) -> Model:
        forest, trees = self.forest, self.forest.getNumTrees()
        rows = train.count()
        per_tree = min(2 ** (forest.getMaxDepth() + 1), 2 * max(rows // forest.getMinInstancesPerNode(), 1))
        if trees * per_tree <= self.nodes:
            return forest.fit(train)
        if forest.getFeatureSubsetStrategy() == "auto":
            forest = forest.copy().setFeatureSubsetStrategy("onethird")  # a part of one tree is still part of a forest
        parts, done, largest = [], 0, 0
        while done < trees:
            size = min(max(self.nodes // per_tree, 1), trees - done)
            fitted = forest.copy().setNumTrees(size).setSeed(forest.getSeed() + 7919 * done).fit(train)
            path = scratch_path(train.sparkSession, "forest")
            fitted.write().save(path)
            parts.append((path, size))
            done += size
            largest = max(largest, fitted.totalNumNodes // size)
            per_tree = min(per_tree, largest * 5 // 4)
        return ForestOfParts(parts, forest.getPredictionCol())


class ForestOfParts(Model):
    """Saved parts of one forest; the prediction is the mean of all trees, a part being loaded at a time."""

    def __init__(self, parts: Sequence[tuple[str, int]], prediction: str = "prediction"):
        super().__init__()
        self.parts, self.prediction = list(parts), prediction

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = sum(size for _path, size in self.parts)
        summed = df.withColumn(self.prediction, F.lit(0.0))
        staged = []
        for path, size in self.parts:
            part = RandomForestRegressionModel.load(path).setPredictionCol("_part")
            summed = materialize(part.transform(summed).withColumn(
                self.prediction, F.col(self.prediction) + F.col("_part") * size).drop("_part"), "forest-sum")
            discard(*staged)
            staged = [summed]
        return summed.withColumn(self.prediction, F.col(self.prediction) / trees)


def boosted_regressor(**params) -> GBTRegressor:
    """Boosted-tree regressor."""
    return GBTRegressor(featuresCol="features", labelCol="label", seed=SEED, **params)


def fit_on_log(estimator: Estimator, train: DataFrame,
               fit: Callable[[Estimator, DataFrame], Model] = lambda e, rows: e.fit(rows)) -> PipelineModel:
    """Fit on ln(1 + label) and turn predictions back with exp(x) - 1.

    Rows with a label of -1 or less have no logarithm and take no part in the fit.
    """
    logged = train.where(F.col("label") > -1).withColumn("_log_label", F.log1p("label"))
    fitted = fit(estimator.copy().setLabelCol("_log_label").setPredictionCol("_log_prediction"), logged)
    back = SQLTransformer(statement="SELECT *, expm1(`_log_prediction`) AS prediction FROM __THIS__")
    return PipelineModel(stages=[fitted, back])


def probability(column: str = "probability") -> Column:
    """Probability of class 1 from a model's probability vector."""
    return vector_to_array(column)[1]


def score_rows(model: Model, df: DataFrame, key: str, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """(key, churn_proba, churn_pred); the key travels through ``transform``."""
    scored = model.transform(df).withColumn("churn_proba", probability())
    return scored.select(key, *keep, "churn_proba", (F.col("churn_proba") >= threshold).cast("int").alias("churn_pred"))


def out_of_fold_scores(fit: Callable[[DataFrame], Model], df: DataFrame, key: str, fold: str, k: int) -> DataFrame:
    """(key, churn_proba) where each row is scored by a model that did not see its fold."""
    parts = []
    for i in range(k):
        model = fit(df.where(F.col(fold) != i))
        parts.append(model.transform(df.where(F.col(fold) == i)).select(key, probability().alias("churn_proba")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class ScoreEvaluator(Evaluator):
    """Average precision or ROC area of the class-1 probability, from the package's metrics."""

    def __init__(self, metric: str = "average_precision"):
        super().__init__()
        self.metric = metric

    def _evaluate(self, dataset: DataFrame) -> float:
        rows = dataset.select("label", probability().alias("score"))
        return float(getattr(metrics, self.metric)(rows, "label", "score").first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def draw_params(space: Mapping, n: int, seed: int = SEED) -> list[dict]:
    """N seeded draws from a search space."""
    rng = random.Random(seed)

    def draw(choice):
        if isinstance(choice, tuple) and choice[0] == "int":
            return rng.randint(choice[1], choice[2])
        if isinstance(choice, tuple) and choice[0] == "log":
            return math.exp(rng.uniform(math.log(choice[1]), math.log(choice[2])))
        return rng.choice(choice)
    return [{name: draw(choice) for name, choice in space.items()} for _ in range(n)]


def mark_validation(df: DataFrame, key: str, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Marks the training rows that decide when boosting stops."""
    return df.withColumn("validation", hash_unit(key, seed=f"validation:{seed}") < share)


def stopped_by_validation(estimator: Estimator, rounds: int = 400) -> Estimator:
    """Boosting of at most ``rounds`` trees that ends as soon as the marked rows no longer gain."""
    return estimator.copy().setMaxIter(rounds).setValidationIndicatorCol("validation").setParams(validationTol=0.0)


def rounds_by_validation(estimator: Estimator, df: DataFrame, rounds: Sequence[int] = (100, 200, 400)) -> Model:
    """Boosting whose number of trees is the best one on the marked rows.

    The loss of the marked rows is taken after every round. More rounds are tried while the
    best is within the last tenth of them; the seed makes the shorter run a prefix of the
    longer, so at most the first and the longest run are fitted, and the model returned is
    cut from one of them. It is fitted on the unmarked rows.
    """
    fit_rows, valid = df.where("not validation"), df.where("validation")
    model = estimator.copy().setMaxIter(rounds[0]).fit(fit_rows)
    best, settled = _best_rounds(_losses(model, valid), rounds[:1])
    if not settled and len(rounds) > 1:
        model = estimator.copy().setMaxIter(rounds[-1]).fit(fit_rows)
        best, _settled = _best_rounds(_losses(model, valid), rounds)
    return first_trees(model, best)


def _best_rounds(losses: Sequence[float], rounds: Sequence[int]) -> tuple[int, bool]:
    """Best round of the first run in which it is not within the last tenth, and whether there is such a run."""
    best = rounds[0]
    for limit in rounds:
        best = min(range(limit), key=losses.__getitem__) + 1
        if best <= 0.9 * limit:
            return best, True
    return best, False


def first_trees(model: GBTClassificationModel | GBTRegressionModel, n: int) -> Model:
    """The boosted model of the first ``n`` rounds: what a fit of so many rounds with the same seed gives."""
    if n >= model.getNumTrees:
        return model
    fitted, spark = model._java_obj, SparkSession.active()
    gateway = spark.sparkContext._gateway
    trees = gateway.new_array(spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(fitted.trees()[:n], model.treeWeights[:n])):
        trees[i], weights[i] = tree, weight
    if isinstance(model, GBTRegressionModel):
        kind, sizes = spark._jvm.org.apache.spark.ml.regression.GBTRegressionModel, [model.numFeatures]
    else:
        kind = spark._jvm.org.apache.spark.ml.classification.GBTClassificationModel
        sizes = [model.numFeatures, model.numClasses]
    cut = type(model)(kind(fitted.uid(), trees, weights, *sizes))
    return model._copyValues(cut)._set(maxIter=n)


def _losses(model: Model, valid: DataFrame) -> list[float]:
    if isinstance(model, GBTRegressionModel):
        return model.evaluateEachIteration(valid, "squared")
    return model.evaluateEachIteration(valid)


def _parts(build: Callable[[dict], Estimator], draw: Mapping) -> tuple[Estimator, Estimator | None]:
    """Estimator of a draw, and its class weights: ``positiveWeight`` is no parameter of the estimator."""
    params = {p: v for p, v in draw.items() if p != "positiveWeight"}
    weight = draw.get("positiveWeight")
    if weight is None:
        return build(params), None
    return build({**params, "weight": "weight"}), PositiveWeight(weight)


def random_search(prepare: Estimator | None, build: Callable[[dict], Estimator], draws: Sequence[dict], df: DataFrame,
                  fold: str, k: int, evaluator: Evaluator, parallelism: int = 8,
                  held_out: DataFrame | None = None) -> tuple[PipelineModel | Model, DataFrame]:
    """Cross-validate each draw on the given folds, refit the best one on all rows.

    The preparation is fitted on the training rows of each fold, once for all draws, and
    again on all rows of ``df`` for the refit. All draws on all folds are fitted side by
    side, long ones first, so that none waits for the longest of its fold. Returns the
    refitted pipeline and a table (draw, params, mean, std, best, held_out): the last is the
    metric of the refitted model on rows that took no part in the search, for the best draw only.
    """
    folds = [prepared_fold(prepare, df, fold, i) for i in range(k)]

    def evaluate(cell):
        d, i = cell
        train, test = folds[i]
        estimator, weights = _parts(build, draws[d])
        rows = weights.fit(train).transform(train) if weights else train
        model = estimator.fit(rows)
        scored = materialize(model.transform(test), "fold-scored")  # once, however often the metric reads it
        if isinstance(model, TreesModel):
            model.discard()
        value = float(evaluator.evaluate(scored))
        discard(scored)
        return d, i, value

    def length(cell):
        draw = draws[cell[0]]
        return draw.get("maxIter", draw.get("numTrees", 1)) * draw.get("maxDepth", 1)
    cells = sorted(((d, i) for d in range(len(draws)) for i in range(k)), key=length, reverse=True)
    scores = [[0.0] * k for _ in draws]
    with ThreadPool(min(parallelism, len(cells))) as pool:
        for d, i, value in pool.imap_unordered(inheritable_thread_target(df.sparkSession)(evaluate), cells):
            scores[d][i] = value
    mean = [sum(s) / k for s in scores]
    std = [math.sqrt(sum((v - m) ** 2 for v in s) / k) for s, m in zip(scores, mean)]
    sign = 1 if evaluator.isLargerBetter() else -1
    best = max(range(len(draws)), key=lambda d: (sign * mean[d], -d))
    estimator, weights = _parts(build, draws[best])
    if prepare is None:
        model = estimator.fit(weights.fit(df).transform(df) if weights else df)
    else:
        model = with_model(prepare, estimator, weights).fit(df)
    final = None
    if held_out is not None:
        final = float(evaluator.evaluate(materialize(model.transform(held_out), "held-out-scored")))
    table = df.sparkSession.createDataFrame(
        [(d, {p: str(v) for p, v in draw.items()}, mean[d], std[d], d == best, final if d == best else None)
         for d, draw in enumerate(draws)],
        "draw int, params map<string,string>, mean double, std double, best boolean, held_out double")
    return model, table


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")


def _fold_summary(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """(model, metric, mean, std) of one-row results per model and fold; std over the population of folds."""
    table = df.sparkSession.createDataFrame(
        [(name, fold, metric, None if value is None else float(value))
         for name, fold, row in rows for metric, value in row.asDict().items()],
        "model string, fold int, metric string, value double")
    return table.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def _scored_folds(fits: Mapping[str, Callable[[DataFrame], Model]], df: DataFrame, fold: str, k: int,
                  prepare: Estimator | None, metric: Callable[[DataFrame], DataFrame]) -> DataFrame:
    rows = []
    for i in range(k):
        train, test = prepared_fold(prepare, df, fold, i)
        for name, fit in fits.items():
            rows.append((name, i, metric(fit(train).transform(test)).first()))
    return _fold_summary(df, rows)


def compare_classifiers(fits: Mapping[str, Callable[[DataFrame], Model]], df: DataFrame, fold: str, k: int,
                        prepare: Estimator | None = None) -> DataFrame:
    """(model, metric, mean, std) over folds: ROC area, average precision, precision, recall, F1.

    ``prepare`` is fitted on the training rows of each fold.
    """
    def metric(found):
        scored = found.select("label", F.col("prediction").cast("int").alias("prediction"),
                              probability().alias("score"))
        point = metrics.classification_metrics(scored, "label", "prediction").select("precision", "recall", "f1")
        ranking = row_value(metrics.ranking_metrics(scored, "label", "score"))
        return point.withColumn("_r", ranking).select("*", "_r.*").drop("_r")
    return _scored_folds(fits, df, fold, k, prepare, metric)


def compare_regressors(fits: Mapping[str, Callable[[DataFrame], Model]], df: DataFrame, fold: str, k: int,
                       prepare: Estimator | None = None) -> DataFrame:
    """(model, metric, mean, std) over folds: MAE, RMSE, R2, MAPE; ``prepare`` as above."""
    return _scored_folds(fits, df, fold, k, prepare,
                         lambda scored: metrics.regression_metrics(scored, "label", "prediction"))


def refit_on_top_slots(prepare: Estimator, estimator: Estimator, train: DataFrame, k: int = 20) -> PipelineModel:
    """Fit, keep the k slots of highest importance, and fit again on these alone.

    The result is one pipeline: preparation, slicer of the chosen slots, model.
    """
    fitted = prepare.fit(train)
    rows = materialize(fitted.transform(train), "top-slots")
    importances = estimator.fit(rows).featureImportances.toArray()
    order = sorted(range(len(importances)), key=lambda i: (-importances[i], i))[:k]
    slicer = VectorSlicer(inputCol="features", outputCol="top_features", indices=sorted(order))
    again = estimator.copy().setFeaturesCol("top_features").fit(slicer.transform(rows))
    return PipelineModel(stages=[fitted, slicer, again])


def importance_table(df: DataFrame, names: Sequence[str], importances: Sequence[float], k: int | None = None) -> DataFrame:
    """(feature, importance), highest first, optionally the top k."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
    return table.limit(k) if k else table


def best_kmeans(df: DataFrame, k: int, starts: int = 10, features: str = "features", seed: int = SEED, repeats: int = 1,
                **params):
    """K-means with several starts; the model of least inertia.

    With ``repeats``, starts go on, up to ten times as many, until so many have ended at the least inertia
    (within 0.01 %): a minimum met once may be one of many, and another seed would end at another.
    """
    best, least, costs = None, float("inf"), []
    for i in range(starts if repeats < 2 else 10 * starts):
        if i >= starts and sum(cost <= least * (1 + 1e-4) for cost in costs) >= repeats:
            break
        model = KMeans(k=k, seed=seed + i, featuresCol=features, predictionCol="cluster", **params).fit(df)
        costs.append(model.summary.trainingCost)
        if best is None or costs[-1] < least:
            best, least = model, costs[-1]
    return best


def silhouette(df: DataFrame, cluster: str = "cluster", features: str = "features",
               distance: str = "squaredEuclidean") -> float:
    """Mean silhouette of all rows, linear in the number of rows."""
    return ClusteringEvaluator(predictionCol=cluster, featuresCol=features, distanceMeasure=distance).evaluate(df)


def mean_distances(df: DataFrame, members: str, features: str = "features") -> DataFrame:
    """Adds ``_mass`` and ``_far``: weight of each cluster, and mean squared distance of the row to it, itself left out.

    ``members`` is an array of membership weights, one per cluster. A distance follows
    from three sums per cluster (weights, weighted vectors, weighted squared lengths), so
    no pair of rows is formed.
    """
    rows = df.withColumn("_x", vector_to_array(features))
    square = F.aggregate("_x", F.lit(0.0), lambda s, v: s + v * v)
    cells = rows.select(F.posexplode(members).alias("_c", "_w"), "_x", square.alias("_q")).where("_w > 0")
    masses = cells.groupBy("_c").agg(F.sum("_w").alias("mass"), F.sum(F.col("_w") * F.col("_q")).alias("square"))
    sums = (cells.select("_c", "_w", F.posexplode("_x").alias("_i", "_v")).groupBy("_c", "_i")
            .agg(F.sum(F.col("_w") * F.col("_v")).alias("s")).groupBy("_c")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "s"))), lambda t: t["s"]).alias("sums")))
    table = masses.join(sums, "_c").agg(F.map_from_entries(F.collect_list(F.struct(
        "_c", F.struct("mass", "square", "sums")))).alias("table"))  # one row per cluster
    far = F.transform(members, lambda w, c: _far(F.col("_t.table")[c], F.col("_x"), F.col("_q"), w))
    mass = F.transform(members, lambda w, c: F.coalesce(F.col("_t.table")[c]["mass"], F.lit(0.0)))
    return (rows.withColumn("_q", square).withColumn("_t", row_value(table))
            .withColumns({"_far": far, "_mass": mass}).drop("_x", "_q", "_t"))


def _far(cluster: Column, x: Column, square: Column, own: Column) -> Column:
    dot = F.aggregate(F.zip_with(x, cluster["sums"], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    total = cluster["mass"] * square - 2 * dot + cluster["square"]  # the row itself adds nothing to it
    others = cluster["mass"] - own
    return F.when(others > 0, F.greatest(total, F.lit(0.0)) / others)


def soft_silhouette(df: DataFrame, members: str, features: str = "features") -> DataFrame:
    """(silhouette) of soft labels: the silhouette of a row in each cluster, weighted by its membership.

    Squared distances. With memberships of 0 and 1 this is the plain mean silhouette. A
    row in a cluster of its own, or with no other cluster, counts as 0.
    """
    scored = mean_distances(df, members, features)
    others = F.transform("_far", lambda f, c: F.array_min(F.filter(
        F.col("_far"), lambda g, d: (d != c) & (F.get("_mass", d) > 0))))
    value = F.zip_with("_far", "_others", lambda a, b: F.coalesce(
        F.when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)), F.lit(0.0)))
    total = F.aggregate(F.zip_with(members, "_value", lambda w, s: w * s), F.lit(0.0), lambda s, v: s + v)
    mass = F.aggregate(members, F.lit(0.0), lambda s, v: s + v)
    return (scored.withColumn("_others", others).withColumn("_value", value)
            .agg((F.sum(total) / F.sum(mass)).alias("silhouette")))


def hard_members(cluster: str, k: int) -> Column:
    """Membership array of a cluster number 0..k-1."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: (c == F.col(cluster)).cast("double"))


def scan_k(df: DataFrame, ks: Sequence[int] = range(2, 11), starts: int = 10, features: str = "features",
           sample: int | None = None, key: str | None = None) -> DataFrame:
    """(k, inertia, silhouette) for each k, on all rows or on a capped sample."""
    rows = []
    base = hash_sample(df, key, sample) if sample else df
    for k in ks:
        model = best_kmeans(base, k, starts, features)
        rows.append((int(k), float(model.summary.trainingCost),
                     float(silhouette(model.transform(base), "cluster", features))))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def pick_k(scan: DataFrame) -> DataFrame:
    """The k of highest silhouette, the smaller one on a tie."""
    return scan.orderBy(F.desc("silhouette"), "k").limit(1)


def best_mixture(df: DataFrame, k: int, starts: int = 5, features: str = "features", seed: int = SEED):
    """Gaussian mixture with several starts; the model of highest likelihood."""
    best = None
    for i in range(starts):
        model = GaussianMixture(k=k, seed=seed + i, featuresCol=features, predictionCol="cluster_gmm",
                                probabilityCol="cluster_gmm_probability").fit(df)
        if best is None or model.summary.logLikelihood > best.summary.logLikelihood:
            best = model
    return best


def centroid_distance(centers: Sequence[Sequence[float]], features: str = "features") -> Column:
    """Euclidean distance of a vector (or array) to the nearest of a few given centres."""
    values = F.col(features)
    points = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])

    def squared(center):
        return F.aggregate(F.zip_with(values, center, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.array_min(F.transform(points, squared)))


def with_centroid_distance(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features",
                           name: str = "dist_to_centroid") -> DataFrame:
    """The distance as a column, for a vector column of features."""
    return (df.withColumn("_values", vector_to_array(features))
            .withColumn(name, centroid_distance(centers, "_values")).drop("_values"))


def inertia(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Sum of squared distances to the nearest of the given centres."""
    return with_centroid_distance(df, centers, features).agg(
        F.sum(F.col("dist_to_centroid") * F.col("dist_to_centroid")).alias("inertia"))


def fit_pipeline(prepare: Estimator, estimator: Estimator, train: DataFrame,
                 weights: Estimator | None = None) -> PipelineModel:
    """Preparation, class weights if any, and model as one pipeline model, to be saved and applied as a whole."""
    return with_model(prepare, estimator, weights).fit(train)
