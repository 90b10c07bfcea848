"""Metrics against hand-computed values, and properties of preparation and models."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from patrona.ml import explain, metrics, models, prep
from patrona.ml.preparation import BalancedWeights, prepared_fold, with_model


def value(df):
    return df.first()[0]


def _auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def _average_precision(y, s):
    ap, last = 0.0, 0.0
    for t in np.unique(s)[::-1]:
        hit = s >= t
        recall = y[hit].sum() / y.sum()
        ap += (recall - last) * y[hit].mean()
        last = recall
    return ap


@pytest.mark.parametrize("digits", [1, 6])
def test_score_metrics_equal_brute_force(spark, digits):
    rng = np.random.default_rng(4)
    y = (rng.random(300) < 0.3).astype(int)
    s = np.round(np.clip(y * 0.2 + rng.random(300) * 0.8, 0, 1), digits)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert value(metrics.roc_auc(df, "label", "score")) == pytest.approx(_auc(y, s))
    assert value(metrics.average_precision(df, "label", "score")) == pytest.approx(_average_precision(y, s))
    both = metrics.ranking_metrics(df, "label", "score").first()
    assert (both[0], both[1]) == (pytest.approx(_auc(y, s)), pytest.approx(_average_precision(y, s)))
    reached = [t for t in np.unique(s) if y[s >= t].mean() >= 0.6]
    assert value(metrics.threshold_for_precision(df, "label", "score", 0.6)) == pytest.approx(min(reached))


def test_threshold_default_and_single_class(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8), (1, 0.1), (0, 0.1)], "label int, score double")
    assert value(metrics.threshold_for_precision(df, "label", "score", 0.6)) == 0.5
    assert value(metrics.roc_auc(df.where("label = 0"), "label", "score")) is None


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    got = metrics.classification_metrics(df, "label", "prediction").first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == (0.75, 1.0, 0.5, pytest.approx(2 / 3))
    none = metrics.classification_metrics(df.withColumn("prediction", F.lit(0)), "label", "prediction").first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    cells = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(df, "label", "prediction").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 1e-8), (None, 1.0)], "label double, prediction double")
    got = metrics.regression_metrics(df, "label", "prediction").first()
    assert got["mae"] == pytest.approx((1 + 1e-8) / 3) and got["rmse"] == pytest.approx((1 / 3) ** 0.5)
    assert got["r2"] == pytest.approx(1 - 1 / (14 / 3)) and got["mape"] == pytest.approx(100 * 2 / 3)


def test_label_agreement(spark):
    same = spark.createDataFrame([(0, "b"), (0, "b"), (1, "a"), (2, "c")], "x int, y string")
    assert metrics.label_agreement(same, "x", "y").first()[1:] == (1.0, pytest.approx(1.0))
    single = spark.createDataFrame([(0, "a"), (0, "a")], "x int, y string")
    assert metrics.label_agreement(single, "x", "y").first()[1:] == (1.0, 1.0)
    # Known example: ARI 0.242424..., NMI by definition.
    x, y = [0, 0, 0, 1, 1, 1], [0, 0, 1, 1, 2, 2]
    got = metrics.label_agreement(spark.createDataFrame(list(zip(x, y)), "x int, y int"), "x", "y").first()
    assert got["ari"] == pytest.approx(8 / 33)
    half_one = spark.createDataFrame([(0, 0), (0, 1)], "x int, y int")
    assert metrics.label_agreement(half_one, "x", "y").first()["nmi"] == 0.0


def test_cluster_stability(spark):
    df = spark.createDataFrame([(i, p, (i + (p == "c") * (i > 2)) % 2) for p in "abc" for i in range(6)],
                               "id int, period string, cluster int")
    out = {(r["period_1"], r["period_2"]): r for r in metrics.cluster_stability(df, "id", "period", "cluster").collect()}
    assert out[("a", "b")]["ari"] == 1.0 and out[("a", "b")]["n_common"] == 6
    assert out[("b", "c")]["ari"] < 1.0 and set(out) == {("a", "b"), ("b", "c")}


def _rows(spark, n=600):
    rng = np.random.default_rng(5)
    data = []
    for i in range(n):
        a, b = rng.normal(), rng.normal()
        data.append((i, float(a), float(b), "xyz"[i % 3], float(rng.random() < 1 / (1 + np.exp(-3 * a)))))
    return spark.createDataFrame(data, "id long, a double, b double, c string, label double")


@pytest.fixture(scope="module")
def prepared(spark):
    df = _rows(spark)
    model = prep.preprocessor(df, ["a", "b"], ["c"]).fit(df)
    return model.transform(df).select("id", "label", "features").cache(), model


def test_scaling_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, k double")
    assert sorted(tuple(r) for r in prep.standard_scale(df, ["a", "k"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    levels = prep.one_hot_columns(spark.createDataFrame([("x",), ("z",), (None,)], "c string"), "c", ["x", "y"])
    assert [tuple(r) for r in levels.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (None, None), (9.0, "a"), (4.0, "b")], "v double, c string")
    assert [r["v"] for r in prep.impute_median(df, ["v"]).collect()][2] == 3.0
    assert [r["c"] for r in prep.impute_mode(df, ["c"]).collect()][2] == "a"


def test_preprocessor_unknown_level_is_zero(spark, prepared):
    _df, model = prepared
    assert prep.preprocessed_names(model, ["a", "b"], ["c"]) == ["a", "b", "c_x", "c_y", "c_z"]
    new = spark.createDataFrame([(1, 0.0, 0.0, "new", 0.0), (2, 0.0, 0.0, None, 0.0), (3, 0.0, 0.0, "y", 0.0)],
                                "id long, a double, b double, c string, label double")
    got = [r[0][2:] for r in model.transform(new).select(vector_to_array("features")).collect()]
    assert got == [[0, 0, 0], [0, 0, 0], [0, 1, 0]]


def test_preprocessor_imputes(spark):
    train = spark.createDataFrame([(1.0, "it's"), (3.0, "it's"), (None, None), (2.0, "b")], "a double, c string")
    model = prep.preprocessor(train, impute=True, scale=False).fit(train)
    assert model.transform(train).select(vector_to_array("features")).collect()[2][0] == [2.0, 0.0, 1.0]


def test_preprocessor_refuses_many_levels(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        prep.preprocessor(df, [], ["c"], max_levels=100).fit(df)


def _numbers(model):
    """Every number and level that a fitted pipeline holds."""
    out = []
    for stage in model.stages:
        if hasattr(stage, "stages"):
            out += _numbers(stage)
        elif hasattr(stage, "coefficients"):
            out += [stage.intercept, *stage.coefficients.toArray().tolist()]
        elif hasattr(stage, "labels"):
            out += stage.labels
        else:
            out += [v for p, v in stage.extractParamMap().items() if p.name in ("statement", "table")]
    return out


def test_only_training_rows_are_learnt_from(spark):
    """Other test rows, even absurd ones with new levels, leave every fitted number as it was."""
    rows = prep.fold_column(_rows(spark).withColumns({
        "a": F.when(F.col("id") % 7 != 0, F.col("a")), "c": F.when(F.col("id") % 11 != 0, F.col("c"))}), "id")
    odd = rows.withColumns({
        "a": F.when(F.col("fold") == 0, F.col("id") * 1e6).otherwise(F.col("a")),
        "c": F.when(F.col("fold") == 0, F.lit("new")).otherwise(F.col("c")),
        "label": F.when(F.col("fold") == 0, 1.0).otherwise(F.col("label"))})
    pipeline = with_model(prep.Preparation(["a", "b"], ["c"], impute=True), models.logistic(), BalancedWeights())
    fitted = [pipeline.fit(df.where("fold <> 0")) for df in (rows, odd)]
    assert _numbers(fitted[0]) == _numbers(fitted[1]) and len(_numbers(fitted[0])) > 8
    train, test = prepared_fold(prep.Preparation(["a", "b"], ["c"], impute=True), odd, "fold", 0)
    plain, _test = prepared_fold(prep.Preparation(["a", "b"], ["c"], impute=True), rows, "fold", 0)
    vectors = [sorted((r["id"], *r["features"].toArray()) for r in df.select("id", "features").collect())
               for df in (train, plain)]
    assert vectors[0] == vectors[1] and {len(v) for v in vectors[0]} == {6}
    assert all(r["features"].toArray()[2:].sum() == 0 for r in test.collect())  # an unknown level has no slot


def test_preparation_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(3, 501)
    x[::5] = np.nan
    df = spark.createDataFrame([(None if np.isnan(v) else float(v), 7.0, None) for v in x], "x double, k double, e double")
    got = np.array([r[0] for r in prep.Preparation(["x", "k", "e"], [], impute=True).fit(df).transform(df).select(
        vector_to_array("features")).collect()])
    filled = np.where(np.isnan(x), np.sort(x[~np.isnan(x)])[(~np.isnan(x)).sum() // 2 - 1], x)
    assert got[:, 0] == pytest.approx((filled - filled.mean()) / filled.std(ddof=1))
    assert (got[:, 1:] == 0).all()


def test_pipeline_is_saved_and_read(spark, tmp_path):
    df = _rows(spark)
    model = with_model(prep.Preparation(["a", "b"], ["c"]), models.logistic(), BalancedWeights()).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    rows = df.drop("label")  # a scored row needs no label
    first, second = (sorted(map(tuple, models.score_rows(m, rows, "id").collect())) for m in (model, again))
    assert first == second


def test_search_reports_held_out_rows(spark):
    rows = prep.fold_column(_rows(spark), "id", k=4)
    train, test = rows.where("fold <> 3"), rows.where("fold = 3")
    draws = [{"regParam": 0.0}, {"regParam": 5.0}]
    model, table = models.random_search(
        prep.Preparation(["a", "b"], ["c"]), lambda p: models.logistic(weight=None, **p), draws, train, "fold", 3,
        models.ScoreEvaluator("roc_auc"), held_out=test)
    found = {r["draw"]: r for r in table.collect()}
    assert [found[d]["best"] for d in (0, 1)] == [found[d]["mean"] == max(f["mean"] for f in found.values()) for d in (0, 1)]
    best = next(r for r in found.values() if r["best"])
    assert best["held_out"] == models.ScoreEvaluator("roc_auc").evaluate(model.transform(test))
    assert [r["held_out"] for r in found.values() if not r["best"]] == [None]


def test_rounds_are_chosen_by_validation(spark):
    df = models.mark_validation(prep.Preparation(["a", "b"], ["c"]).fit(_rows(spark)).transform(_rows(spark)), "id").cache()
    estimator = models.boosted_classifier(maxDepth=2, stepSize=0.5)
    model = models.rounds_by_validation(estimator, df, rounds=(4, 12))
    losses = estimator.setMaxIter(12).fit(df.where("not validation")).evaluateEachIteration(df.where("validation"))
    best = int(np.argmin(losses)) + 1
    assert model.getNumTrees == (best if int(np.argmin(losses[:4])) + 1 > 3.6 else int(np.argmin(losses[:4])) + 1)


@pytest.mark.parametrize("build", [lambda: models.boosted_classifier(maxDepth=2, stepSize=0.5, subsamplingRate=0.7),
                                   lambda: models.boosted_regressor(maxDepth=2, subsamplingRate=0.7)])
def test_first_trees_equal_a_shorter_fit(spark, build):
    df = prep.Preparation(["a", "b"], ["c"]).fit(_rows(spark)).transform(_rows(spark)).cache()
    cut = models.first_trees(build().setMaxIter(9).setPredictionCol("p").fit(df), 4)
    short = build().setMaxIter(4).setPredictionCol("p").fit(df)
    assert cut.getNumTrees == cut.getMaxIter() == 4 and cut.toDebugString.split("\n")[1:] == short.toDebugString.split("\n")[1:]
    columns = [c for c in ("p", "probability", "rawPrediction") if c in short.transform(df).columns]
    assert cut.transform(df).select(columns).collect() == short.transform(df).select(columns).collect()
    assert cut.featureImportances == short.featureImportances


def test_boosting_fits_at_most_two_runs(monkeypatch, spark):
    df = models.mark_validation(prep.Preparation(["a", "b"], ["c"]).fit(_rows(spark)).transform(_rows(spark)), "id").cache()
    asked, fit = [], models.GBTClassifier._fit
    monkeypatch.setattr(models.GBTClassifier, "_fit", lambda self, rows: asked.append(self.getMaxIter()) or fit(self, rows))
    losses = {2: [3, 2], 4: [3, 2, 1.5, 1], 20: [3, 2, 1.5, 1, 0.9, 2, 2, 2, 0.1] + [1] * 11}
    monkeypatch.setattr(models, "_losses", lambda model, valid: losses[model.getNumTrees])
    model = models.rounds_by_validation(models.boosted_classifier(maxDepth=1), df, rounds=(2, 4, 20))
    assert asked == [2, 20] and model.getNumTrees == 9
    asked.clear()
    losses[20][2] = 0.05  # settled within the second run
    assert models.rounds_by_validation(models.boosted_classifier(maxDepth=1), df, rounds=(2, 4, 20)).getNumTrees == 3
    assert asked == [2, 20]


def test_search_fits_all_folds_side_by_side(spark):
    import threading
    together = threading.Barrier(4, timeout=60)  # breaks unless both draws of both folds are evaluated at once

    class Slow(models.ScoreEvaluator):
        def _evaluate(self, dataset):
            if threading.current_thread() is not threading.main_thread():
                together.wait()
            return super()._evaluate(dataset)
    df = prep.fold_column(_rows(spark), "id", k=2)
    draws = [{"regParam": 0.0}, {"regParam": 5.0}]
    _model, table = models.random_search(prep.Preparation(["a", "b"], ["c"]), lambda p: models.logistic(weight=None, **p),
                                         draws, df, "fold", 2, Slow("roc_auc"))
    assert table.count() == 2


def test_soft_silhouette_equals_pairs(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (40, 3)) + np.arange(40)[:, None] % 3
    weights = rng.dirichlet([0.5] * 3, 40)
    weights[0] = [1, 0, 0]
    df = spark.createDataFrame([(p.tolist(), w.tolist()) for p, w in zip(points, weights)],
                               "v array<double>, m array<double>").select(array_to_vector("v").alias("features"), "m")
    far = ((points[:, None] - points[None]) ** 2).sum(-1)
    mean = (far @ weights) / (weights.sum(0) - weights)
    total = 0.0
    for i in range(40):
        for c in range(3):
            a, b = mean[i, c], min(mean[i, d] for d in range(3) if d != c)
            total += weights[i, c] * (b - a) / max(a, b)
    assert value(models.soft_silhouette(df, "m")) == pytest.approx(total / weights.sum())
    hard = df.withColumn("c", F.array_position("m", F.array_max("m")).cast("int") - 1)
    plain = models.silhouette(hard.withColumn("c", F.col("c").cast("double")), "c")
    assert value(models.soft_silhouette(hard.withColumn("h", models.hard_members("c", 3)), "h")) == pytest.approx(plain)


def test_walks_are_antithetic_and_need_no_shuffle(prepared):
    df, _model = prepared
    walks = explain.walks_of(5, 4)
    assert walks[1] == walks[0][::-1] and walks[3] == walks[2][::-1]
    model = models.logistic(weight=None).fit(df)
    values = explain.shapley_values(model, df, "id", list("abcde"), [0.0] * 5)
    assert "Exchange" not in values._jdf.queryExecution().executedPlan().toString()


def test_top_slots_refit(spark):
    df = _rows(spark).withColumn("label", F.col("a") * 3 + F.col("b"))
    model = models.refit_on_top_slots(prep.Preparation(["a", "b"], ["c"]), models.forest_regressor(10), df, k=2)
    assert model.stages[1].getIndices() == [0, 1] and model.stages[2].numFeatures == 2


def test_splits_keep_rows_and_shares(spark):
    df = _rows(spark)
    train, test = prep.stratified_split(df, "id", "label")
    assert train.count() + test.count() == 600 and train.join(test, "id").count() == 0
    for label, n in df.groupBy("label").count().collect():
        assert abs(train.where(F.col("label") == label).count() - 0.8 * n) <= 1
    folds = prep.stratified_folds(df, "id", "label", k=3).groupBy("fold", "label").count().collect()
    assert len(folds) == 6 and max(r["count"] for r in folds if r["label"] == 1) - min(
        r["count"] for r in folds if r["label"] == 1) <= 1
    parts = [p.count() for p in prep.random_split(df, "id")]
    assert sum(parts) == 600 and 440 < parts[0] < 520
    assert prep.fold_column(df, "id").select("fold").distinct().count() == 5


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    sums = {r[0]: r[1] for r in prep.class_weights(df, "label").groupBy("label").agg(F.sum("weight")).collect()}
    assert sums == {0: pytest.approx(4.0), 1: pytest.approx(4.0)}


def test_feature_lists(spark):
    df = spark.createDataFrame([(i, i % 3, f"v{i}", "a") for i in range(30)], "n int, few int, many string, one string")
    assert prep.few_valued_to_categorical(df, ["n", "few"], ["one"]) == (["n"], ["one", "few"])
    assert prep.split_by_cardinality(df, ["many", "one"]) == (["one"], ["many"])
    assert prep.top_slots(["a", "b", "c"], [0.1, 0.5, 0.4], 2) == [1, 2]


def test_classifier_and_explanations(prepared):
    df, _model = prepared
    names = ["a", "b", "c_x", "c_y", "c_z"]
    model = models.logistic(weight=None).fit(df)
    scored = models.score_rows(model, df, "id", 0.5)
    assert scored.columns == ["id", "churn_proba", "churn_pred"] and scored.count() == 600
    assert scored.where((F.col("churn_proba") >= 0.5).cast("int") != F.col("churn_pred")).count() == 0
    importance = {r[0]: r[1] for r in explain.permutation_importance(model, df, "id", names).collect()}
    assert max(importance, key=importance.get) == "a" and importance["a"] > 0.15
    values = explain.shapley_values(model, df, "id", names, [0.0] * 5)
    assert explain.shapley_summary(values).first()["feature"] == "a"
    # Contributions of a row add up to its score minus the score of the baseline.
    sums = values.groupBy("id").agg(F.sum("contribution").alias("total")).join(scored, "id")
    spread = sums.agg(F.max(F.col("churn_proba") - F.col("total")) - F.min(F.col("churn_proba") - F.col("total"))).first()[0]
    assert spread < 1e-9


def test_donor_is_a_permutation(prepared):
    df, _model = prepared
    donors = explain.with_donor(df, "id").select("id", "_values", "_donor").collect()
    assert sorted(map(tuple, (r["_values"] for r in donors))) == sorted(map(tuple, (r["_donor"] for r in donors)))
    assert sum(r["_values"] == r["_donor"] for r in donors) == 0


def test_out_of_fold_scores_cover_all_rows(prepared):
    df, _model = prepared
    folded = prep.stratified_folds(df, "id", "label", k=2)
    scores = models.out_of_fold_scores(models.logistic(weight=None).fit, folded, "id", "fold", 2)
    assert scores.count() == 600 and scores.select("id").distinct().count() == 600


def test_draws_are_repeatable():
    draws = models.draw_params(models.FOREST_REGRESSOR_SPACE, 30)
    assert draws == models.draw_params(models.FOREST_REGRESSOR_SPACE, 30) and len(draws) == 30
    assert all(50 <= d["numTrees"] <= 399 and 1 <= d["minInstancesPerNode"] <= 7 for d in draws)
    assert all(0.01 <= d["stepSize"] <= 0.2 for d in models.draw_params(models.BOOSTED_REGRESSOR_SPACE, 10))


def test_log_target(prepared):
    df, _model = prepared
    train = df.withColumn("label", F.expm1(F.col("label") * 3))
    out = models.fit_on_log(models.linear(), train).transform(train)
    # The fit is by squares on the log scale: there it equals a plain fit, and predictions are its exp(x) - 1.
    plain = models.linear().fit(train.withColumn("label", F.log1p("label"))).transform(train)
    both = out.select("id", "prediction").join(plain.select("id", F.col("prediction").alias("log")), "id")
    gap = both.agg(F.max(F.abs(F.col("prediction") - F.expm1("log")))).first()[0]
    assert gap < 1e-9


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(6)
    centers = [(0, 0), (10, 0), (0, 10)]
    data = [(i, i % 3, [float(x) for x in rng.normal(centers[i % 3], 0.5)]) for i in range(150)]
    return spark.createDataFrame(data, "id long, truth int, v array<double>").select(
        "id", "truth", array_to_vector("v").alias("features")).cache()


def test_clusters(blobs):
    model = models.best_kmeans(blobs, 3, starts=3)
    assigned = model.transform(blobs)
    assert value(metrics.label_agreement(assigned, "truth", "cluster").select("ari")) == 1.0
    centers = [c.tolist() for c in model.clusterCenters()]
    assert value(models.inertia(blobs, centers)) == pytest.approx(model.summary.trainingCost)
    scan = models.scan_k(blobs, range(2, 5), starts=2)
    costs = [r["inertia"] for r in scan.orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True)
    assert value(models.pick_k(scan)) == 3
    mixture = models.best_mixture(blobs, 3, starts=2).transform(blobs)
    assert value(metrics.label_agreement(mixture, "truth", "cluster_gmm").select("ari")) == 1.0


def test_pca_keeps_share(blobs):
    points, _model, explained = prep.pca_keeping(blobs, 0.95)
    assert len(explained) == 2 and len(points.first()["pca"]) == 2
    centre = points.select(vector_to_array("pca")[0].alias("x")).agg(F.avg("x")).first()[0]
    assert abs(centre) < 1e-9


def test_positive_weight_search(prepared):
    df, _model = prepared
    folded = prep.stratified_folds(df, "id", "label", k=2)
    draws = [{"maxIter": 2, "maxDepth": 2, "positiveWeight": 1}, {"maxIter": 3, "maxDepth": 2, "positiveWeight": 5}]
    model, table = models.random_search(None, lambda p: models.boosted_classifier(**p), draws, folded, "fold", 2,
                                        models.ScoreEvaluator("roc_auc"), parallelism=2)
    rows = table.collect()
    assert len(rows) == 2 and sum(r["best"] for r in rows) == 1 and model.getNumTrees in (2, 3)


def test_a_large_forest_is_fitted_in_parts(spark):
    df = prep.Preparation(["a", "b"], ["c"]).fit(_rows(spark)).transform(_rows(spark)).withColumn(
        "label", F.col("a") * 3 + F.col("b")).cache()
    forest = models.forest_regressor(20, maxDepth=6, featureSubsetStrategy="all")
    small = models.ForestInParts(forest).fit(df)
    assert small.getNumTrees == 20  # fits: the forest as it stands
    assert small.transform(df).select("prediction").collect() == forest.fit(df).transform(df).select("prediction").collect()
    large = models.ForestInParts(forest, nodes=500).fit(df)
    parts = [models.RandomForestRegressionModel.load(path) for path, _size in large.parts]
    assert sum(p.getNumTrees for p in parts) == 20 and len(parts) > 3
    assert max(p.totalNumNodes for p in parts) <= 500
    assert len({t.toDebugString for p in parts for t in p.trees}) == 20  # no tree twice
    got = {r["id"]: r["prediction"] for r in large.transform(df).collect()}
    each = [{r["id"]: r["prediction"] for r in p.transform(df).collect()} for p in parts]
    assert len(got) == 600
    for key, value_ in got.items():
        assert value_ == pytest.approx(sum(e[key] * p.getNumTrees for e, p in zip(each, parts)) / 20)
    rmse = models.rmse_evaluator()
    assert rmse.evaluate(large.transform(df)) < 1.2 * rmse.evaluate(small.transform(df))
