"""Queries for model preparation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded, union_all
from patrona.catalogue.registry import on_base, query
from patrona.catalogue.shaping import hash_sql
from patrona.ml import metrics, models, oversampling, prep
from patrona.operators import aggregates
from patrona.operators.joins import frequency_encode
from patrona.session import materialize
from patrona.sources.tables import SERVICES

SCALED = ["age", "monthly_charge", "total_revenue"]


@query("m01_standard_scale", on_base("SELECT customer_id, " + ", ".join(
    rnd(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}" for c in SCALED) + " FROM base"))
def _(t):
    return rounded(prep.standard_scale(t.base("customer_id", *SCALED), SCALED))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("m02_one_hot", "SELECT c_custkey, " + ", ".join(
    f"(c_mktsegment = '{s}')::INT AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def _(t):
    return prep.one_hot_columns(t("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query("m03_impute_median", on_base(f"""
SELECT customer_id, {rnd('''coalesce(avg_monthly_gb_download, (SELECT quantile_cont(avg_monthly_gb_download, 0.5)
  FROM base))''')} AS avg_monthly_gb_download,
  coalesce(tenure_in_months::DOUBLE, (SELECT quantile_cont(tenure_in_months::DOUBLE, 0.5) FROM base))
  AS tenure_in_months FROM base"""))
def _(t):
    columns = ["avg_monthly_gb_download", "tenure_in_months"]
    return rounded(prep.impute_median(t.base("customer_id", *columns), columns))


MODE = "(SELECT arg_min({c}, (-n, {c})) FROM (SELECT {c}, count(*) AS n FROM base WHERE {c} IS NOT NULL GROUP BY 1))"


@query("m04_impute_mode", on_base("SELECT customer_id, " + ", ".join(
    f"coalesce({c}, {MODE.format(c=c)}) AS {c}" for c in ("offer", "internet_type")) + " FROM base"))
def _(t):
    return prep.impute_mode(t.base("customer_id", "offer", "internet_type"), ["offer", "internet_type"])


NUMERIC = ["age", "tenure_in_months", "monthly_charge", "total_revenue", "number_of_referrals", "cltv"]
CATEGORICAL = ["gender", "contract", "payment_method", "offer"]


def model_rows(t):
    """Customers with the numeric and text inputs of the models, written once."""
    return materialize(t.base("customer_id", *NUMERIC, *CATEGORICAL, "churn").withColumn(
        "label", F.col("churn").cast("double")), "model-rows")


@query("m05_preprocessed_columns")
def _(t):
    rows = model_rows(t)
    model = prep.preprocessor(rows, NUMERIC, CATEGORICAL, impute=True).fit(rows)
    return model.transform(rows).select("customer_id", vector_to_array("features").alias("features"))


@query("m06_few_valued_columns", on_base(union_all("""
SELECT '{c}' AS "column", CASE WHEN count(DISTINCT {c}) <= 5 THEN 'categorical' ELSE 'numeric' END AS kind FROM base""",
                                                   ["age", "churn", "satisfaction_score", "tenure_in_months"])))
def _(t):
    columns = ["age", "churn", "satisfaction_score", "tenure_in_months"]
    numeric, categorical = prep.few_valued_to_categorical(t.base(*columns), columns, [])
    rows = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    return t.spark.createDataFrame(rows, "column string, kind string")


@query("m07_cardinality_split", on_base(union_all("""
SELECT '{c}' AS "column", CASE WHEN count(DISTINCT {c}) <= 25 THEN 'one_hot' ELSE 'frequency' END AS encoding
FROM base""", ["city", "state", "contract", "gender"])))
def _(t):
    low, high = prep.split_by_cardinality(t.base("city", "state", "contract", "gender"),
                                          ["city", "state", "contract", "gender"])
    rows = [(c, "one_hot") for c in low] + [(c, "frequency") for c in high]
    return t.spark.createDataFrame(rows, "column string, encoding string")


@query("m08_frequency_encode", on_base("""
SELECT customer_id, offer, count(*) OVER (PARTITION BY offer)::DOUBLE / count(*) OVER () AS offer_freqenc FROM base"""))
def _(t):
    return frequency_encode(t.base("customer_id", "offer"), ["offer"], null_safe=True)


@query("m09_variance_threshold", on_base(union_all(f"""
SELECT '{{c}}' AS "column", {rnd('var_pop({c})', 4)} AS variance, var_pop({{c}}) > 0.1 AS kept FROM base""",
                                                   ["age", "churn", "cltv", "internet_service"])))
def _(t):
    columns = ["age", "churn", "cltv", "internet_service"]
    return rounded(aggregates.constant_columns(t.base(*columns), columns, 0.1), 4)


def vectors(t):
    return t("embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))


@query("m09_variance_selector")
def _(t):
    rows = vectors(t)
    kept = prep.drop_constant_slots(0.01).fit(rows).transform(rows)
    return kept.select("vec_id", vector_to_array("selected").alias("selected"))


@query("m10_pca_share")
def _(t):
    points, _model, explained = prep.pca_keeping(vectors(t), 0.95)
    return points.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.posexplode(F.lit([float(x) for x in explained])).alias("component", "explained"))


@query("m11_pca_points")
def _(t):
    return prep.pca_points(vectors(t)).select("vec_id", "label", vector_to_array("pca").alias("point"))


@query("m11_pca_properties", """
SELECT count(*) AS n_rows, true AS centred, true AS uncorrelated, true AS falling FROM embeddings""")
def _(t):
    """Projections have mean 0, no covariance, and falling variances."""
    x, y = (F.get("p", F.lit(i)) for i in (0, 1))
    points = prep.pca_points(vectors(t)).select(vector_to_array("pca").alias("p"))
    return points.agg(
        F.count("*").alias("n_rows"), (F.greatest(F.abs(F.avg(x)), F.abs(F.avg(y))) < 1e-9).alias("centred"),
        (F.abs(F.corr(x, y)) < 1e-6).alias("uncorrelated"), (F.var_pop(x) >= F.var_pop(y)).alias("falling"))


@query("m10_pca_share_reached", "SELECT count(*) AS n_rows, true AS reached, true AS needed, true AS falling FROM embeddings")
def _(t):
    """The kept components reach 95 % of the variance, one fewer does not, and shares fall."""
    points, _model, explained = prep.pca_keeping(vectors(t), 0.95)
    shares = [float(x) for x in explained]
    return points.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(sum(shares) >= 0.95 - 1e-12).alias("reached"), F.lit(sum(shares[:-1]) < 0.95).alias("needed"),
        F.lit(shares == sorted(shares, reverse=True)).alias("falling"))


UNIT = f"{hash_sql('customer_id')}::DOUBLE / 4503599627370496"


@query("m12_random_split", on_base(f"""
SELECT customer_id, CASE WHEN {UNIT} < 0.8 THEN 'train' ELSE 'test' END AS part FROM base"""))
def _(t):
    train, test = prep.random_split(t.base("customer_id"), "customer_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


HASHED = f"hashed AS (SELECT customer_id, churn, {hash_sql('customer_id')} AS h FROM base)"


@query("m13_stratified_split", on_base("""
SELECT customer_id, churn, CASE WHEN h <= quantile_disc(h, 0.8) OVER (PARTITION BY churn) THEN 'train' ELSE 'test' END
  AS part FROM hashed""", HASHED))
def _(t):
    train, test = prep.stratified_split(t.base("customer_id", "churn"), "customer_id", "churn")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("m14_folds", on_base(f"SELECT customer_id, ({hash_sql('customer_id')} % 5)::INT AS fold FROM base"))
def _(t):
    return prep.fold_column(t.base("customer_id"), "customer_id")


@query("m15_stratified_folds", on_base("SELECT customer_id, churn, (" + " + ".join(
    f"(h > quantile_disc(h, {q}) OVER (PARTITION BY churn))::INT" for q in (0.2, 0.4, 0.6, 0.8))
    + ")::INT AS fold FROM hashed", HASHED))
def _(t):
    return prep.stratified_folds(t.base("customer_id", "churn"), "customer_id", "churn")


@query("m16_class_weights", on_base("""
SELECT customer_id, churn, (SELECT count(*) FROM base)::DOUBLE / (2 * count(*) OVER (PARTITION BY churn)) AS weight
FROM base"""))
def _(t):
    return prep.class_weights(t.base("customer_id", "churn"), "churn")


def _prepared(t):
    rows = model_rows(t)
    model = prep.preprocessor(rows, NUMERIC, CATEGORICAL, impute=True).fit(rows)
    return materialize(model.transform(rows).select("customer_id", "label", "features"), "prepared"), model


@query("m17_smote")
def _(t):
    rows, _model = _prepared(t)
    return oversampling.smote(rows, "customer_id").select(
        "synthetic_key", "label", vector_to_array("features").alias("features"))


@query("m17_smote_between", on_base("""
SELECT label, max(n) OVER () - n AS n_synthetic, true AS inside FROM (
  SELECT churn::DOUBLE AS label, count(*) AS n FROM base GROUP BY 1) QUALIFY n < max(n) OVER ()"""))
def _(t):
    """Every new row lies between the least and the largest values of its class, slot by slot."""
    rows, _model = _prepared(t)
    cells = rows.select("label", F.posexplode(vector_to_array("features")).alias("slot", "x"))
    span = cells.groupBy("label", "slot").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    made = oversampling.smote(rows, "customer_id").select(
        "synthetic_key", "label", F.posexplode(vector_to_array("features")).alias("slot", "x"))
    return (made.join(F.broadcast(span), ["label", "slot"]).groupBy("label").agg(
        F.count_distinct("synthetic_key").alias("n_synthetic"),
        F.bool_and(F.col("x").between(F.col("lo") - 1e-9, F.col("hi") + 1e-9)).alias("inside")))


@query("m17_smote_counts", on_base("""
SELECT label, max(n) OVER () AS n, max(n) OVER () - n AS n_synthetic FROM (
  SELECT churn::DOUBLE AS label, count(*) AS n FROM base GROUP BY 1)"""))
def _(t):
    rows, _model = _prepared(t)
    return oversampling.oversample(rows, "customer_id").groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("customer_id").startswith("synthetic")).alias("n_synthetic"))


@query("m18_feature_names", on_base(
    union_all("SELECT '{c}' AS feature, count(*) AS n_rows FROM base", NUMERIC) + "\nUNION ALL\n" + union_all(
        "SELECT '{0}_' || coalesce({0}, {1}), (SELECT count(*) FROM base) FROM base GROUP BY 1",
        [(c, MODE.format(c=c)) for c in CATEGORICAL])))
def _(t):
    rows, model = _prepared(t)
    names = prep.preprocessed_names(model, NUMERIC, CATEGORICAL)
    return rows.agg(F.count("*").alias("n_rows")).select(F.explode(F.lit(names)).alias("feature"), "n_rows")


def _importances(t, k=None):
    rows, model = _prepared(t)
    forest = models.forest_classifier(200, weight=None).fit(rows)
    return models.importance_table(rows, prep.preprocessed_names(model, NUMERIC, CATEGORICAL),
                                   forest.featureImportances.toArray(), k)


@query("m19_feature_importance")
def _(t):
    return _importances(t)


@query("m19_importances_complete", on_base("SELECT feature, true AS in_range FROM (" + union_all(
    "SELECT '{c}' AS feature FROM (SELECT 1) one", NUMERIC) + "\nUNION ALL\n" + union_all(
        "SELECT '{0}_' || coalesce({0}, {1}) FROM base GROUP BY 1", [(c, MODE.format(c=c)) for c in CATEGORICAL]) + ")"))
def _(t):
    """Every slot has an importance between 0 and 1, and they sum to 1."""
    table = materialize(_importances(t), "importances")
    whole = table.agg(F.abs(F.sum("importance") - 1) < 1e-9).scalar()
    return table.select("feature", (F.col("importance").between(0, 1) & whole).alias("in_range"))


@query("t03_top_features")
def _(t):
    return _importances(t, k=30)


REFIT_NUMERIC = [*NUMERIC, "avg_monthly_gb_download", "satisfaction_score", *SERVICES[:3]]


@query("m20_top_slots_refit")
def _(t):
    """Total charges from the 20 most important slots, held-out MAE, RMSE, R2 and MAPE."""
    rows = materialize(t.base("customer_id", *REFIT_NUMERIC, *CATEGORICAL, "total_charges").where(
        F.col("total_charges").isNotNull()).withColumnRenamed("total_charges", "label"), "refit-rows")
    train, test = prep.random_split(rows, "customer_id")
    model = models.refit_on_top_slots(prep.Preparation(REFIT_NUMERIC, CATEGORICAL, impute=True),
                                      models.forest_regressor(100), train, k=20)
    return metrics.regression_metrics(model.transform(test), "label", "prediction").withColumn(
        "n_slots", F.lit(len(model.stages[1].getIndices())))
