"""Queries for batch scoring and segment outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.aggregates import _histogram_sql
from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.models import HELD_OUT, QUICK_TREES, STARTS, TREES, churn_preparation, churn_rows, hold_out
from patrona.catalogue.prep import HASHED
from patrona.catalogue.registry import REQUEST_CTE, on_base, query
from patrona.catalogue.rules import TYPED
from patrona.functions import rules
from patrona.ml import metrics, models, prep
from patrona.ml.preparation import BalancedWeights, with_model
from patrona.operators import aggregates
from patrona.plans import scoring
from patrona.session import materialize


RISK = """(CASE WHEN monthly_charges > 80 THEN 0.3e0 ELSE 0e0 END + CASE WHEN tenure < 12 THEN 0.4e0 ELSE 0e0 END
  + CASE WHEN contract_type = 'Month-to-month' THEN 0.3e0 ELSE 0e0 END)"""

REFUSED = """
refused AS (
  SELECT request_id, CASE WHEN tenure_state = 'bad' THEN 'tenure' ELSE 'monthly_charges' END AS bad_field
  FROM requests WHERE tenure_state = 'bad' OR charge_state = 'empty')
"""


def _forest(t):
    """Balanced forest of the training folds, and all rows."""
    rows = churn_rows(t)
    train, test = hold_out(rows)
    return models.fit_pipeline(churn_preparation(), models.forest_classifier(TREES), train, BalancedWeights()), rows, test


@query("b01_score_all_customers")
def _(t):
    model, rows, _test = _forest(t)
    return models.score_rows(model, rows, "customer_id", threshold=0.6)


@query("b02_hold_out_predictions")
def _(t):
    model, _rows, test = _forest(t)
    return models.score_rows(model, test, "customer_id").withColumnRenamed("customer_id", "Customer_ID")


def _churn_scores(t):
    """Churn probability of every customer by a pipeline fitted without the customer's fold."""
    pipeline = with_model(churn_preparation(), models.logistic(), BalancedWeights())
    return models.out_of_fold_scores(pipeline.fit, churn_rows(t), "customer_id", "fold", 5)


@query("b03_out_of_fold_churn")
def _(t):
    return t.base("customer_id", "cltv").join(_churn_scores(t), "customer_id", "left")


def _segments(t):
    numeric = ["age", "tenure_in_months", "monthly_charge", "total_revenue", "cltv"]
    rows = materialize(t.base("customer_id", *numeric, "contract"), "segment-rows")
    prepared = prep.preprocessor(rows, numeric, ["contract"], impute=True).fit(rows).transform(rows)
    model = models.best_kmeans(materialize(prepared, "segment-vectors"), 3, starts=STARTS)
    return scoring.labelled_segments(prepared, model, "customer_id", ["contract", "monthly_charge"])


@query("b04_labelled_segments")
def _(t):
    return _segments(t)


@query("b02_hold_out_consistent", on_base("SELECT customer_id, true AS consistent FROM held_out", HASHED, HELD_OUT))
def _(t):
    """The held-out rows, each with a probability and the class that the threshold makes of it."""
    model, _rows, test = _forest(t)
    scored = models.score_rows(model, test, "customer_id", threshold=0.5)
    return scored.select("customer_id", (F.col("churn_proba").between(0, 1) & (
        F.col("churn_pred") == (F.col("churn_proba") >= 0.5).cast("int"))).alias("consistent"))


@query("b03_out_of_fold_complete", on_base("SELECT customer_id, cltv, true AS scored FROM base"))
def _(t):
    """Every customer has one score of a model that did not see the customer."""
    return t.base("customer_id", "cltv").join(_churn_scores(t), "customer_id", "left").select(
        "customer_id", "cltv", F.coalesce(F.col("churn_proba").between(0, 1), F.lit(False)).alias("scored"))


@query("b04_segments_nearest", on_base("SELECT customer_id, contract, true AS known FROM base"))
def _(t):
    return _segments(t).select("customer_id", "contract", (
        F.col("cluster_kmeans").between(0, 2) & (F.col("dist_to_centroid") >= 0)).alias("known"))


@query("b06_model_consistent", on_base("""
SELECT request_id, true AS consistent, NULL::VARCHAR AS bad_field FROM typed
UNION ALL SELECT request_id, true, bad_field FROM refused""", REQUEST_CTE, TYPED, REFUSED))
def _(t):
    """Requests scored by the model: the level belongs to the probability, and a rejected one has no score."""
    level = rules.risk_level(F.col("probability"))
    return _scored_by_model(t).select("request_id", F.when(F.col("bad_field").isNull(), (
        F.col("risk_level") == level) & (F.col("prediction") == (F.col("probability") > 0.5).cast("int")))
        .otherwise(F.col("probability").isNull()).alias("consistent"), "bad_field")


@query("b03_enriched_value_model")
def _(t):
    """Total charges from customer columns, cluster, centre distance and out-of-fold churn probability."""
    numeric = ["age", "tenure_in_months", "monthly_charge", "satisfaction_score"]
    scores = _churn_scores(t)
    base = t.base("customer_id", *numeric, "gender", "payment_method", "total_charges").where(
        F.col("total_charges").isNotNull()).withColumnRenamed("total_charges", "label")
    rows = materialize(prep.fold_column(scoring.enriched_value_rows(base, _segments(t), scores, "customer_id"),
                                        "customer_id"), "enriched")
    train, test = rows.where(F.col("fold") != 0), rows.where(F.col("fold") == 0)
    prepare = prep.preprocessor(train, [*numeric, "churn_proba", "dist_to_centroid"],
                                ["gender", "payment_method", "cluster_kmeans"], impute=True)
    model = models.fit_pipeline(prepare, models.forest_regressor(QUICK_TREES), train)
    return metrics.regression_metrics(model.transform(test), "label", "prediction")


def _cases(labels):
    return " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())


@query("b05_cluster_actions", on_base(f"""
SELECT cluster, count(*) AS n, CASE cluster {_cases(rules.CLUSTER_NAMES)} END AS name,
  CASE cluster {_cases(rules.CLUSTER_ACTIONS)} END AS action
FROM (SELECT satisfaction_score - 1 AS cluster FROM base) GROUP BY 1"""))
def _(t):
    clusters = t.base("satisfaction_score").select((F.col("satisfaction_score") - 1).alias("cluster"))
    return scoring.cluster_actions(clusters, "cluster")


@query("b06_score_churn_requests", on_base(f"""
SELECT request_id, (risk > 0.5)::INT AS prediction, least(risk, 0.9e0) AS probability,
  CASE WHEN least(risk, 0.9e0) > 0.7 THEN 'High' WHEN least(risk, 0.9e0) > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level,
  NULL::VARCHAR AS bad_field
FROM (SELECT request_id, {RISK} AS risk FROM typed)
UNION ALL SELECT request_id, NULL, NULL, NULL, bad_field FROM refused""", REQUEST_CTE, TYPED, REFUSED))
def _(t):
    return scoring.score_churn(t.requests())


def _scored_by_model(t):
    rows = materialize(t.base("customer_id", "tenure_in_months", "monthly_charge", "total_charges", "churn").select(
        F.col("tenure_in_months").cast("double").alias("tenure"), F.col("monthly_charge").alias("monthly_charges"),
        "total_charges", F.col("churn").cast("double").alias("label")).dropna(), "request-rows")
    prepare = prep.preprocessor(rows, scoring.CHURN_FIELDS, [])
    model = models.fit_pipeline(prepare, models.logistic(weight=None), rows)
    return scoring.score_churn(t.requests(), model)


@query("b06_score_churn_by_model")
def _(t):
    return _scored_by_model(t)


@query("b07_score_value_requests", on_base("""
SELECT request_id, cltv, CASE WHEN cltv > 5000 THEN 'High Value' WHEN cltv > 2000 THEN 'Medium Value' ELSE 'Low Value'
  END AS value_category, NULL::VARCHAR AS bad_field FROM (SELECT request_id, monthly_charges * greatest(tenure * 2, 24)
  * CASE service_type WHEN 'Premium' THEN 1.5e0 WHEN 'Standard' THEN 1.2e0 ELSE 1e0 END AS cltv FROM typed)
UNION ALL SELECT request_id, NULL, NULL, bad_field FROM refused""", REQUEST_CTE, TYPED, REFUSED))
def _(t):
    return scoring.score_value(t.requests())


@query("b08_rfm_inputs", """
SELECT o_custkey AS customer_id,
  date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders))::INT AS recency, count(*) AS frequency,
  sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / 100e0 / count(*) AS monetary, 2 * count(*) AS tenure
FROM orders GROUP BY 1""")
def _(t):
    return scoring.rfm(t("orders"), "o_custkey", "o_orderdate", "o_totalprice")


@query("b08_rfm_segments")
def _(t):
    rows = materialize(scoring.rfm(t("orders"), "o_custkey", "o_orderdate", "o_totalprice"), "rfm")
    return scoring.score_segments(rows, scoring.fit_segments(rows, scoring.SEGMENT_FIELDS, scoring.SEGMENT_DIRECTION))


@query("b08_segments_of_two_fits", """
SELECT o_custkey AS customer_id, true AS same_segment FROM orders GROUP BY 1""")
def _(t):
    """Every customer keeps the segment when the model is fitted again from another seed."""
    rows = materialize(scoring.rfm(t("orders"), "o_custkey", "o_orderdate", "o_totalprice"), "rfm")
    first, second = (scoring.score_segments(rows, scoring.fit_segments(
        rows, scoring.SEGMENT_FIELDS, scoring.SEGMENT_DIRECTION, k=2, seed=seed, repeats=3)) for seed in (42, 7))
    return first.join(second.select("customer_id", F.col("segment_name").alias("again")), "customer_id").select(
        "customer_id", (F.col("segment_name") == F.col("again")).alias("same_segment"))


@query("b09_feedback_clusters")
def _(t):
    rows = materialize(t.requests().select("request_id", *scoring.FEEDBACK_FIELDS), "feedback-rows")
    return scoring.score_feedback(rows, scoring.fit_segments(rows, scoring.FEEDBACK_FIELDS, scoring.FEEDBACK_DIRECTION))


@query("b10_churn_split", on_base("""
SELECT CASE WHEN churn = 1 THEN 'Churned' ELSE 'Retained' END AS status, count(*) AS n FROM base GROUP BY 1"""))
def _(t):
    return scoring.churn_split(t.base("churn"))


@query("b10_value_histogram", on_base(_histogram_sql("cltv", "base", 30)))
def _(t):
    return scoring.value_histogram(t.base("cltv"))


@query("b10_segment_counts", on_base(f"""
SELECT CASE satisfaction_score - 1 {_cases(rules.SEGMENT_NAMES)} ELSE 'Unknown' END AS segment_name, count(*) AS n
FROM base GROUP BY 1"""))
def _(t):
    clusters = t.base("satisfaction_score").select((F.col("satisfaction_score") - 1).alias("cluster"))
    return scoring.segment_counts(clusters, "cluster")


@query("b03_value_features", on_base(f"""
SELECT contract, {rnd('avg(cltv)')} AS cltv, {rnd('avg(churn)')} AS churn_proba FROM base GROUP BY 1"""))
def _(t):
    scores = t.base("customer_id", "churn").withColumnRenamed("churn", "churn_proba")
    joined = t.base("customer_id", "contract", "cltv").join(scores, "customer_id", "left")
    return rounded(aggregates.cluster_relevance(joined, "contract", ["cltv", "churn_proba"]))
