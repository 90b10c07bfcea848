"""Batch scoring: request rows in, scored rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.functions import rules
from patrona.ml.identity import ranked_clusters
from patrona.ml.models import best_kmeans, probability, with_centroid_distance
from patrona.operators.distribution import histogram
from patrona.operators.joins import attach, map_label
from patrona.session import materialize

CHURN_FIELDS = ["tenure", "monthly_charges", "total_charges"]
SEGMENT_FIELDS = ["recency", "frequency", "monetary", "tenure"]
FEEDBACK_FIELDS = ["sentiment_score", "rating", "response_time", "resolution_time"]
#: What makes a segment or a feedback level come first: the sign of each field.
SEGMENT_DIRECTION = [-1, 1, 1, 1]
FEEDBACK_DIRECTION = [1, 1, -1, -1]


def _with_rejected(scored: DataFrame, rejected: DataFrame) -> DataFrame:
    """Scored requests, and the rejected ones with the name of their bad field and no score."""
    return scored.withColumn("bad_field", F.lit(None).cast("string")).unionByName(
        rejected.select("request_id", "bad_field"), allowMissingColumns=True)


def score_churn(requests: DataFrame, model: Model | None = None) -> DataFrame:
    """(request_id, prediction, probability, risk_level, bad_field) by model, or by rule without one.

    Every request comes back; one with a field that is no number has ``bad_field`` and null scores.
    """
    rows, rejected = rules.split_bad_numbers(requests, CHURN_FIELDS)
    if model is not None:
        scored = model.transform(rows).withColumns({"_p": probability(), "_class": F.col("prediction").cast("int")})
    else:
        risk = rules.churn_rule_score("monthly_charges", "tenure", "contract_type")
        scored = rows.withColumn("_risk", risk).withColumns({
            "_p": F.least("_risk", F.lit(0.9)), "_class": (F.col("_risk") > 0.5).cast("int")})
    return _with_rejected(scored.select(
        "request_id", F.col("_class").alias("prediction"), F.col("_p").alias("probability"),
        rules.risk_level(F.col("_p")).alias("risk_level")), rejected)


def score_value(requests: DataFrame, model: Model | None = None) -> DataFrame:
    """(request_id, cltv, value_category, bad_field) by model, or by rule without one; as B06 for bad fields."""
    rows, rejected = rules.split_bad_numbers(requests, CHURN_FIELDS)
    if model is not None:
        scored = model.transform(rows).withColumn("cltv", F.col("prediction"))
    else:
        scored = rows.withColumn("cltv", rules.value_rule("monthly_charges", "tenure", "service_type"))
    return _with_rejected(
        scored.select("request_id", "cltv", rules.value_category(F.col("cltv")).alias("value_category")), rejected)


def rfm(orders: DataFrame, customer: str, order_date: str, amount: str) -> DataFrame:
    """Recency in days, frequency, monetary value and tenure in months per customer."""
    last = orders.agg(F.max(order_date)).scalar()
    total = F.sum(F.rint(F.col(amount) * 100).cast("long")) / F.lit(100.0)
    return orders.groupBy(F.col(customer).alias("customer_id")).agg(
        F.datediff(last, F.max(order_date)).alias("recency"), F.count("*").alias("frequency"),
        (total / F.count("*")).alias("monetary"), (2 * F.count("*")).alias("tenure"))


def fit_segments(rows: DataFrame, fields: Sequence[str], direction: Sequence[float] | None = None, k: int = 5, seed: int = 42,
                 starts: int = 5, repeats: int = 1) -> PipelineModel:
    """Scaling and k-means over the given numeric fields; a missing field counts as 0.

    Of several starts the one of least inertia is kept (``repeats``: see ``best_kmeans``), and clusters are numbered by
    their centres along ``direction`` (the sum of the fields without one), the highest first,
    so that a name does not hang on the seed.
    """
    filled = ", ".join(f"nanvl(coalesce(double(`{c}`), 0D), 0D) AS `_{c}`" for c in fields)
    stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
              VectorAssembler(inputCols=[f"_{c}" for c in fields], outputCol="_raw"),
              StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol="_scaled")]
    prepared = Pipeline(stages=stages).fit(rows)
    scaled = materialize(prepared.transform(rows).select("_scaled"), "segment-rows")
    model = best_kmeans(scaled, k, starts, "_scaled", seed, repeats)
    return ranked_clusters(PipelineModel(stages=[*prepared.stages, model]), direction or [1.0] * len(fields))


def score_segments(rows: DataFrame, model: Model, key: str = "customer_id") -> DataFrame:
    """(key, segment_id, segment_name, recommendations), the last a list."""
    cluster = F.col("cluster")
    return model.transform(rows).select(
        key, cluster.alias("segment_id"), map_label(cluster, rules.SEGMENT_NAMES, "Unknown").alias("segment_name"),
        F.split(map_label(cluster, rules.SEGMENT_ADVICE, rules.DEFAULT_ADVICE), "; ").alias("recommendations"))


def score_feedback(rows: DataFrame, model: Model, key: str = "request_id") -> DataFrame:
    """(key, feedback_cluster, satisfaction_level, action_required)."""
    cluster = F.col("cluster")
    return model.transform(rows).select(
        key, cluster.alias("feedback_cluster"),
        map_label(cluster, rules.FEEDBACK_LEVELS, "Unknown").alias("satisfaction_level"),
        rules.action_required(cluster).alias("action_required"))


def labelled_segments(df: DataFrame, model, key: str, keep: Sequence[str] = (), features: str = "features") -> DataFrame:
    """(key, cluster_kmeans, dist_to_centroid, kept columns) of a fitted k-means model."""
    assigned = model.transform(df).withColumnRenamed(model.getPredictionCol(), "cluster_kmeans")
    centers = [c.tolist() for c in model.clusterCenters()]
    return with_centroid_distance(assigned, centers, features).select(key, "cluster_kmeans", "dist_to_centroid", *keep)


def enriched_value_rows(df: DataFrame, segments: DataFrame, churn_scores: DataFrame, key: str) -> DataFrame:
    """Customer rows with cluster, distance to its centre and churn probability, joined by key."""
    cluster = segments.select(key, F.col("cluster_kmeans").cast("string").alias("cluster_kmeans"), "dist_to_centroid")
    return attach(attach(df, cluster, key), churn_scores.select(key, "churn_proba"), key)


def cluster_actions(df: DataFrame, cluster: str) -> DataFrame:
    """(cluster, name, action, n) for the clusters that occur."""
    return (df.groupBy(cluster).agg(F.count("*").alias("n"))
            .select(cluster, "n", map_label(F.col(cluster).cast("int"), rules.CLUSTER_NAMES).alias("name"),
                    map_label(F.col(cluster).cast("int"), rules.CLUSTER_ACTIONS).alias("action")).orderBy(cluster))


def churn_split(df: DataFrame, churn: str = "churn") -> DataFrame:
    """Customers who stayed and who left."""
    name = F.when(F.col(churn) == 1, "Churned").otherwise("Retained")
    return df.groupBy(name.alias("status")).agg(F.count("*").alias("n"))


def value_histogram(df: DataFrame, column: str = "cltv", bins: int = 30) -> DataFrame:
    """Lifetime values in 30 bins."""
    return histogram(df, [column], bins)


def segment_counts(df: DataFrame, cluster: str) -> DataFrame:
    """Customers per named segment."""
    name = map_label(F.col(cluster).cast("int"), rules.SEGMENT_NAMES, "Unknown")
    return df.groupBy(name.alias("segment_name")).agg(F.count("*").alias("n"))
