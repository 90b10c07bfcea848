"""Queries for evaluation metrics on given labels, scores and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.joins import MONTHLY, monthly_labels
from patrona.catalogue.registry import on_base, query
from patrona.ml import metrics

SCORED = "scored AS (SELECT customer_id, churn AS label, churn_score / 100e0 AS score, cltv FROM base)"


def scored(t):
    return t.base("customer_id", "churn", "churn_score").select(
        "customer_id", F.col("churn").alias("label"), (F.col("churn_score") / 100).alias("score"))


@query("e01_confusion_matrix", on_base("""
SELECT y AS label, p AS prediction, (SELECT count(*) FROM scored WHERE label = y AND (score >= 0.5)::INT = p) AS "count"
FROM (SELECT unnest([0, 1]) AS y), (SELECT unnest([0, 1]) AS p)""", SCORED))
def _(t):
    return metrics.confusion_matrix(metrics.apply_threshold(scored(t), "score", 0.5), "label", "prediction")


@query("e01_confusion_quality_toxic", """
SELECT q AS label, x AS prediction, (SELECT count(*) FROM labels WHERE quality = q AND toxic = x) AS "count"
FROM (SELECT unnest([0, 1]) AS q), (SELECT unnest([0, 1]) AS x)""")
def _(t):
    return metrics.confusion_matrix(t("labels"), "quality", "toxic")


@query("e02_classification_metrics", on_base(f"""
SELECT count(*) AS n, tp, fp, fn, tn, {rnd('(tp + tn) / count(*)')} AS accuracy, {rnd('tp / (tp + fp)')} AS precision,
  {rnd('tp / (tp + fn)')} AS recall, {rnd('2 * tp / (2 * tp + fp + fn)')} AS f1
FROM scored, (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp,
  count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
  count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn FROM scored) GROUP BY tp, fp, fn, tn""", SCORED))
def _(t):
    return rounded(metrics.classification_metrics(metrics.apply_threshold(scored(t), "score", 0.5),
                                                  "label", "prediction"))


AUC = """
SELECT {round} AS roc_auc FROM (SELECT {label} AS label,
  (rank() OVER (ORDER BY {score}) + count(*) OVER (PARTITION BY {score}) / 2e0 - 0.5e0) AS r FROM {table})"""
RANK_SUM = rnd("""(sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
  * (count(*) FILTER (WHERE label = 1) + 1) / 2e0)
  / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0))""")


@query("e03_roc_auc", on_base(AUC.format(round=RANK_SUM, label="label", score="score", table="scored"), SCORED))
def _(t):
    return rounded(metrics.roc_auc(scored(t), "label", "score"))


@query("e03_roc_auc_continuous", on_base(AUC.format(round=RANK_SUM, label="churn", score="cltv", table="base")))
def _(t):
    return rounded(metrics.roc_auc(t.base("churn", "cltv"), "churn", "cltv"))


CURVE = """
curve AS (
  SELECT threshold, tp, fp, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / positives AS recall,
    pos::DOUBLE / positives AS gain
  FROM (SELECT score AS threshold, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS positives
    FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)
    WINDOW w AS (ORDER BY score DESC)))"""


@query("e04_average_precision", on_base(
    f"SELECT {rnd('sum(gain * precision)')} AS average_precision FROM curve", SCORED, CURVE))
def _(t):
    return rounded(metrics.average_precision(scored(t), "label", "score"))


@query("e05_precision_recall_curve", on_base("""
SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, precision, recall FROM curve""", SCORED, CURVE))
def _(t):
    return metrics.precision_recall_curve(scored(t), "label", "score").drop("recall_gain")


@query("e06_threshold_for_precision", on_base("""
SELECT coalesce(min(threshold) FILTER (WHERE precision >= 0.6), 0.5e0) AS threshold FROM curve""", SCORED, CURVE))
def _(t):
    return metrics.threshold_for_precision(scored(t), "label", "score", 0.6)


@query("e06_relabelled", on_base("""
SELECT customer_id, (score >= (SELECT coalesce(min(threshold) FILTER (WHERE precision >= 0.6), 0.5e0) FROM curve))::INT
  AS prediction FROM scored""", SCORED, CURVE))
def _(t):
    rows = scored(t)
    cut = metrics.threshold_for_precision(rows, "label", "score", 0.6).scalar()
    return metrics.apply_threshold(rows, "score", cut).select("customer_id", "prediction")


ERRORS = """errors AS (SELECT total_charges AS y, total_revenue * 0.15 AS p FROM base
  WHERE total_charges IS NOT NULL AND total_revenue IS NOT NULL)"""


@query("e07_regression_metrics", on_base(f"""
SELECT {rnd('avg(abs(y - p))', 3)} AS mae, {rnd('sqrt(avg((y - p) * (y - p)))', 3)} AS rmse,
  {rnd('1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m))')} AS r2
FROM errors, (SELECT avg(y) AS m FROM errors)""", ERRORS))
def _(t):
    rows = t.base("total_charges", "total_revenue").withColumn("p", F.col("total_revenue") * 0.15)
    out = metrics.regression_metrics(rows, "total_charges", "p").drop("mape")
    return rounded(rounded(out, 3, ["mae", "rmse"]), columns=["r2"])


@query("e08_mape", on_base(f"SELECT {rnd('avg(abs((y - p) / greatest(abs(y), 1e-8))) * 100')} AS mape FROM errors",
                           ERRORS))
def _(t):
    rows = t.base("total_charges", "total_revenue").withColumn("p", F.col("total_revenue") * 0.15)
    return rounded(metrics.regression_metrics(rows, "total_charges", "p").select("mape"))


def agreement_sql(source, by=""):
    """SQL of the two agreement scores from pair counts and entropies; ``by`` is '' or 'a, b, '."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    comma = f"{part}, " if by else "PARTITION BY "
    return f"""
cells AS (SELECT {by}label_1, label_2, count(*)::DOUBLE AS n FROM {source} GROUP BY {by}label_1, label_2),
margins AS (
  SELECT *, sum(n) OVER ({comma}label_1) AS a, sum(n) OVER ({comma}label_2) AS b, sum(n) OVER ({part}) AS t FROM cells),
sums AS (
  SELECT {by}max(t) AS t, sum(n * n) AS sq, sum(n * a) AS sqa, sum(n * b) AS sqb,
    sum(n / t * ln(n * t / (a * b))) AS mi, -sum(n / t * ln(a / t)) AS ha, -sum(n / t * ln(b / t)) AS hb
  FROM margins {group}),
agreement AS (
  SELECT {by}t::BIGINT AS n_common,
    CASE WHEN sqa = sq AND sqb = sq THEN 1e0 ELSE
      2 * ((sq - t) * (t * t - sqa - sqb + sq) - (sqa - sq) * (sqb - sq))
      / ((sqa - t) * (t * t - sqb) + (sqb - t) * (t * t - sqa)) END AS ari,
    CASE WHEN ha < 1e-14 AND hb < 1e-14 THEN 1e0 WHEN mi <= 1e-12 THEN 0e0 ELSE mi / ((ha + hb) / 2) END AS nmi
  FROM sums)"""


@query("e11_cluster_stability", f"""
WITH {MONTHLY}, {agreement_sql('pairs', 'period_1, period_2, ')}
SELECT period_1, period_2, n_common, {rnd('ari')} AS ari, {rnd('nmi')} AS nmi FROM agreement""")
def _(t):
    return rounded(metrics.cluster_stability(monthly_labels(t), "o_custkey", "period", "cluster"))


@query("e12_label_agreement", f"""
WITH both_labels AS (SELECT o_orderstatus AS label_1, o_orderpriority AS label_2 FROM orders),
{agreement_sql('both_labels')}
SELECT n_common, {rnd('ari')} AS ari, {rnd('nmi')} AS nmi FROM agreement""")
def _(t):
    return rounded(metrics.label_agreement(t("orders"), "o_orderstatus", "o_orderpriority"))
