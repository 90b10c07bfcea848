"""Queries for feature expressions and feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.registry import FEEDBACK_CTE, on_base, query
from patrona.functions import features
from patrona.operators import aggregates
from patrona.sources.tables import BASE_COLUMNS

BUCKET_3 = """CASE WHEN tenure_in_months < 12 THEN '<1yr'
  WHEN tenure_in_months >= 12 AND tenure_in_months < 24 THEN '1-2yr' ELSE '2+yrs' END"""
BUCKET_4 = """CASE WHEN tenure_in_months < 12 THEN '0-12 Months'
  WHEN tenure_in_months >= 12 AND tenure_in_months < 24 THEN '12-24 Months'
  WHEN tenure_in_months >= 24 AND tenure_in_months < 48 THEN '24-48 Months' ELSE '48+ Months' END"""
HIGH = "CASE WHEN monthly_charge > 80 THEN 1 ELSE 0 END"


def _ones(columns):
    return " + ".join(f"CASE WHEN {c} = 1 THEN 1 ELSE 0 END" for c in columns)


def _present(columns):
    return [c for c in columns if c in BASE_COLUMNS]


VALUE = _present(features.VALUE_COLUMNS)
CHURN = _present(features.CHURN_COLUMNS)
SEGMENT = _present(features.SEGMENT_COLUMNS)


@query("p06_value_features", on_base(f"""
SELECT {', '.join(VALUE)}, {BUCKET_3} AS tenure_bucket, total_revenue / (tenure_in_months + 1) AS avg_revenue_per_month,
  total_charges / (total_revenue + 1) AS total_spend_ratio, {HIGH} AS is_high_spender,
  {_ones(features.VALUE_SERVICES)} AS num_services,
  monthly_charge * tenure_in_months AS monthly_charge_x_tenure, {rnd('ln(1 + total_revenue)', 6)} AS log_total_revenue
FROM base"""))
def _(t):
    return rounded(features.value_features(t.base(*VALUE)), columns=["log_total_revenue"])


@query("p06_churn_features", on_base(f"""
SELECT {', '.join(CHURN)}, {BUCKET_3} AS tenure_bucket, {_ones(features.CHURN_SERVICES)} AS num_services_subscribed
FROM base"""))
def _(t):
    return features.churn_features(t.base(*CHURN))


@query("p06_segment_features", on_base(f"""
SELECT {', '.join(SEGMENT)}, {BUCKET_4} AS tenure_bucket,
  total_revenue / CASE WHEN tenure_in_months > 0 THEN tenure_in_months ELSE 1 END AS avg_revenue_per_month,
  total_charges / CASE WHEN total_revenue > 0 THEN total_revenue ELSE 1 END AS total_spend_ratio,
  {HIGH} AS is_high_spender, {' + '.join(features.SEGMENT_SERVICES)} AS num_services,
  monthly_charge * tenure_in_months AS monthly_charge_x_tenure, {rnd('ln(1 + total_revenue)', 6)} AS log_total_revenue
FROM base"""))
def _(t):
    return rounded(features.segment_features(t.base(*SEGMENT)), columns=["log_total_revenue"])


def _expression(name, inputs, column, sql, alias, digits=None):
    """One derived column over the base view, beside the customer key."""
    text = rnd(sql, digits) if digits else sql

    @query(name, on_base(f"SELECT customer_id, {text} AS {alias} FROM base"))
    def _(t):
        value = column()
        return t.base("customer_id", *inputs).select("customer_id",
                                                     (F.round(value, digits) if digits else value).alias(alias))


_expression("c01_tenure_bucket_3", ["tenure_in_months"], features.tenure_bucket_3, BUCKET_3, "tenure_bucket")
_expression("c02_tenure_bucket_4", ["tenure_in_months"], features.tenure_bucket_4, BUCKET_4, "tenure_bucket")
_expression("c03_tenure_group", ["tenure_in_months"], features.tenure_group, """
CASE WHEN tenure_in_months < 12 THEN '<1 year' WHEN tenure_in_months BETWEEN 12 AND 24 THEN '1-2 years'
  ELSE '2+ years' END""", "tenure_group")
_expression("c04_age_group", ["age"], features.age_group,
            "CASE WHEN age < 30 THEN 'Under 30' WHEN age <= 50 THEN '30-50' ELSE '50+' END", "age_group")
_expression("c05_satisfaction_bucket", ["satisfaction_score"], features.satisfaction_bucket, """
CASE WHEN satisfaction_score <= 2 THEN 'Low' WHEN satisfaction_score <= 3.5 THEN 'Medium'
  WHEN satisfaction_score > 3.5 THEN 'High' END""", "satisfaction_bucket")
_expression("c06_revenue_per_month", ["total_revenue", "tenure_in_months"], features.revenue_per_month,
            "total_revenue / (tenure_in_months + 1)", "avg_revenue_per_month")
_expression("c07_revenue_per_month_guarded", ["total_revenue", "tenure_in_months"], features.revenue_per_month_guarded,
            "total_revenue / greatest(coalesce(tenure_in_months, 1), 1)", "avg_revenue_per_month")
_expression("c08_spend_ratio", ["total_charges", "total_revenue"], features.spend_ratio,
            "total_charges / (total_revenue + 1)", "total_spend_ratio")
_expression("c08_spend_ratio_guarded", ["total_charges", "total_revenue"], features.spend_ratio_guarded,
            "total_charges / CASE WHEN total_revenue > 0 THEN total_revenue ELSE 1 END", "total_spend_ratio")
_expression("c09_high_spender", ["monthly_charge"], features.high_spender, HIGH, "is_high_spender")
_expression("c10_service_count", features.VALUE_SERVICES, features.service_count, _ones(features.VALUE_SERVICES),
            "num_services")
_expression("c11_service_count_text", features.CHURN_SERVICES, features.service_count_text,
            _ones(features.CHURN_SERVICES), "num_services")
_expression("c12_service_sum", features.SEGMENT_SERVICES, features.service_sum, " + ".join(features.SEGMENT_SERVICES),
            "num_services")
_expression("c13_charge_x_tenure", ["monthly_charge", "tenure_in_months"], features.charge_x_tenure,
            "monthly_charge * tenure_in_months", "monthly_charge_x_tenure")
_expression("c14_log_revenue", ["total_revenue"], lambda: F.log1p("total_revenue"), "ln(1 + total_revenue)",
            "log_total_revenue", 6)
_expression("c14_log_and_back", ["total_revenue"], lambda: F.expm1(F.log1p("total_revenue")), "total_revenue",
            "total_revenue", 4)
_expression("c23_round_2", ["monthly_charge"], lambda: F.round("monthly_charge", 2),
            rnd("monthly_charge", 2), "monthly_charge")
_expression("c24_month", ["last_order"], lambda: features.month_of("last_order"),
            "date_trunc('month', last_order)::DATE", "month")


@query("c15_trim_texts", on_base("SELECT customer_id, feedback_score, loyalty_level FROM feedback", FEEDBACK_CTE))
def _(t):
    return features.trim_texts(t.feedback(), ["feedback_score", "loyalty_level"]).select(
        "customer_id", "feedback_score", "loyalty_level")


SCORE = "CASE lower(feedback_score) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END"
LOYALTY = "CASE lower(loyalty_level) WHEN 'bronze' THEN 1 WHEN 'silver' THEN 2 WHEN 'gold' THEN 3 END"


@query("c16_feedback_ordinal", on_base(f"SELECT customer_id, {SCORE} AS level FROM feedback", FEEDBACK_CTE))
def _(t):
    return t.feedback().select("customer_id", features.ordinal("feedback_score", features.SCORE_LEVELS).alias("level"))


@query("c17_loyalty_ordinal", on_base(f"SELECT customer_id, {LOYALTY} AS level FROM feedback", FEEDBACK_CTE))
def _(t):
    return t.feedback().select("customer_id", features.ordinal("loyalty_level", features.LOYALTY_LEVELS).alias("level"))


@query("c18_number_from_text", on_base("SELECT customer_id, age, income FROM feedback", FEEDBACK_CTE))
def _(t):
    return t.feedback().select("customer_id", features.number_from_text("age").alias("age"),
                               features.number_from_text("income").alias("income"))


@query("c19_quality_average", on_base(
    "SELECT customer_id, (product_quality + service_quality) / 2 AS quality_avg FROM feedback", FEEDBACK_CTE))
def _(t):
    return t.feedback().select(
        "customer_id", features.number_from_text("product_quality").alias("product_quality"),
        features.number_from_text("service_quality").alias("service_quality")).select(
        "customer_id", features.quality_average().alias("quality_avg"))


@query("c20_feedback_number", on_base(f"""
SELECT customer_id, {SCORE}::DOUBLE AS by_level, service_quality AS by_number FROM feedback""", FEEDBACK_CTE))
def _(t):
    return t.feedback().select("customer_id", features.feedback_number("feedback_score").alias("by_level"),
                               features.feedback_number("service_quality").alias("by_number"))


ENGAGEMENT = """coalesce(purchase_frequency, 0) * 0.6e0
  + coalesce(satisfaction_score, (SELECT avg(satisfaction_score) FROM feedback)) * 0.4e0"""


@query("c21_engagement", on_base(f"SELECT customer_id, {rnd(ENGAGEMENT)} AS engagement_score FROM feedback",
                                 FEEDBACK_CTE))
def _(t):
    clean = t.feedback().select("customer_id", *[features.number_from_text(c).alias(c)
                                                 for c in ("purchase_frequency", "satisfaction_score")])
    return rounded(clean.select("customer_id", features.engagement(clean).alias("engagement_score")))


@query("c22_casts", on_base("""
SELECT customer_id, (offer IS NULL)::INT AS flag, tenure_in_months::VARCHAR AS tenure, income FROM base
JOIN (SELECT customer_id, income FROM feedback) USING (customer_id)""", FEEDBACK_CTE))
def _(t):
    numbers = t.base("customer_id", "offer", "tenure_in_months").select(
        "customer_id", F.col("offer").isNull().cast("int").alias("flag"),
        F.col("tenure_in_months").cast("string").alias("tenure"))
    return numbers.join(t.feedback().select(
        "customer_id", F.regexp_replace("income", ",", "").try_cast("double").alias("income")), "customer_id")


@query("c15_feedback_features", on_base(f"""
SELECT *, {SCORE} AS feedback_score_num, {LOYALTY} AS loyalty_level_clean,
  (product_quality + service_quality) / 2 AS quality_avg, {rnd(ENGAGEMENT)} AS engagement_score,
  {rnd('ln(1 + coalesce(income, 0))')} AS income_log,
  CASE WHEN satisfaction_score <= 2 THEN 'Low' WHEN satisfaction_score <= 3.5 THEN 'Medium'
    WHEN satisfaction_score > 3.5 THEN 'High' END AS satisfaction_bucket
FROM feedback""", FEEDBACK_CTE))
def _(t):
    return rounded(features.feedback_features(t.feedback()), columns=["engagement_score", "income_log"])


@query("a28_fill_with_mean", on_base("""
SELECT customer_id, coalesce(satisfaction_score, round((SELECT avg(satisfaction_score) FROM feedback), 6))
  AS satisfaction_score FROM feedback""", FEEDBACK_CTE))
def _(t):
    clean = t.feedback().select("customer_id", features.number_from_text("satisfaction_score")
                                .alias("satisfaction_score"))
    return rounded(aggregates.fill_with_mean(clean, "satisfaction_score"))
