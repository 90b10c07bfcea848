"""Queries for scoring rules, bands, sentiment and request checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.registry import REQUEST_CTE, on_base, query
from patrona.functions import rules

REQUEST_NUMBERS = ["tenure", "monthly_charges", "total_charges"]
# A customer without orders has no tenure and no charges; missing fields count as 0.
TYPED = """
typed AS (
  SELECT request_id, CASE WHEN tenure_state = 'missing' THEN 0 ELSE coalesce(tenure, 0) END AS tenure,
    coalesce(monthly_charges, 0) AS monthly_charges, coalesce(total_charges, 0) AS total_charges,
    contract_type, service_type
  FROM requests WHERE tenure_state <> 'bad' AND charge_state <> 'empty')
"""


@query("c25_request_defaults", on_base(
    "SELECT request_id, tenure, monthly_charges, total_charges FROM typed", REQUEST_CTE, TYPED))
def _(t):
    good, _bad = rules.split_bad_numbers(t.requests(), REQUEST_NUMBERS)
    return good.select("request_id", *REQUEST_NUMBERS)


@query("c25_request_rejects", on_base("""
SELECT request_id, CASE WHEN tenure_state = 'bad' THEN 'tenure' ELSE 'monthly_charges' END AS bad_field
FROM requests WHERE tenure_state = 'bad' OR charge_state = 'empty'""", REQUEST_CTE))
def _(t):
    _good, bad = rules.split_bad_numbers(t.requests(), REQUEST_NUMBERS)
    return bad.select("request_id", "bad_field")


SCORE = """(CASE WHEN monthly_charge > 80 THEN 0.3e0 ELSE 0e0 END + CASE WHEN tenure_in_months < 12 THEN 0.4e0 ELSE 0e0
  END + CASE WHEN contract = 'BUILDING' THEN 0.3e0 ELSE 0e0 END)"""


@query("c26_churn_rule_score", on_base(f"SELECT customer_id, {SCORE} AS score FROM base"))
def _(t):
    return t.base("customer_id", "monthly_charge", "tenure_in_months", "contract").select(
        "customer_id", rules.churn_rule_score("monthly_charge", "tenure_in_months", "contract", "BUILDING")
        .alias("score"))


@query("c27_risk_level", on_base(f"""
SELECT customer_id, CASE WHEN {SCORE} > 0.7 THEN 'High' WHEN {SCORE} > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM base"""))
def _(t):
    score = rules.churn_rule_score("monthly_charge", "tenure_in_months", "contract", "BUILDING")
    return t.base("customer_id", "monthly_charge", "tenure_in_months", "contract").select(
        "customer_id", rules.risk_level(score).alias("risk_level"))


@query("c28_class_risk", on_base("""
SELECT customer_id, CASE WHEN churn = 1 THEN 'High' ELSE 'Low' END AS risk,
  CASE WHEN churn = 1 THEN 'Immediate retention action needed' ELSE 'Customer likely to stay' END AS advice
FROM base"""))
def _(t):
    return t.base("customer_id", "churn").select(
        "customer_id", rules.class_risk(F.col("churn")).alias("risk"), rules.class_advice(F.col("churn")).alias("advice"))


@query("c29_value_rule", on_base("""
SELECT request_id, spending * greatest(CASE WHEN tenure_state = 'missing' THEN 0 ELSE coalesce(tenure, 0) END * 2, 24)
  * CASE service_type WHEN 'Premium' THEN 1.5e0 WHEN 'Standard' THEN 1.2e0 ELSE 1e0 END AS value
FROM requests WHERE tenure_state <> 'bad'""", REQUEST_CTE))
def _(t):
    rows = t.requests().withColumn("tenure", rules.request_number("tenure")).where(F.col("tenure").isNotNull())
    return rows.select("request_id", rules.value_rule("spending", "tenure", "service_type").alias("value"))


@query("c30_value_category", on_base("""
SELECT customer_id, CASE WHEN cltv > 5000 THEN 'High Value' WHEN cltv > 2000 THEN 'Medium Value' ELSE 'Low Value' END
  AS category, CASE WHEN cltv > 5000 THEN 'VIP treatment & premium offers' WHEN cltv > 2000
  THEN 'Upselling opportunities' ELSE 'Basic retention efforts' END AS strategy FROM base"""))
def _(t):
    return t.base("customer_id", "cltv").select(
        "customer_id", rules.value_category(F.col("cltv")).alias("category"),
        rules.value_strategy(F.col("cltv")).alias("strategy"))


@query("c31_value_band", on_base("""
SELECT customer_id, CASE WHEN cltv >= 6000 THEN 'High' WHEN cltv >= 3000 THEN 'Medium' ELSE 'Low' END AS band
FROM base"""))
def _(t):
    return t.base("customer_id", "cltv").select("customer_id", rules.value_band(F.col("cltv")).alias("band"))


SEGMENT = """CASE WHEN income > 70000 AND frequency = 'High' THEN 'Premium Users'
  WHEN income > 40000 AND frequency = 'Medium' THEN 'Regular Users' WHEN income < 40000 THEN 'Budget Users'
  ELSE 'Occasional Users' END"""


@query("c32_rule_segment", on_base(f"""
SELECT request_id, {SEGMENT} AS segment, CASE {SEGMENT}
  {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.RULE_SEGMENTS.items())} END AS description
FROM requests""", REQUEST_CTE))
def _(t):
    from patrona.operators.joins import map_label
    segment = rules.rule_segment("income", "frequency")
    return t.requests().select("request_id", segment.alias("segment")).withColumn(
        "description", map_label("segment", rules.RULE_SEGMENTS))


def _hits(words):
    return " + ".join(f"contains(lower(text), '{w}')::INT" for w in words)


MOOD = """CASE WHEN rating >= 4 OR good > bad THEN 'Positive' WHEN rating <= 2 OR bad > good THEN 'Negative'
  ELSE 'Neutral' END"""


@query("c33_sentiment", f"""
SELECT doc_id, good, bad, {MOOD} AS sentiment FROM (
  SELECT doc_id, 1 + doc_id % 5 AS rating, {_hits(rules.POSITIVE_WORDS)} AS good, {_hits(rules.NEGATIVE_WORDS)} AS bad
  FROM documents)""")
def _(t):
    counted = t("documents").select("doc_id", (1 + F.col("doc_id") % 5).alias("rating"),
                                    rules.word_count(F.col("text"), rules.POSITIVE_WORDS).alias("good"),
                                    rules.word_count(F.col("text"), rules.NEGATIVE_WORDS).alias("bad"))
    return counted.select("doc_id", "good", "bad", rules.sentiment_of(
        F.col("good"), F.col("bad"), F.col("rating")).alias("sentiment"))


@query("c34_follow_up", f"""
SELECT conv_id, turn, sentiment, CASE sentiment WHEN 'Negative' THEN 'Follow up with customer service'
  WHEN 'Positive' THEN 'Share success story' ELSE 'Monitor for improvements' END AS action FROM (
  SELECT conv_id, turn, {MOOD} AS sentiment FROM (
    SELECT conv_id, turn, 1 + conv_id % 5 AS rating, {_hits(rules.POSITIVE_WORDS)} AS good,
      {_hits(rules.NEGATIVE_WORDS)} AS bad FROM conversations))""")
def _(t):
    moods = t("conversations").withColumn("rating", 1 + F.col("conv_id") % 5).select(
        "conv_id", "turn", rules.sentiment("text", "rating").alias("sentiment"))
    return moods.withColumn("action", rules.follow_up(F.col("sentiment")))


@query("c35_action_required", on_base(
    "SELECT customer_id, customer_id % 5 >= 3 AS action_required FROM base"))
def _(t):
    return t.base("customer_id").select("customer_id",
                                        rules.action_required(F.col("customer_id") % 5).alias("action_required"))


@query("c36_accepted_requests", on_base("""
SELECT request_id FROM requests WHERE tenure_state <> 'missing' AND charge_state <> 'empty'
  AND (tenure_state = 'bad' OR tenure IS NOT NULL) AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL""",
                                        REQUEST_CTE))
def _(t):
    accepted, _rejected = rules.split_required(t.requests(), [*REQUEST_NUMBERS, "contract_type"])
    return accepted.select("request_id")


@query("c36_rejected_requests", on_base("""
SELECT request_id, CASE WHEN tenure_state = 'missing' OR (tenure_state = 'ok' AND tenure IS NULL) THEN 'tenure'
  WHEN charge_state = 'empty' OR monthly_charges IS NULL THEN 'monthly_charges' ELSE 'total_charges' END
  AS missing_field
FROM requests WHERE NOT (tenure_state <> 'missing' AND charge_state <> 'empty'
  AND (tenure_state = 'bad' OR tenure IS NOT NULL) AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL)""",
                                        REQUEST_CTE))
def _(t):
    _accepted, rejected = rules.split_required(t.requests(), [*REQUEST_NUMBERS, "contract_type"])
    return rejected.select("request_id", "missing_field")


CHECKED = ["request_id", "age", "income", "spending", "frequency", "rating", "contract_type", "service_type"]
REASON = """concat_ws(',', CASE WHEN age < 18 OR age > 100 THEN 'age' END, CASE WHEN income < 0 THEN 'income' END,
  CASE WHEN spending < 0 THEN 'spending' END, CASE WHEN rating < 1 OR rating > 5 THEN 'rating' END,
  CASE WHEN contract_type NOT IN ('Month-to-month', 'One year', 'Two year') THEN 'contract_type' END,
  CASE WHEN service_type NOT IN ('Basic', 'Standard', 'Premium') THEN 'service_type' END)"""


@query("c37_valid_requests", on_base(f"SELECT request_id, income FROM requests WHERE {REASON} = ''", REQUEST_CTE))
def _(t):
    valid, _invalid = rules.split_valid(t.requests().select(*CHECKED))
    return valid.select("request_id", "income")


@query("c37_invalid_requests", on_base(
    f"SELECT request_id, {REASON} AS reason FROM requests WHERE {REASON} <> ''", REQUEST_CTE))
def _(t):
    _valid, invalid = rules.split_valid(t.requests().select(*CHECKED))
    return invalid.select("request_id", "reason")
