"""Registry of named queries and of the plain SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patrona.sources.tables import SERVICE_TYPES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_flags = ",\n    ".join(f"(count(*) FILTER (WHERE p_type = '{kind}') >= 7)::INTEGER AS {name}"
                        for name, kind in SERVICE_TYPES.items())

BASE_CTE = f"""
WITH order_facts AS (
  SELECT o_custkey AS customer_id, count(*) AS n_orders,
    sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / 100e0 AS total_revenue,
    max(o_orderdate) AS last_order,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS number_of_referrals,
    min(o_orderpriority) FILTER (WHERE o_orderstatus = 'P') AS offer,
    arg_max(o_orderpriority, o_orderkey) AS payment_method,
    arg_max(o_orderstatus, o_orderkey) AS last_status
  FROM orders GROUP BY 1),
line_facts AS (
  SELECT o_custkey AS customer_id,
    sum(round(l_extendedprice * 100)::BIGINT * (100 - round(l_discount * 100)::BIGINT))::DOUBLE / 10000e0
      AS total_charges,
    {_flags},
    (count(*) FILTER (WHERE l_returnflag = 'R') >= 14)::INTEGER AS online_backup
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY 1),
event_facts AS (
  SELECT user_id AS customer_id,
    sum(round(value * 100)::BIGINT)::DOUBLE / 100e0 / count(value) AS avg_monthly_gb_download,
    arg_max(event_type, event_id) AS internet_type
  FROM events GROUP BY 1),
joined AS (
  SELECT c_custkey AS customer_id, c_acctbal AS cltv, c_mktsegment AS contract,
    n_name AS state, r_name AS country,
    o.* EXCLUDE (customer_id), l.* EXCLUDE (customer_id), e.* EXCLUDE (customer_id),
    date_diff('day', last_order, (SELECT max(o_orderdate) FROM orders))::INTEGER AS recency
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN order_facts o ON o.customer_id = c_custkey
  LEFT JOIN line_facts l ON l.customer_id = c_custkey
  LEFT JOIN event_facts e ON e.customer_id = c_custkey),
marked AS (
  SELECT *, (18 + customer_id % 60)::INTEGER AS age,
    CASE WHEN recency > 365 THEN 1 ELSE 0 END AS churn
  FROM joined),
base AS (
  SELECT *,
    CASE WHEN customer_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    (customer_id % 3 = 0)::INTEGER AS married,
    (customer_id % 4 = 0)::INTEGER AS dependents,
    (customer_id % 5 < 2)::INTEGER AS partner,
    (age >= 65)::INTEGER AS senior_citizen,
    (age < 30)::INTEGER AS under_30,
    state || '-' || (customer_id % 4)::VARCHAR AS city,
    (2 * n_orders)::INTEGER AS tenure_in_months,
    total_revenue / n_orders / 3000 AS monthly_charge,
    total_revenue / n_orders AS monetary,
    (1 + (n_orders + customer_id) % 5)::INTEGER AS satisfaction_score,
    (number_of_referrals > 0)::INTEGER AS referred_a_friend,
    (last_status = 'F')::INTEGER AS paperless_billing,
    (n_orders >= 8)::INTEGER AS phone_service,
    (n_orders >= 12)::INTEGER AS multiple_lines,
    (n_orders % 3 = 0)::INTEGER AS unlimited_data,
    'Q' || quarter(last_order)::VARCHAR AS quarter,
    (customer_id * 37 % 70 + 30 * churn)::INTEGER AS churn_score,
    CASE WHEN churn = 1 THEN ['Price', 'Competitor', 'Support'][customer_id % 3 + 1] END AS churn_category,
    CASE WHEN churn = 1 THEN 'Reason ' || (customer_id % 7)::VARCHAR END AS churn_reason,
    churn <> 1 AS churnreason_missing,
    (internet_type IS NOT NULL)::INTEGER AS internet_service
  FROM marked)
"""

FEEDBACK_CTE = """
feedback AS (
  SELECT customer_id, age::DOUBLE AS age, gender, country,
    CASE WHEN customer_id % 23 <> 0 AND customer_id % 9 <> 0
      THEN (round(cltv * 100)::BIGINT * 10 + 1000000)::DOUBLE / 100e0 END AS income,
    CASE WHEN customer_id % 8 <> 0 THEN (customer_id % 5 + 1)::DOUBLE END AS product_quality,
    ((customer_id % 7) % 5 + 1)::DOUBLE AS service_quality,
    CASE WHEN customer_id % 6 <> 0 THEN n_orders::DOUBLE END AS purchase_frequency,
    ['Low', 'MEDIUM', 'high', 'n/a'][customer_id % 4 + 1] AS feedback_score,
    ['Bronze', 'silver', 'GOLD', 'platinum', NULL][customer_id % 5 + 1] AS loyalty_level,
    CASE WHEN customer_id % 10 <> 0 THEN 1 + (customer_id % 9)::DOUBLE / 2 END AS satisfaction_score
  FROM base)
"""

REQUEST_CTE = """
requests AS (
  SELECT customer_id AS request_id,
    CASE WHEN customer_id % 17 = 0 THEN 'bad' WHEN customer_id % 11 = 0 THEN 'missing' ELSE 'ok' END AS tenure_state,
    CASE WHEN customer_id % 13 = 0 THEN 'empty' ELSE 'ok' END AS charge_state,
    tenure_in_months::DOUBLE AS tenure,
    round(CAST(monthly_charge AS DECIMAL(38, 8)), 2)::DOUBLE AS monthly_charges,
    round(CAST(total_charges AS DECIMAL(38, 8)), 2)::DOUBLE AS total_charges,
    CASE WHEN customer_id % 19 = 0 THEN 'Weekly'
      ELSE ['Month-to-month', 'One year', 'Two year'][customer_id % 3 + 1] END AS contract_type,
    ['Basic', 'Standard', 'Premium', 'Gold'][customer_id % 4 + 1] AS service_type,
    age, cltv * 10 AS income, round(CAST(monthly_charge AS DECIMAL(38, 8)), 2)::DOUBLE AS spending,
    ['Low', 'Medium', 'High'][customer_id % 3 + 1] AS frequency,
    CASE WHEN customer_id % 29 = 0 THEN 0 ELSE 1 + customer_id % 5 END::DOUBLE AS rating,
    (customer_id % 41 - 20)::DOUBLE / 20 AS sentiment_score,
    (customer_id % 48)::DOUBLE AS response_time, (customer_id % 97)::DOUBLE AS resolution_time,
    ['Service', 'Product', 'Support', 'Billing'][customer_id % 4 + 1] AS category
  FROM base)
"""


def on_base(sql: str, *ctes: str) -> str:
    """SQL over the customer base view, with optional further ``name AS (...)`` parts."""
    return BASE_CTE.rstrip() + "".join(f",\n{c.strip()}" for c in ctes) + "\n" + sql.strip()


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``, with its SQL when there is one."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


def load_catalogue() -> None:
    """Import every catalogue module so that its queries are registered."""
    from patrona.catalogue import (  # noqa: F401
        aggregates, features, joins, metrics, models, prep, reports, rules, scoring, shaping, sources)
