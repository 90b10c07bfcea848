"""Queries for joins, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.registry import on_base, query
from patrona.functions import rules
from patrona.operators import aggregates, joins


def monthly_labels(t):
    """Per customer and month of order: the priority of the latest order."""
    return (t("orders").groupBy("o_custkey", F.date_trunc("month", "o_orderdate").cast("date").alias("period"))
            .agg(F.max_by("o_orderpriority", "o_orderkey").alias("cluster")))


MONTHLY = """
snapshots AS (
  SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS period, arg_max(o_orderpriority, o_orderkey) AS cluster
  FROM orders GROUP BY 1, 2),
following AS (SELECT period, lead(period) OVER (ORDER BY period) AS next FROM (SELECT DISTINCT period FROM snapshots)),
pairs AS (
  SELECT a.o_custkey, a.period AS period_1, b.period AS period_2, a.cluster AS label_1, b.cluster AS label_2
  FROM snapshots a JOIN following f ON a.period = f.period
  JOIN snapshots b ON b.o_custkey = a.o_custkey AND b.period = f.next)"""


@query("j02_inner_join_mean", on_base(f"""
SELECT contract, churn, {rnd('avg(monthly_charge)', 2)} AS avg_charge FROM base GROUP BY 1, 2"""))
def _(t):
    joined = t.base("customer_id", "contract").join(t.base("customer_id", "churn", "monthly_charge"), "customer_id")
    return joined.groupBy("contract", "churn").agg(F.round(F.avg("monthly_charge"), 2).alias("avg_charge"))


@query("j03_natural_join", on_base("""
SELECT customer_id, contract, cltv, CASE WHEN monthly_charge > 80 THEN 1 ELSE 0 END AS cluster_kmeans FROM base"""))
def _(t):
    segments = t.base("customer_id", "contract", "monthly_charge").select(
        "customer_id", "contract", F.when(F.col("monthly_charge") > 80, 1).otherwise(0).alias("cluster_kmeans"))
    return joins.natural_join(t.base("customer_id", "contract", "cltv"), segments)


@query("j03_attach_segments", on_base("SELECT customer_id, cltv, number_of_referrals FROM base"))
def _(t):
    return joins.attach(t.base("customer_id", "cltv"), t.base("customer_id", "number_of_referrals"), "customer_id")


@query("j04_frequency_lookup", on_base("""
SELECT customer_id, city, offer, count(*) OVER (PARTITION BY city)::DOUBLE / count(*) OVER () AS city_freqenc,
  CASE WHEN offer IS NOT NULL THEN count(*) OVER (PARTITION BY offer)::DOUBLE / count(*) OVER () END AS offer_freqenc
FROM base"""))
def _(t):
    return joins.frequency_encode(t.base("customer_id", "city", "offer"), ["city", "offer"])


@query("j04_frequency_lookup_large", """
SELECT l_orderkey, l_linenumber, l_partkey,
  count(*) OVER (PARTITION BY l_partkey)::DOUBLE / count(*) OVER () AS l_partkey_freqenc FROM lineitem""")
def _(t):
    # More values than the row limit: frequent ones are broadcast, the others joined by shuffle.
    return joins.frequency_encode(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_partkey"],
                                  max_rows=1000)


@query("j05_attach_scores", """
SELECT c_custkey AS customer_id, c_mktsegment, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) % 10 / 10e0
  AS churn_proba FROM customer""")
def _(t):
    scores = t("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        ((F.count("*") % 10) / 10).alias("churn_proba"))
    customers = t("customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    return joins.attach(customers, scores, "customer_id").fillna({"churn_proba": 0.0})


@query("j06_external_feedback", on_base(f"""
SELECT contract, {rnd('avg(monthly_charge)')} AS monthly_charge, {rnd('avg(nps)')} AS nps FROM base
LEFT JOIN (SELECT doc_id AS customer_id, 1 + doc_id % 5 AS nps FROM documents) USING (customer_id)
GROUP BY 1"""))
def _(t):
    external = t("documents").select(
        F.col("doc_id").alias("customer_id"), (1 + F.col("doc_id") % 5).alias("nps"))
    return rounded(aggregates.cluster_relevance(t.base("customer_id", "contract", "monthly_charge"), "contract",
                                                ["monthly_charge"], external, "customer_id"))


@query("a33_cluster_kpis", on_base(f"""
SELECT contract, {rnd('avg(monthly_charge)')} AS monthly_charge, {rnd('avg(cltv)')} AS cltv FROM base GROUP BY 1"""))
def _(t):
    return rounded(aggregates.cluster_relevance(t.base("contract", "monthly_charge", "cltv"), "contract",
                                                ["monthly_charge", "cltv"]))


@query("j07_consecutive_periods", f"WITH {MONTHLY} SELECT * FROM pairs")
def _(t):
    return joins.consecutive_periods(monthly_labels(t), "o_custkey", "period", "cluster")


def _cases(labels):
    return " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())


@query("j08_label_dictionary", on_base(f"""
SELECT customer_id, CASE customer_id % 6 {_cases(rules.CLUSTER_ACTIONS)} END AS action,
  CASE customer_id % 6 {_cases(rules.CLUSTER_NAMES)} END AS name,
  CASE customer_id % 6 {_cases(rules.SEGMENT_NAMES)} ELSE 'Unknown' END AS segment,
  CASE customer_id % 6 {_cases(rules.SEGMENT_ADVICE)} ELSE 'General customer care' END AS advice,
  CASE customer_id % 6 {_cases(rules.FEEDBACK_LEVELS)} ELSE 'Unknown' END AS level FROM base"""))
def _(t):
    cluster = (F.col("customer_id") % 6).cast("int")
    return t.base("customer_id").select(
        "customer_id", joins.map_label(cluster, rules.CLUSTER_ACTIONS).alias("action"),
        joins.map_label(cluster, rules.CLUSTER_NAMES).alias("name"),
        joins.map_label(cluster, rules.SEGMENT_NAMES, "Unknown").alias("segment"),
        joins.map_label(cluster, rules.SEGMENT_ADVICE, rules.DEFAULT_ADVICE).alias("advice"),
        joins.map_label(cluster, rules.FEEDBACK_LEVELS, "Unknown").alias("level"))


@query("u01_common_keys", """
SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997
INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998""")
def _(t):
    orders = t("orders")
    return joins.common_keys(orders.where(F.year("o_orderdate") == 1997), orders.where(F.year("o_orderdate") == 1998),
                             "o_custkey")


@query("u03_required_columns", "SELECT true AS ok, count(*) AS n_rows FROM customer")
def _(t):
    customers = t("customer")
    ok = joins.require_columns(customers, ["c_custkey", "c_acctbal"])
    return customers.agg(F.lit(ok).alias("ok"), F.count("*").alias("n_rows"))
