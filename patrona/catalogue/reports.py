"""Queries for the star schema and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import rnd
from patrona.catalogue.registry import on_base, query
from patrona.operators import aggregates
from patrona.plans import reports, star
from patrona.session import materialize

RATE = rnd("100 * sum(CASE WHEN churn = 1 THEN 1 ELSE 0 END) / count(*)", 2) + " AS churn_rate_pct"


def _contracts(t, *columns):
    return star.subject(t.base("customer_id", *columns), "customer_contracts")


def _feedback(t, *columns):
    return star.subject(t.base("customer_id", *columns), "customer_feedback")


def _demographics(t, *columns):
    return star.subject(t.base("customer_id", *columns), "customer_demographics")


def _behavior(t, *columns):
    return star.subject(t.base("customer_id", *columns), "customer_behavior")


def _services(t, *columns):
    return star.subject(t.base("customer_id", *columns), "customer_services")


@query("j01_fact_customer_activity", on_base("""
SELECT customer_id, monthly_charge, total_charges, total_revenue, cltv, churn, churn_score, satisfaction_score
FROM base"""))
def _(t):
    wide = materialize(t.base("customer_id", "monthly_charge", "total_charges", "total_revenue", "cltv", "churn",
                              "churn_score", "satisfaction_score"), "wide")
    return star.fact_activity(star.subject(wide, "customer_contracts"), star.subject(wide, "customer_feedback"))


@query("a01_total_customers", "SELECT count(*) AS total_customers FROM customer")
def _(t):
    return reports.total_customers(_demographics(t))


@query("a03_gender_count", on_base('SELECT gender, count(*) AS "count" FROM base GROUP BY 1'))
def _(t):
    return aggregates.group_count(_demographics(t, "gender"), "gender")


@query("a04_two_key_count", on_base('SELECT churn, contract, count(*) AS "count" FROM base GROUP BY 1, 2'))
def _(t):
    return aggregates.group_count(t.base("churn", "contract"), "churn", "contract")


@query("a05_count_present", on_base(
    "SELECT internet_service, count(internet_type) AS count_internet_type FROM base GROUP BY 1"))
def _(t):
    return aggregates.count_present(t.base("internet_service", "internet_type"), "internet_type", "internet_service")


@query("a20_charge_by_contract", on_base(
    f"SELECT contract, {rnd('avg(monthly_charge)', 2)} AS avg_monthly_charge FROM base GROUP BY 1"))
def _(t):
    return reports.charge_by_contract(_contracts(t, "contract", "monthly_charge"))


@query("a21_satisfaction_by_internet", on_base(
    f"SELECT internet_type, {rnd('avg(satisfaction_score)', 2)} AS avg_satisfaction FROM base GROUP BY 1"))
def _(t):
    return reports.satisfaction_by_internet(_services(t, "internet_type"), _feedback(t, "satisfaction_score"))


@query("a21_usage_by_churn", on_base(
    f"SELECT churn, {rnd('avg(avg_monthly_gb_download)', 2)} AS avg_gb_download FROM base GROUP BY 1"))
def _(t):
    return reports.usage_by_churn(_behavior(t, "avg_monthly_gb_download"), _feedback(t, "churn"))


@query("a22_top_states", on_base(f"""
SELECT state, {rnd('sum(total_revenue)', 2)} AS total_revenue FROM base GROUP BY 1
ORDER BY total_revenue DESC, state LIMIT 5"""))
def _(t):
    top = reports.top_states(_contracts(t, "total_revenue"), _demographics(t, "state"))
    return top.withColumn("total_revenue", F.round("total_revenue", 2))


@query("a23_churn_rate", on_base(f"SELECT {RATE} FROM base"))
def _(t):
    return reports.churn_rate(_feedback(t, "churn"))


@query("a24_churn_rate_by_contract", on_base(f"SELECT contract, {RATE} FROM base GROUP BY 1"))
def _(t):
    return reports.churn_by_contract(_contracts(t, "contract"), _feedback(t, "churn"))


@query("a25_churn_by_referrals", on_base(f"SELECT number_of_referrals, {RATE} FROM base GROUP BY 1"))
def _(t):
    return reports.churn_by_referrals(_feedback(t, "number_of_referrals", "churn"))


@query("a26_churn_by_tenure", on_base(f"""
SELECT CASE WHEN tenure_in_months < 12 THEN '<1 year' WHEN tenure_in_months BETWEEN 12 AND 24 THEN '1-2 years'
  ELSE '2+ years' END AS tenure_group, {RATE} FROM base GROUP BY 1"""))
def _(t):
    return reports.churn_by_tenure(_behavior(t, "tenure_in_months"), _feedback(t, "churn"))


@query("a27_age_groups", on_base("""
SELECT CASE WHEN age < 30 THEN 'Under 30' WHEN age BETWEEN 30 AND 50 THEN '30-50' ELSE '50+' END AS age_group,
  count(*) AS cnt FROM base GROUP BY 1"""))
def _(t):
    return reports.age_groups(_demographics(t, "age"))


@query("a38_kpis", on_base(f"""
SELECT count(*) AS total_customers, {rnd('avg(cltv)', 2)} AS avg_cltv, {RATE},
  {rnd('avg(satisfaction_score)', 2)} AS avg_satisfaction FROM base"""))
def _(t):
    return aggregates.kpis(t.base("cltv", "churn", "satisfaction_score"))


BAND = "CASE WHEN cltv >= 6000 THEN 'High' WHEN cltv >= 3000 THEN 'Medium' WHEN cltv < 3000 THEN 'Low' END"


@query("a39_value_bands", on_base(f"""
SELECT {BAND} AS band, count(*) AS customers, {rnd('avg(cltv)', 2)} AS avg_cltv FROM base GROUP BY 1"""))
def _(t):
    return reports.value_bands(_contracts(t, "cltv"))


@query("a39_revenue_by_internet_and_band", on_base(f"""
SELECT internet_type, {BAND} AS band, {rnd('sum(total_revenue)', 2)} AS revenue FROM base GROUP BY 1, 2"""))
def _(t):
    return reports.revenue_by_internet_and_band(_contracts(t, "cltv", "total_revenue"), _services(t, "internet_type"))


@query("a39_early_churn", on_base(f"""
SELECT count(*) AS customers, {RATE} FROM base WHERE tenure_in_months BETWEEN 0 AND 12"""))
def _(t):
    return reports.early_churn(_contracts(t, "tenure_in_months"), _feedback(t, "churn"))


@query("a39_churn_reasons", on_base("""
SELECT churn_reason, count(*) AS cnt FROM base WHERE churn = 1 GROUP BY 1 ORDER BY cnt DESC, churn_reason LIMIT 5"""))
def _(t):
    return reports.churn_reasons(_feedback(t, "churn", "churn_reason"))


@query("a39_churn_under_30", on_base(f"SELECT under_30, {RATE} FROM base GROUP BY 1"))
def _(t):
    return reports.churn_under_30(_demographics(t, "under_30"), _feedback(t, "churn"))


@query("a39_usage_by_age", on_base(f"""
SELECT CASE WHEN senior_citizen = 1 THEN 'senior' WHEN under_30 = 1 THEN 'young' ELSE 'other' END AS age_class,
  count(*) AS customers, {rnd('avg(avg_monthly_gb_download)', 2)} AS avg_gb_download FROM base GROUP BY 1"""))
def _(t):
    return reports.usage_by_age(_demographics(t, "senior_citizen", "under_30"),
                                _behavior(t, "avg_monthly_gb_download"))


@query("a39_payment_mix", on_base(f"""
SELECT payment_method, count(*) AS customers, {rnd('100 * count(*) / (SELECT count(*) FROM base)', 2)} AS share_pct
FROM base GROUP BY 1"""))
def _(t):
    return reports.payment_mix(_contracts(t, "payment_method"))


@query("a39_referral_and_paperless", on_base(f"""
SELECT {rnd('100 * count(*) FILTER (WHERE referred_a_friend = 1) / count(*)', 2)} AS referral_pct,
  {rnd('100 * count(*) FILTER (WHERE paperless_billing = 1) / count(*)', 2)} AS paperless_pct FROM base"""))
def _(t):
    return reports.referral_and_paperless(_contracts(t, "paperless_billing"), _feedback(t, "referred_a_friend"))


@query("a39_tenure_and_revenue", on_base(f"""
SELECT {rnd('avg(tenure_in_months)', 2)} AS avg_tenure, {rnd('sum(total_revenue)', 2)} AS total_revenue FROM base"""))
def _(t):
    return reports.tenure_and_revenue(_contracts(t, "tenure_in_months", "total_revenue"))


@query("t01_churned_by_state", on_base("""
SELECT state, count(*) AS cnt FROM base WHERE churn = 1 GROUP BY 1 ORDER BY cnt DESC, state"""))
def _(t):
    churned = t.base("state", "churn").where(F.col("churn") == 1)
    return churned.groupBy("state").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "state")


@query("t02_top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
