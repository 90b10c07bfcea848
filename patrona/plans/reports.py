"""Reports over the star schema.

Every report takes the dimension tables it reads. Joins are on the customer key;
rates and means are summed on the map side first, so a hot group is cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.functions.features import age_group, tenure_group
from patrona.functions.rules import value_band
from patrona.operators.aggregates import rate_pct

KEY = "customer_id"


def _churn_rate() -> Column:
    return rate_pct(F.col("churn") == 1).alias("churn_rate_pct")


def total_customers(demographics: DataFrame) -> DataFrame:
    """A01."""
    return demographics.agg(F.count("*").alias("total_customers"))


def age_groups(demographics: DataFrame) -> DataFrame:
    """Customers per age group."""
    return demographics.groupBy(age_group().alias("age_group")).agg(F.count("*").alias("cnt"))


def charge_by_contract(contracts: DataFrame) -> DataFrame:
    """Mean monthly charge per contract."""
    return contracts.groupBy("contract").agg(F.round(F.avg("monthly_charge"), 2).alias("avg_monthly_charge"))


def top_states(contracts: DataFrame, demographics: DataFrame, k: int = 5) -> DataFrame:
    """States with the highest revenue; ties by name."""
    joined = contracts.select(KEY, "total_revenue").join(demographics.select(KEY, "state"), KEY)
    return (joined.groupBy("state").agg(F.sum("total_revenue").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "state").limit(k))


def churn_rate(feedback: DataFrame) -> DataFrame:
    """Overall churn rate."""
    return feedback.agg(_churn_rate())


def churn_by_contract(contracts: DataFrame, feedback: DataFrame) -> DataFrame:
    """Churn rate per contract."""
    joined = contracts.select(KEY, "contract").join(feedback.select(KEY, "churn"), KEY)
    return joined.groupBy("contract").agg(_churn_rate())


def satisfaction_by_internet(services: DataFrame, feedback: DataFrame) -> DataFrame:
    """Mean satisfaction per internet type, highest first."""
    joined = services.select(KEY, "internet_type").join(feedback.select(KEY, "satisfaction_score"), KEY)
    return (joined.groupBy("internet_type").agg(F.round(F.avg("satisfaction_score"), 2).alias("avg_satisfaction"))
            .orderBy(F.desc("avg_satisfaction"), "internet_type"))


def churn_by_referrals(feedback: DataFrame) -> DataFrame:
    """Churn rate per number of referrals."""
    return feedback.groupBy("number_of_referrals").agg(_churn_rate()).orderBy("number_of_referrals")


def usage_by_churn(behavior: DataFrame, feedback: DataFrame) -> DataFrame:
    """Mean download volume by churn status."""
    joined = behavior.select(KEY, "avg_monthly_gb_download").join(feedback.select(KEY, "churn"), KEY)
    return joined.groupBy("churn").agg(F.round(F.avg("avg_monthly_gb_download"), 2).alias("avg_gb_download"))


def churn_by_tenure(behavior: DataFrame, feedback: DataFrame) -> DataFrame:
    """Churn rate per tenure group."""
    joined = behavior.select(KEY, "tenure_in_months").join(feedback.select(KEY, "churn"), KEY)
    return (joined.groupBy(tenure_group().alias("tenure_group")).agg(_churn_rate()).orderBy("tenure_group"))


def value_bands(contracts: DataFrame) -> DataFrame:
    """Customers and mean lifetime value per reporting band."""
    return (contracts.groupBy(value_band(F.col("cltv")).alias("band"))
            .agg(F.count("*").alias("customers"), F.round(F.avg("cltv"), 2).alias("avg_cltv")))


def revenue_by_internet_and_band(contracts: DataFrame, services: DataFrame) -> DataFrame:
    """Revenue per internet type and value band."""
    joined = contracts.select(KEY, "cltv", "total_revenue").join(services.select(KEY, "internet_type"), KEY)
    return (joined.groupBy("internet_type", value_band(F.col("cltv")).alias("band"))
            .agg(F.round(F.sum("total_revenue"), 2).alias("revenue")))


def early_churn(contracts: DataFrame, feedback: DataFrame, months: int = 12) -> DataFrame:
    """Churn rate for tenure from 0 to ``months``."""
    early = contracts.select(KEY, "tenure_in_months").where(F.col("tenure_in_months").between(0, months))
    return early.join(feedback.select(KEY, "churn"), KEY).agg(F.count("*").alias("customers"), _churn_rate())


def churn_reasons(feedback: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent reasons of churned customers."""
    return (feedback.where((F.col("churn") == 1) & F.col("churn_reason").isNotNull())
            .groupBy("churn_reason").agg(F.count("*").alias("cnt"))
            .orderBy(F.desc("cnt"), "churn_reason").limit(k))


def churn_under_30(demographics: DataFrame, feedback: DataFrame) -> DataFrame:
    """Churn rate of customers under 30 and of the others."""
    joined = demographics.select(KEY, "under_30").join(feedback.select(KEY, "churn"), KEY)
    return joined.groupBy("under_30").agg(_churn_rate())


def usage_by_age(demographics: DataFrame, behavior: DataFrame) -> DataFrame:
    """Download volume of senior, young and other customers."""
    joined = demographics.select(KEY, "senior_citizen", "under_30").join(
        behavior.select(KEY, "avg_monthly_gb_download"), KEY)
    who = F.when(F.col("senior_citizen") == 1, "senior").when(F.col("under_30") == 1, "young").otherwise("other")
    return joined.groupBy(who.alias("age_class")).agg(
        F.count("*").alias("customers"), F.round(F.avg("avg_monthly_gb_download"), 2).alias("avg_gb_download"))


def payment_mix(contracts: DataFrame) -> DataFrame:
    """Customers and share per payment method."""
    counts = contracts.groupBy("payment_method").agg(F.count("*").alias("customers"))
    total = counts.agg(F.sum("customers")).scalar()
    return counts.withColumn("share_pct", F.round(100 * F.col("customers") / total, 2))


def referral_and_paperless(contracts: DataFrame, feedback: DataFrame) -> DataFrame:
    """Share of customers who referred a friend and who use paperless billing."""
    joined = contracts.select(KEY, "paperless_billing").join(feedback.select(KEY, "referred_a_friend"), KEY)
    return joined.agg(rate_pct(F.col("referred_a_friend") == 1).alias("referral_pct"),
                      rate_pct(F.col("paperless_billing") == 1).alias("paperless_pct"))


def tenure_and_revenue(contracts: DataFrame) -> DataFrame:
    """Average tenure and total revenue."""
    return contracts.agg(F.round(F.avg("tenure_in_months"), 2).alias("avg_tenure"),
                         F.round(F.sum("total_revenue"), 2).alias("total_revenue"))
