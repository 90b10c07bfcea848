"""Subject tables, star schema and fact table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from patrona.operators.schema import select_existing

# Columns of the five subject tables.
SUBJECTS: Mapping[str, list[str]] = {
    "customer_demographics": [
        "customer_id", "age", "gender", "married", "senior_citizen", "country", "state", "city", "zip_code",
        "under_30", "lat_long", "latitude", "longitude", "population"],
    "customer_services": [
        "customer_id", "phone_service", "multiple_lines", "internet_service", "internet_type", "streaming_tv",
        "streaming_movies", "streaming_music", "device_protection_plan", "premium_tech_support",
        "online_security", "online_backup", "unlimited_data", "contract"],
    "customer_contracts": [
        "customer_id", "contract", "tenure_in_months", "offer", "payment_method", "paperless_billing",
        "monthly_charge", "total_charges", "total_revenue", "cltv", "total_long_distance_charges",
        "avg_monthly_long_distance_charges", "total_extra_data_charges", "total_refunds"],
    "customer_feedback": [
        "customer_id", "satisfaction_score", "number_of_referrals", "referred_a_friend", "churn", "churn_score",
        "churn_category", "churn_reason", "partner", "churnreason_missing"],
    "customer_behavior": [
        "customer_id", "tenure_in_months", "quarter", "offer", "number_of_referrals", "referred_a_friend",
        "avg_monthly_gb_download"],
}
# Measures of the fact table, taken from contracts and from feedback.
FACT_CONTRACT = ["customer_id", "monthly_charge", "total_charges", "total_revenue", "cltv",
                 "total_long_distance_charges", "avg_monthly_long_distance_charges", "total_extra_data_charges",
                 "total_refunds"]
FACT_FEEDBACK = ["customer_id", "churn", "churn_score", "satisfaction_score"]


def subject(wide: DataFrame, name: str) -> DataFrame:
    """One subject table of the wide customer table (columns that exist)."""
    return select_existing(wide, SUBJECTS[name])


def split_subjects(wide: DataFrame) -> dict[str, DataFrame]:
    """The five subject tables."""
    return {name: subject(wide, name) for name in SUBJECTS}


def fact_activity(contracts: DataFrame, feedback: DataFrame) -> DataFrame:
    """Contracts left-joined to feedback by customer."""
    left = select_existing(contracts, FACT_CONTRACT)
    right = select_existing(feedback, FACT_FEEDBACK)
    return left.join(right, "customer_id", "left")


def star_schema(subjects: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimension tables and the fact table."""
    star = {f"dim_{name}": df for name, df in subjects.items()}
    star["fact_customer_activity"] = fact_activity(subjects["customer_contracts"], subjects["customer_feedback"])
    return star
