"""Feature expressions and the three feature sets (lifetime value, churn, segmentation).

Column names are arguments; the defaults are the names after
:func:`patrona.operators.schema.clean_column_names`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.operators.schema import select_existing

# Service columns of the three service counts.
VALUE_SERVICES = ["streaming_tv", "streaming_movies", "streaming_music", "premium_tech_support",
                  "device_protection_plan", "online_security", "online_backup"]
CHURN_SERVICES = ["phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
                  "premium_tech_support", "streaming_tv", "streaming_movies", "device_protection_plan"]
SEGMENT_SERVICES = ["streaming_tv", "streaming_movies", "streaming_music", "premium_tech_support",
                    "device_protection_plan", "online_security", "online_backup", "internet_service"]
# Text forms that mean a service is subscribed.
SUBSCRIBED = ["Yes", "1", "Fiber optic", "DSL"]

# Input columns of the three feature sets.
VALUE_COLUMNS = [
    "customer_id", "age", "gender", "married", "dependents", "contract", "tenure_in_months", "offer",
    "payment_method", "monthly_charge", "total_charges", "avg_monthly_gb_download", "total_long_distance_charges",
    "total_revenue", "internet_service", "streaming_tv", "streaming_movies", "streaming_music",
    "premium_tech_support", "device_protection_plan", "online_security", "online_backup", "referred_a_friend",
    "number_of_referrals", "satisfaction_score", "unlimited_data", "paperless_billing", "cltv", "churn",
    "churn_reason", "churn_score"]
CHURN_COLUMNS = [
    "customer_id", "age", "gender", "senior_citizen", "partner", "dependents", "tenure_in_months", "contract",
    "payment_method", "paperless_billing", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "premium_tech_support", "streaming_tv", "streaming_movies",
    "device_protection_plan", "monthly_charge", "total_charges", "churn"]
SEGMENT_COLUMNS = [
    "customer_id", "age", "gender", "married", "dependents", "contract", "tenure_in_months", "offer",
    "payment_method", "monthly_charge", "total_charges", "avg_monthly_gb_download", "total_long_distance_charges",
    "total_revenue", "internet_service", "streaming_tv", "streaming_movies", "streaming_music",
    "premium_tech_support", "device_protection_plan", "online_security", "online_backup", "referred_a_friend",
    "number_of_referrals", "satisfaction_score", "unlimited_data", "paperless_billing"]


def tenure_bucket_3(tenure: str = "tenure_in_months", null_label: str | None = "2+yrs") -> Column:
    """<12, [12, 24), rest. A null tenure gets ``null_label``."""
    t = F.col(tenure)
    return (F.when(t < 12, "<1yr").when((t >= 12) & (t < 24), "1-2yr")
            .when(t.isNull(), F.lit(null_label)).otherwise("2+yrs"))


def tenure_bucket_4(tenure: str = "tenure_in_months", null_label: str | None = "48+ Months") -> Column:
    """Cuts at 12, 24 and 48 months."""
    t = F.col(tenure)
    return (F.when(t < 12, "0-12 Months").when(t < 24, "12-24 Months").when(t < 48, "24-48 Months")
            .when(t.isNull(), F.lit(null_label)).otherwise("48+ Months"))


def tenure_group(tenure: str = "tenure_in_months") -> Column:
    """<12, 12 to 24 with both ends, rest."""
    t = F.col(tenure)
    return F.when(t < 12, "<1 year").when(t.between(12, 24), "1-2 years").otherwise("2+ years")


def age_group(age: str = "age") -> Column:
    """Under 30, 30 to 50 with both ends, rest."""
    a = F.col(age)
    return F.when(a < 30, "Under 30").when(a.between(30, 50), "30-50").otherwise("50+")


def satisfaction_bucket(score: str = "satisfaction_score") -> Column:
    """Up to 2, up to 3.5, above; null stays null."""
    s = F.col(score)
    return F.when(s <= 2, "Low").when(s <= 3.5, "Medium").when(s > 3.5, "High")


def revenue_per_month(revenue: str = "total_revenue", tenure: str = "tenure_in_months") -> Column:
    """Revenue / (tenure + 1)."""
    return F.try_divide(F.col(revenue), F.col(tenure) + 1)


def revenue_per_month_guarded(revenue: str = "total_revenue", tenure: str = "tenure_in_months") -> Column:
    """Revenue / tenure, or / 1 where tenure is not positive."""
    return F.col(revenue) / F.when(F.col(tenure) > 0, F.col(tenure)).otherwise(1)


def spend_ratio(charges: str = "total_charges", revenue: str = "total_revenue") -> Column:
    """Charges / (revenue + 1)."""
    return F.try_divide(F.col(charges), F.col(revenue) + 1)


def spend_ratio_guarded(charges: str = "total_charges", revenue: str = "total_revenue") -> Column:
    """Charges / revenue, or / 1 where revenue is not positive."""
    return F.col(charges) / F.when(F.col(revenue) > 0, F.col(revenue)).otherwise(1)


def high_spender(charge: str = "monthly_charge", limit: float = 80) -> Column:
    """1 when the monthly charge exceeds the limit."""
    return F.when(F.col(charge) > limit, 1).otherwise(0)


def service_count(columns: Sequence[str] = VALUE_SERVICES) -> Column:
    """Number of 0/1 columns equal to 1; null counts as 0."""
    return reduce(add, [F.when(F.col(c) == 1, 1).otherwise(0) for c in columns])


def service_count_text(columns: Sequence[str] = CHURN_SERVICES, subscribed: Sequence[str] = SUBSCRIBED) -> Column:
    """Number of columns whose text form is one of the subscribed values."""
    return reduce(add, [F.when(F.col(c).cast("string").isin(*subscribed), 1).otherwise(0) for c in columns])


def service_sum(columns: Sequence[str] = SEGMENT_SERVICES) -> Column:
    """Plain sum; null if any column is null."""
    return reduce(add, [F.col(c) for c in columns])


def charge_x_tenure(charge: str = "monthly_charge", tenure: str = "tenure_in_months") -> Column:
    """Interaction of charge and tenure."""
    return F.col(charge) * F.col(tenure)


def trim_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim text columns in one projection."""
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def ordinal(column: str, levels: Sequence[str]) -> Column:
    """1, 2, ... for the levels (trimmed, any case), null for anything else."""
    text = F.lower(F.trim(F.col(column)))
    out = F.when(text == levels[0], 1)
    for rank, level in enumerate(levels[1:], start=2):
        out = out.when(text == level, rank)
    return out


# Ordered text levels of feedback score and loyalty.
SCORE_LEVELS = ["low", "medium", "high"]
LOYALTY_LEVELS = ["bronze", "silver", "gold"]
# Feedback columns read as numbers.
FEEDBACK_NUMBERS = ["age", "income", "product_quality", "service_quality", "purchase_frequency",
                    "satisfaction_score"]


def number_from_text(column: str) -> Column:
    """Trimmed text without thousands commas as double; null when it is no number."""
    return F.regexp_replace(F.trim(F.col(column).cast("string")), ",", "").try_cast("double")


def quality_average(product: str = "product_quality", service: str = "service_quality") -> Column:
    """Mean of product and service quality."""
    return (F.col(product) + F.col(service)) / 2


def feedback_number(column: str = "feedback_score") -> Column:
    """C20: level as 1..3, or the number itself when the text is a number."""
    return F.coalesce(ordinal(column, SCORE_LEVELS).cast("double"), F.col(column).try_cast("double"))


def engagement(df: DataFrame, frequency: str = "purchase_frequency", satisfaction: str = "satisfaction_score") -> Column:
    """0.6 * frequency (null as 0) + 0.4 * satisfaction (null as its mean over all rows)."""
    mean = df.agg(F.avg(satisfaction)).scalar()
    return F.coalesce(F.col(frequency), F.lit(0.0)) * 0.6 + F.coalesce(F.col(satisfaction), mean) * 0.4


def month_of(time: str) -> Column:
    """First day of the month of a date, time or text."""
    return F.date_trunc("month", F.to_timestamp(F.col(time))).cast("date")


def value_features(df: DataFrame) -> DataFrame:
    """Feature set for lifetime value."""
    return select_existing(df, VALUE_COLUMNS).withColumns({
        "tenure_bucket": tenure_bucket_3(),
        "avg_revenue_per_month": revenue_per_month(),
        "total_spend_ratio": spend_ratio(),
        "is_high_spender": high_spender(),
        "num_services": service_count(),
        "monthly_charge_x_tenure": charge_x_tenure(),
        "log_total_revenue": F.log1p("total_revenue"),
    })


def churn_features(df: DataFrame) -> DataFrame:
    """Feature set for churn."""
    return select_existing(df, CHURN_COLUMNS).withColumns({
        "tenure_bucket": tenure_bucket_3(),
        "num_services_subscribed": service_count_text(),
    })


def segment_features(df: DataFrame) -> DataFrame:
    """Feature set for segmentation."""
    return select_existing(df, SEGMENT_COLUMNS).withColumns({
        "tenure_bucket": tenure_bucket_4(),
        "avg_revenue_per_month": revenue_per_month_guarded(),
        "total_spend_ratio": spend_ratio_guarded(),
        "is_high_spender": high_spender(),
        "num_services": service_sum(),
        "monthly_charge_x_tenure": charge_x_tenure(),
        "log_total_revenue": F.log1p("total_revenue"),
    })


def feedback_features(df: DataFrame) -> DataFrame:
    """Cleaned feedback rows with derived scores."""
    clean = df.withColumns({
        "feedback_score": F.trim("feedback_score"),
        "loyalty_level": F.trim("loyalty_level"),
        **{c: number_from_text(c) for c in FEEDBACK_NUMBERS if c in df.columns},
    })
    return clean.withColumns({
        "feedback_score_num": ordinal("feedback_score", SCORE_LEVELS),
        "loyalty_level_clean": ordinal("loyalty_level", LOYALTY_LEVELS),
        "quality_avg": quality_average(),
        "engagement_score": engagement(clean),
        "income_log": F.log1p(F.coalesce("income", F.lit(0.0))),
        "satisfaction_bucket": satisfaction_bucket(),
    })
