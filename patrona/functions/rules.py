"""Scoring rules, bands, advice texts and checks of request rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that count as praise or complaint.
POSITIVE_WORDS = ["good", "great", "excellent", "amazing", "love", "perfect", "satisfied"]
NEGATIVE_WORDS = ["bad", "terrible", "awful", "hate", "worst", "disappointed", "frustrated"]

# Labels of clusters and segments.
CLUSTER_ACTIONS = {
    0: "Targeted marketing: Upsell premium products; Personalized loyalty offers",
    1: "Retention campaign: Reactivation emails; Discounted bundles",
    2: "Product recommendations: Cross-sell complementary items; Early access to new launches",
    3: "Engagement boost: Personalized content; Feedback surveys",
}
CLUSTER_NAMES = {0: "Premium Target", 1: "Retention Needed", 2: "Cross-sell Opportunity", 3: "Engagement Focus"}
SEGMENT_NAMES = {0: "Champions", 1: "Loyal Customers", 2: "Potential Loyalists", 3: "At Risk", 4: "Cannot Lose Them"}
SEGMENT_ADVICE = {
    0: "Reward them for their loyalty; Ask for referrals; Upsell premium products",
    1: "Keep them engaged; Offer loyalty programs; Regular communication",
    2: "Offer membership programs; Recommend products; Special offers",
    3: "Re-engagement campaigns; Personalized offers; Win-back strategies",
    4: "Immediate attention required; Personal contact; Exclusive offers",
}
CLASS_ADVICE = {1: "Immediate retention action needed", 0: "Customer likely to stay"}
VALUE_STRATEGIES = {"High Value": "VIP treatment & premium offers", "Medium Value": "Upselling opportunities",
                    "Low Value": "Basic retention efforts"}
FOLLOW_UPS = {"Negative": "Follow up with customer service", "Positive": "Share success story",
              "Neutral": "Monitor for improvements"}
DEFAULT_ADVICE = "General customer care"
FEEDBACK_LEVELS = {0: "Highly Satisfied", 1: "Satisfied", 2: "Neutral", 3: "Dissatisfied", 4: "Highly Dissatisfied"}
SERVICE_MULTIPLIERS = {"Premium": 1.5, "Standard": 1.2, "Basic": 1.0}
RULE_SEGMENTS = {
    "Premium Users": "High value customers with frequent usage",
    "Regular Users": "Steady customers with moderate usage",
    "Budget Users": "Price-conscious customers",
    "Occasional Users": "Low frequency users",
}


def request_number(column: str) -> Column:
    """A request field as double; missing means 0, text that is no number means null."""
    c = F.col(column)
    return F.when(c.isNull(), F.lit(0.0)).otherwise(F.trim(c.cast("string")).try_cast("double"))


def split_bad_numbers(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all fields readable, typed, and the rejected rows with the name of a bad field."""
    bad = F.coalesce(*[F.when(request_number(c).isNull(), F.lit(c)) for c in columns])
    marked = df.withColumn("bad_field", bad)
    good = marked.where(F.col("bad_field").isNull()).drop("bad_field")
    return good.withColumns({c: request_number(c) for c in columns}), marked.where(F.col("bad_field").isNotNull())


def churn_rule_score(charge: str, tenure: str, contract: str, monthly: str = "Month-to-month") -> Column:
    """0.3 for a charge above 80, 0.4 for tenure below 12, 0.3 for a monthly contract."""
    return (F.when(F.col(charge) > 80, 0.3).otherwise(0.0) + F.when(F.col(tenure) < 12, 0.4).otherwise(0.0)
            + F.when(F.col(contract) == monthly, 0.3).otherwise(0.0))


def risk_level(probability: Column) -> Column:
    """High above 0.7, Medium above 0.4, else Low."""
    return F.when(probability > 0.7, "High").when(probability > 0.4, "Medium").otherwise("Low")


def class_risk(prediction: Column) -> Column:
    """High for a predicted churner, else Low."""
    return F.when(prediction == 1, "High").otherwise("Low")


def class_advice(prediction: Column) -> Column:
    """Advice text for the predicted class."""
    return F.when(prediction == 1, CLASS_ADVICE[1]).otherwise(CLASS_ADVICE[0])


def value_rule(charge: str, tenure: str, service: str) -> Column:
    """Charge * max(2 * tenure, 24) * multiplier of the service type."""
    factor = F.lit(1.0)
    for name, value in SERVICE_MULTIPLIERS.items():
        factor = F.when(F.col(service) == name, value).otherwise(factor)
    return F.col(charge) * F.greatest(F.col(tenure) * 2, F.lit(24)) * factor


def value_category(value: Column) -> Column:
    """Above 5000, above 2000, else."""
    return F.when(value > 5000, "High Value").when(value > 2000, "Medium Value").otherwise("Low Value")


def value_strategy(value: Column) -> Column:
    """Strategy text of the value category."""
    return (F.when(value > 5000, VALUE_STRATEGIES["High Value"]).when(value > 2000, VALUE_STRATEGIES["Medium Value"])
            .otherwise(VALUE_STRATEGIES["Low Value"]))


def value_band(value: Column) -> Column:
    """Reporting bands Low below 3000, Medium below 6000, High from 6000."""
    return F.when(value.isNull(), F.lit(None)).when(value >= 6000, "High").when(value >= 3000, "Medium").otherwise("Low")


def rule_segment(income: str, frequency: str) -> Column:
    """First matching rule on income and usage frequency."""
    i, f = F.col(income), F.col(frequency)
    return (F.when((i > 70000) & (f == "High"), "Premium Users").when((i > 40000) & (f == "Medium"), "Regular Users")
            .when(i < 40000, "Budget Users").otherwise("Occasional Users"))


def word_count(text: Column, words: Sequence[str]) -> Column:
    """How many of the listed words occur as substrings of the lower-cased text."""
    lowered = F.lower(text)
    return reduce(add, [F.contains(lowered, F.lit(w)).cast("int") for w in words])


def sentiment(text: str, rating: str) -> Column:
    """Positive, Negative or Neutral from rating and listed words."""
    good, bad = word_count(F.col(text), POSITIVE_WORDS), word_count(F.col(text), NEGATIVE_WORDS)
    return sentiment_of(good, bad, F.col(rating))


def sentiment_of(good: Column, bad: Column, rating: Column) -> Column:
    """The rule on given word counts."""
    return (F.when((rating >= 4) | (good > bad), "Positive").when((rating <= 2) | (bad > good), "Negative")
            .otherwise("Neutral"))


def follow_up(mood: Column) -> Column:
    """Action for a sentiment."""
    return (F.when(mood == "Negative", FOLLOW_UPS["Negative"]).when(mood == "Positive", FOLLOW_UPS["Positive"])
            .otherwise(FOLLOW_UPS["Neutral"]))


def action_required(cluster: Column) -> Column:
    """True from the third feedback level on."""
    return cluster >= 3


def missing_field(columns: Sequence[str]) -> Column:
    """Name of the first required field that is null or empty."""
    return F.coalesce(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c))
                        for c in columns])


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with ``missing_field``."""
    marked = df.withColumn("missing_field", missing_field(columns))
    return (marked.where(F.col("missing_field").isNull()).drop("missing_field"),
            marked.where(F.col("missing_field").isNotNull()))


@dataclass(frozen=True)
class Rule:
    """Allowed range or allowed values of one request field."""
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] | None = None


# Limits of the request fields.
FIELD_RULES: Mapping[str, Rule] = {
    "tenure": Rule(0, 100),
    "monthly_charges": Rule(0),
    "total_charges": Rule(0),
    "age": Rule(18, 100),
    "income": Rule(0),
    "spending": Rule(0),
    "sentiment_score": Rule(-1, 1),
    "rating": Rule(1, 5),
    "response_time": Rule(0),
    "resolution_time": Rule(0),
    "contract_type": Rule(allowed=("Month-to-month", "One year", "Two year")),
    "service_type": Rule(allowed=("Basic", "Standard", "Premium")),
    "frequency": Rule(allowed=("Low", "Medium", "High")),
    "category": Rule(allowed=("Service", "Product", "Support", "Billing")),
}


def broken_rules(df: DataFrame, rules: Mapping[str, Rule] | None = None) -> Column:
    """Comma-separated names of the fields that break a rule; '' when none does."""
    rules = rules or FIELD_RULES
    broken = []
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        c = F.col(name)
        tests = []
        if rule.low is not None:
            tests.append(c < rule.low)
        if rule.high is not None:
            tests.append(c > rule.high)
        if rule.allowed is not None:
            tests.append(~c.isin(*rule.allowed))
        broken.append(F.when(reduce(or_, tests), F.lit(name)))
    return F.concat_ws(",", *broken)


def split_valid(df: DataFrame, rules: Mapping[str, Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the reason."""
    marked = df.withColumn("reason", broken_rules(df, rules))
    return marked.where(F.col("reason") == "").drop("reason"), marked.where(F.col("reason") != "")

