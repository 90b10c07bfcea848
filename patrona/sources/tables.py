"""The given tables and the customer frames that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patrona.scale import latest_level, least_level

SERVICE_TYPES = {
    "streaming_tv": "ECONOMY",
    "streaming_movies": "LARGE",
    "streaming_music": "MEDIUM",
    "premium_tech_support": "PROMO",
    "device_protection_plan": "SMALL",
    "online_security": "STANDARD",
}
# Levels of the given tables, sorted.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SERVICES = [*SERVICE_TYPES, "online_backup"]
LINE_COLUMNS = {"total_charges", *SERVICES}
EVENT_COLUMNS = {"avg_monthly_gb_download", "internet_type", "internet_service"}
PLACE_COLUMNS = {"state", "country", "city"}
CUSTOMER_COLUMNS = {"customer_id", "cltv", "contract", "age", "gender", "married", "dependents", "partner",
                    "senior_citizen", "under_30"}


def cents(col: str) -> Column:
    """Money column in whole cents, so that sums are exact in any order."""
    return F.rint(F.col(col) * 100).cast("long")


class Tables:
    """Readers over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def order_facts(self) -> DataFrame:
        return (self("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count("*").alias("n_orders"),
            (F.sum(cents("o_totalprice")) / F.lit(100.0)).alias("total_revenue"),
            F.max("o_orderdate").alias("last_order"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("number_of_referrals"),
            least_level(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")), PRIORITIES).alias("offer"),
            latest_level(F.col("o_orderpriority"), F.col("o_orderkey"), PRIORITIES).alias("payment_method"),
            latest_level(F.col("o_orderstatus"), F.col("o_orderkey"), STATUSES).alias("last_status")))

    def line_facts(self, services: bool) -> DataFrame:
        """Per customer totals of line items, summed per order before the join to orders."""
        lines = self("lineitem")
        charge = F.sum(cents("l_extendedprice") * (100 - cents("l_discount"))).alias("charge")
        sums = [charge]
        if services:
            # A part may own a large share of the lines; the join is a plain equi-join
            # followed by a regrouping, which adaptive execution may split on skew.
            lines = lines.join(self("part").select("p_partkey", "p_type"),
                               F.col("l_partkey") == F.col("p_partkey"), "left")
            sums += [F.count_if(F.col("p_type") == kind).alias(name) for name, kind in SERVICE_TYPES.items()]
            sums.append(F.count_if(F.col("l_returnflag") == "R").alias("online_backup"))
        per_order = lines.groupBy("l_orderkey").agg(*sums)
        orders = self("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
        joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        flags = []
        if services:
            flags = [(F.sum(name) >= (14 if name == "online_backup" else 7)).cast("int").alias(name)
                     for name in SERVICES]
        return joined.groupBy("customer_id").agg((F.sum("charge") / F.lit(10000.0)).alias("total_charges"), *flags)

    def event_facts(self) -> DataFrame:
        return (self("events").groupBy(F.col("user_id").alias("customer_id")).agg(
            (F.sum(cents("value")) / F.lit(100.0) / F.count("value")).alias("avg_monthly_gb_download"),
            latest_level(F.col("event_type"), F.col("event_id"), EVENT_TYPES).alias("internet_type")))

    def base(self, *columns: str) -> DataFrame:
        """One row per customer. Only the facts that ``columns`` need are joined."""
        wanted = set(columns)
        customer = self("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("cltv"),
            F.col("c_mktsegment").alias("contract"), "c_nationkey")
        df = customer
        if not wanted or wanted & PLACE_COLUMNS:
            places = (self("nation").join(self("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("country")))
            df = df.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        if not wanted or wanted - CUSTOMER_COLUMNS - PLACE_COLUMNS - LINE_COLUMNS - EVENT_COLUMNS:
            df = df.join(self.order_facts(), "customer_id", "left")
        if not wanted or wanted & LINE_COLUMNS:
            df = df.join(self.line_facts(not wanted or bool(wanted & set(SERVICES))), "customer_id", "left")
        if not wanted or wanted & EVENT_COLUMNS:
            df = df.join(self.event_facts(), "customer_id", "left")
        columns = columns or BASE_COLUMNS
        derived = self._derived()
        return df.withColumns({c: derived[c] for c in columns if c in derived}).select(*columns)

    def feedback(self) -> DataFrame:
        """Uncleaned feedback answers per customer: padded and mixed-case text, blanks, unknown levels."""
        key = F.col("customer_id")
        level = F.element_at(F.array(*map(F.lit, [" Low", "MEDIUM ", "high", "n/a"])), (key % 4 + 1).cast("int"))
        loyalty = F.element_at(F.array(*map(F.lit, ["Bronze ", " silver", "GOLD", "platinum", None])),
                               (key % 5 + 1).cast("int"))
        return self.base("customer_id", "age", "gender", "country", "cltv", "n_orders").select(
            "customer_id", F.format_string(" %d ", F.col("age")).alias("age"), "gender", "country",
            F.when(key % 23 == 0, "unknown").when(key % 9 != 0, F.format_number(F.col("cltv") * 10 + 10000, 2))
            .alias("income"),
            F.when(key % 8 != 0, (key % 5 + 1).cast("string")).alias("product_quality"),
            ((key % 7) % 5 + 1).cast("string").alias("service_quality"),
            F.when(key % 6 != 0, F.col("n_orders").cast("string")).alias("purchase_frequency"),
            level.alias("feedback_score"), loyalty.alias("loyalty_level"),
            F.when(key % 10 != 0, (1 + (key % 9) / 2).cast("string")).alias("satisfaction_score"))

    def requests(self) -> DataFrame:
        """Scoring requests per customer as text fields, some of them missing, unreadable or out of range."""
        key = F.col("customer_id")

        def pick(*names):
            return F.element_at(F.array(*map(F.lit, names)), (key % len(names) + 1).cast("int"))

        def text(c):
            return F.col(c).cast("string")
        return self.base("customer_id", "age", "cltv", "tenure_in_months", "monthly_charge", "total_charges").select(
            key.alias("request_id"),
            F.when(key % 17 == 0, "abc").when(key % 11 != 0, text("tenure_in_months")).alias("tenure"),
            F.when(key % 13 == 0, "").otherwise(F.round("monthly_charge", 2).cast("string")).alias("monthly_charges"),
            F.round("total_charges", 2).cast("string").alias("total_charges"),
            F.when(key % 19 == 0, "Weekly").otherwise(pick("Month-to-month", "One year", "Two year"))
            .alias("contract_type"),
            pick("Basic", "Standard", "Premium", "Gold").alias("service_type"),
            "age", (F.col("cltv") * 10).alias("income"), F.round("monthly_charge", 2).alias("spending"),
            pick("Low", "Medium", "High").alias("frequency"),
            F.when(key % 29 == 0, 0).otherwise(1 + key % 5).cast("double").alias("rating"),
            ((key % 41 - 20) / 20).alias("sentiment_score"),
            (key % 48).cast("double").alias("response_time"),
            (key % 97).cast("double").alias("resolution_time"),
            pick("Service", "Product", "Support", "Billing").alias("category"))

    def _derived(self) -> dict[str, Column]:
        key, orders = F.col("customer_id"), F.col("n_orders")
        asof = self("orders").agg(F.max("o_orderdate")).scalar()
        recency = F.datediff(asof, F.col("last_order"))
        churn = F.when(recency > 365, 1).otherwise(0)
        age = (18 + key % 60).cast("int")
        return {
            "age": age,
            "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
            "married": (key % 3 == 0).cast("int"),
            "dependents": (key % 4 == 0).cast("int"),
            "partner": (key % 5 < 2).cast("int"),
            "senior_citizen": (age >= 65).cast("int"),
            "under_30": (age < 30).cast("int"),
            "city": F.concat(F.col("state"), F.lit("-"), (key % 4).cast("string")),
            "tenure_in_months": (2 * orders).cast("int"),
            "monthly_charge": F.col("total_revenue") / orders / 3000,
            "churn": churn,
            "recency": recency,
            "monetary": F.col("total_revenue") / orders,
            "satisfaction_score": (1 + (orders + key) % 5).cast("int"),
            "referred_a_friend": (F.col("number_of_referrals") > 0).cast("int"),
            "paperless_billing": (F.col("last_status") == "F").cast("int"),
            "phone_service": (orders >= 8).cast("int"),
            "multiple_lines": (orders >= 12).cast("int"),
            "unlimited_data": (orders % 3 == 0).cast("int"),
            "quarter": F.concat(F.lit("Q"), F.quarter("last_order").cast("string")),
            "churn_score": (key * 37 % 70 + 30 * churn).cast("int"),
            "churn_category": F.when(churn == 1, F.element_at(
                F.array(F.lit("Price"), F.lit("Competitor"), F.lit("Support")), (key % 3 + 1).cast("int"))),
            "churn_reason": F.when(churn == 1, F.concat(F.lit("Reason "), (key % 7).cast("string"))),
            "churnreason_missing": churn != 1,
            "internet_service": F.col("internet_type").isNotNull().cast("int"),
        }


BASE_COLUMNS = [
    "customer_id", "age", "gender", "married", "dependents", "partner", "senior_citizen", "under_30",
    "country", "state", "city", "contract", "tenure_in_months", "offer", "payment_method", "paperless_billing",
    "monthly_charge", "total_charges", "total_revenue", "cltv", "avg_monthly_gb_download", "internet_service",
    "internet_type", "phone_service", "multiple_lines", *SERVICES, "unlimited_data", "number_of_referrals",
    "referred_a_friend", "satisfaction_score", "churn", "churn_score", "churn_category", "churn_reason",
    "churnreason_missing", "quarter", "n_orders", "recency", "monetary", "last_order",
]
