"""Queries for schema shaping, filters, samples and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import union_all
from patrona.catalogue.registry import on_base, query
from patrona.operators import quality, schema, sketches
from patrona.plans import star
from patrona.scale import hash_sample
from patrona.session import materialize
from patrona.sources.tables import BASE_COLUMNS

CUSTOMER = "SELECT c_custkey AS {0}, c_name AS {1}, c_mktsegment AS {2}, c_acctbal AS {3} FROM customer"
HASH = "('0x' || substr(md5({key}::VARCHAR || ':{seed}'), 1, 13))::BIGINT"


def hash_sql(key: str, seed: int | str = 42) -> str:
    return HASH.format(key=key, seed=seed)


def _customer(t, *names):
    return t("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").toDF(*names)


@query("p01_clean_column_names", CUSTOMER.format("customer_id", "full_name", "market_segment", "balanceusd"))
def _(t):
    return schema.clean_column_names(_customer(t, " Customer ID", "Full-Name", "Market Segment;", "Balance(USD)"))


@query("p02_underscore_spaces", CUSTOMER.format("Customer_ID", "Full_Name", "Market_Segment", "Balance"))
def _(t):
    return schema.underscore_spaces(_customer(t, "Customer ID", "Full Name", "Market Segment", "Balance"))


@query("p03_normalize_names", CUSTOMER.format("Customer_ID", "Full_Name", "Market_Segment", "Balance"))
def _(t):
    return schema.normalize_names(_customer(t, " Customer ID ", "Full-Name", "Market Segment", "Balance"))


@query("p04_rename_by_position", CUSTOMER.format("customer", "name", "segment", "balance"))
def _(t):
    return schema.rename_by_position(_customer(t, "a", "b", "c", "d"), ["customer", "name", "segment", "balance"])


@query("p05_select_existing", "SELECT c_custkey, c_acctbal FROM customer")
def _(t):
    return schema.select_existing(t("customer"), ["c_custkey", "zip_code", "C_ACCTBAL", "c_custkey"],
                                  match_case=False, at_least=2)


def _subject(name):
    columns = [c for c in star.SUBJECTS[name] if c in BASE_COLUMNS]

    @query(f"p07_{name}", on_base(f"SELECT {', '.join(columns)} FROM base"))
    def _(t):
        return star.subject(t.base(*columns), name)


for _name in star.SUBJECTS:
    _subject(_name)


@query("p08_copy_table", "SELECT * FROM customer")
def _(t):
    return t("customer").select("*")


@query("p09_project_city", on_base("SELECT city, country FROM base"))
def _(t):
    return t.base("city", "country")


@query("p09_project_satisfaction", on_base("SELECT satisfaction_score FROM base"))
def _(t):
    return t.base("satisfaction_score")


@query("p10_drop_columns", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return schema.drop_columns(t("customer"), "C_CUSTKEY", "c_name", "churn_score")


@query("p11_label_and_features", on_base("SELECT age, contract, churn, churn::DOUBLE AS label FROM base"))
def _(t):
    df, features = schema.label_and_features(t.base("customer_id", "age", "contract", "churn"), "churn",
                                             ["customer_id"])
    return df.select(*features, "churn", "label")


@query("p12_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def _(t):
    return schema.shape(t("lineitem"))


ORDER_TYPES = [(0, "o_orderkey", "bigint"), (1, "o_custkey", "bigint"), (2, "o_orderstatus", "string"),
               (3, "o_totalprice", "double"), (4, "o_orderdate", "timestamp_ntz"), (5, "o_orderpriority", "string")]


@query("p12_schema_table", union_all(
    "SELECT {0}::INTEGER AS position, '{1}' AS name, '{2}' AS type, count(*) - count({1}) AS n_null FROM orders",
    ORDER_TYPES))
def _(t):
    orders = t("orders")
    nulls = quality.null_counts(orders).withColumnRenamed("column", "name")
    return schema.schema_table(orders).join(nulls, "name", "left")


@query("p13_columns_by_type",
       "SELECT min(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus "
       "FROM lineitem")
def _(t):
    lines = t("lineitem")
    number = schema.numeric_columns(lines, exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])[0]
    return lines.agg(F.min(number).alias(number), *[F.max(c).alias(c) for c in schema.text_columns(lines)])


@query("p14_drop_duplicate_names", "SELECT o_custkey AS key, o_orderkey AS id FROM orders")
def _(t):
    orders = t("orders")
    return schema.drop_duplicate_names(orders.select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("key")))


@query("p15_candidate_keys", """
SELECT 'event_id' AS "column", count(DISTINCT event_id) AS n_distinct, count(*) AS n_rows,
  count(DISTINCT event_id) = count(*) AS is_key FROM events
UNION ALL SELECT 'user_id', count(DISTINCT user_id), count(*), count(DISTINCT user_id) = count(*) FROM events""")
def _(t):
    return schema.candidate_keys(t("events"))


@query("p16_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t):
    return schema.preview(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@query("p17_renamed_output", on_base("SELECT customer_id AS \"Customer_ID\", contract AS cluster, 1 AS version FROM base"))
def _(t):
    return (t.base("customer_id", "contract").withColumnRenamed("customer_id", "Customer_ID")
            .select("Customer_ID", F.col("contract").alias("cluster"), F.lit(1).alias("version")))


@query("p18_missing_flags", on_base("""
SELECT customer_id, offer, offer IS NULL AS offer_missing, churn_reason IS NULL AS churn_reason_missing,
  churn_reason FROM base"""))
def _(t):
    return schema.missing_flag(t.base("customer_id", "offer", "churn_reason"), "offer", "churn_reason")


@query("p19_missing_patterns", on_base("""
SELECT (offer IS NULL)::INT::VARCHAR || (internet_type IS NULL)::INT::VARCHAR
  || (churn_reason IS NULL)::INT::VARCHAR AS pattern, count(*) AS n FROM base GROUP BY 1"""))
def _(t):
    columns = ["offer", "internet_type", "churn_reason"]
    return schema.missing_patterns(t.base(*columns), columns)


@query("p19_missing_matrix", on_base(f"""
SELECT customer_id, offer IS NULL AS offer, churn_reason IS NULL AS churn_reason FROM base
ORDER BY {hash_sql('customer_id', 'sample:42')}, customer_id LIMIT 500"""))
def _(t):
    return schema.missing_matrix(t.base("customer_id", "offer", "churn_reason"), "customer_id", 500)


@query("f01_count_null", on_base("SELECT count(*) AS null_offer FROM base WHERE offer IS NULL"))
def _(t):
    return quality.count_null(t.base("offer"), "offer")


@query("f02_rows_with_null", on_base("""
SELECT customer_id, offer, internet_type FROM base WHERE offer IS NULL OR internet_type IS NULL"""))
def _(t):
    return quality.rows_with_null(t.base("customer_id", "offer", "internet_type"))


@query("f02_first_rows_with_null", on_base("""
SELECT customer_id, offer, internet_type FROM base WHERE offer IS NULL OR internet_type IS NULL
ORDER BY customer_id LIMIT 10"""))
def _(t):
    return schema.preview(quality.rows_with_null(t.base("customer_id", "offer", "internet_type")), ["customer_id"], 10)


@query("f03_drop_null_rows", on_base("""
SELECT customer_id, offer, internet_type FROM base WHERE offer IS NOT NULL AND internet_type IS NOT NULL"""))
def _(t):
    return quality.drop_null_rows(t.base("customer_id", "offer", "internet_type"))


@query("f04_impute_constants", on_base("""
SELECT customer_id, coalesce(offer, 'No Offer') AS offer, coalesce(internet_type, 'No Internet') AS internet_type,
  coalesce(churn_reason, 'Not Churned') AS churn_reason, coalesce(churn_category, 'Not Churned') AS churn_category
FROM base"""))
def _(t):
    return quality.impute_constants(t.base("customer_id", "offer", "internet_type", "churn_reason", "churn_category"))


@query("f05_bernoulli_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {hash_sql('o_orderkey', 'sample:42')} < 0.1 * 4503599627370496""")
def _(t):
    return quality.bernoulli_sample(t("orders").select("o_orderkey", "o_totalprice"), 0.1, "o_orderkey")


@query("f05_random_sample")
def _(t):
    return quality.bernoulli_sample(t("orders").select("o_orderkey", "o_totalprice"), 0.1)


@query("f06_fixed_size_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_sql('o_orderkey', 'sample:42')}, o_orderkey LIMIT 500""")
def _(t):
    return hash_sample(t("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@query("f07_capped_sample", f"""
SELECT l_orderkey, l_linenumber FROM lineitem
ORDER BY ('0x' || substr(md5(l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR || ':sample:42'), 1, 13))::BIGINT,
  l_orderkey, l_linenumber LIMIT 20000""")
def _(t):
    return hash_sample(t("lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 20000)


@query("f08_membership", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return t("orders").where(F.col("o_orderpriority").cast("string").isin("1-URGENT", "2-HIGH"))


@query("f09_between", on_base("SELECT customer_id, tenure_in_months FROM base WHERE tenure_in_months BETWEEN 12 AND 24"))
def _(t):
    return t.base("customer_id", "tenure_in_months").where(F.col("tenure_in_months").between(12, 24))


@query("f10_composite_predicate", on_base("""
SELECT customer_id, churn, monthly_charge FROM base
WHERE (churn = 1 AND monthly_charge > 80) OR (tenure_in_months >= 12 AND tenure_in_months < 24)"""))
def _(t):
    months = F.col("tenure_in_months")
    rows = t.base("customer_id", "churn", "monthly_charge", "tenure_in_months").where(
        ((F.col("churn") == 1) & (F.col("monthly_charge") > 80)) | ((months >= 12) & (months < 24)))
    return rows.drop("tenure_in_months")


@query("f11_duplicate_count", """
SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS n_distinct,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS n_duplicates FROM documents""")
def _(t):
    return quality.duplicate_count(t("documents"), ["text"])


@query("f11_deduplicate", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return quality.deduplicate(t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("f11_first_copies", """
SELECT d.doc_id, d.lang, d.text FROM documents d JOIN (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text) k
  ON d.doc_id = k.doc_id""")
def _(t):
    return quality.first_copies(t("documents").select("doc_id", "lang", "text"), "text", "doc_id")


@query("u02_distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return t("orders").select("o_orderpriority").distinct()


@query("a08_null_counts", on_base(union_all(
    "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM base", BASE_COLUMNS)))
def _(t):
    return quality.null_counts(t.base())


@query("a09_blank_counts", on_base(union_all(
    "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_blank FROM base",
    ["customer_id", "offer", "avg_monthly_gb_download", "tenure_in_months"])))
def _(t):
    return quality.blank_counts(t.base("customer_id", "offer", "avg_monthly_gb_download", "tenure_in_months"))


@query("a09_blank_counts_after_imputing", on_base(union_all(
    "SELECT '{0}' AS \"column\", {1} AS n_blank FROM base",
    [("customer_id", "count(*) FILTER (WHERE customer_id IS NULL)"),
     ("offer", "count(*) FILTER (WHERE coalesce(offer, 'x') = '')"),
     ("internet_type", "count(*) FILTER (WHERE coalesce(internet_type, 'x') = '')")])))
def _(t):
    return quality.blank_counts(quality.impute_constants(t.base("customer_id", "offer", "internet_type")))


@query("a10_null_flags", on_base("""
SELECT customer_id, (offer IS NULL)::INT AS offer_nulls, (internet_type IS NULL)::INT AS internet_type_nulls
FROM base"""))
def _(t):
    return quality.null_flags(t.base("customer_id", "offer", "internet_type"), "customer_id")


@query("a11_nulls_by_segment", on_base("""
SELECT contract, offer IS NULL AS offer_missing, count(*) AS "count" FROM base GROUP BY 1, 2"""))
def _(t):
    return quality.nulls_by_segment(t.base("contract", "offer"), "offer", "contract")


@query("a02_value_counts", on_base(union_all(
    "SELECT '{c}' AS \"column\", {c}::VARCHAR AS value, count(*) AS \"count\" FROM base GROUP BY {c}",
    ["contract", "gender", "offer", "satisfaction_score", "churn"])))
def _(t):
    columns = ["contract", "gender", "offer", "satisfaction_score", "churn"]
    return quality.value_counts(t.base(*columns), columns)


@query("a37_top_categories", on_base("""
SELECT "column", value, "count" FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS LAST) AS r FROM (
    SELECT 'city' AS "column", city AS value, count(*) AS "count" FROM base GROUP BY city
    UNION ALL SELECT 'state', state, count(*) FROM base GROUP BY state)) WHERE r <= 10"""))
def _(t):
    return quality.value_counts(t.base("city", "state"), ["city", "state"], top=10)


@query("a06_distinct_counts", union_all(
    "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem",
    ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate"]))
def _(t):
    return quality.distinct_counts(t("lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                                                   "l_returnflag", "l_shipdate"])


@query("a07_approx_distinct_counts")
def _(t):
    return quality.approx_distinct_counts(t("lineitem"))


SKETCHED = ["l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate"]


@query("a07_distinct_sketches", union_all("""
SELECT '{c}' AS "column", count({c}) AS n_rows, count(DISTINCT {c}) AS n_exact, true AS within_bound FROM lineitem""",
                                          SKETCHED))
def _(t):
    """Distinct counts from states per return flag, beside the exact ones; the bound is four standard errors."""
    states = materialize(sketches.distinct_states(t("lineitem"), SKETCHED, by=["l_returnflag"]), "distinct-states")
    exact = quality.distinct_counts(t("lineitem"), SKETCHED, "n_exact")
    bound = 4 * 1.04 / 2 ** (sketches.REGISTERS / 2)
    return sketches.merged_distinct(states).join(exact, "column").select(
        "column", "n_rows", "n_exact", (F.abs(F.col("n_distinct") - F.col("n_exact")) <= bound * F.col("n_exact"))
        .alias("within_bound"))


@query("a14_quantile_sketches", union_all("""
SELECT '{0}' AS "column", {1}::DOUBLE AS probability, count({0}) AS n_rows, true AS within_bound FROM lineitem""",
                                          [(c, p) for c in ("l_extendedprice", "l_quantity")
                                           for p in (0.05, 0.25, 0.5, 0.75, 0.95)]))
def _(t):
    """Quantiles from states per ship mode; a rank lies within 2 % of the rows of what was asked for."""
    columns = ["l_extendedprice", "l_quantity"]
    states = materialize(sketches.quantile_states(t("lineitem"), columns, by=["l_returnflag"]), "quantile-states")
    found = materialize(sketches.merged_quantiles(states, [0.05, 0.25, 0.5, 0.75, 0.95]), "quantiles")
    ranks = sketches.ranks_of(t("lineitem"), found)
    near = (F.col("below") <= F.col("probability") + 0.02) & (F.col("up_to") >= F.col("probability") - 0.02)
    return ranks.join(found.select("column", "probability", "n_rows"), ["column", "probability"]).select(
        "column", "probability", "n_rows", near.alias("within_bound"))


@query("t04_null_counts_sorted", on_base("SELECT * FROM (" + union_all(
    "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM base",
    ["offer", "internet_type", "churn_reason", "contract"]) + ") ORDER BY n_null DESC, \"column\""))
def _(t):
    return quality.null_counts(t.base("offer", "internet_type", "churn_reason", "contract")).orderBy(
        F.desc("n_null"), "column")


@query("t04_distinct_counts_sorted", on_base("SELECT * FROM (" + union_all(
    "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM base",
    ["contract", "city", "state", "age"]) + ") ORDER BY n_distinct DESC, \"column\""))
def _(t):
    return quality.distinct_counts(t.base("contract", "city", "state", "age")).orderBy(F.desc("n_distinct"), "column")
