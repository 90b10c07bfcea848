"""Queries for profiles, cross-tabs and cluster summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded, union_all
from patrona.catalogue.registry import on_base, query
from patrona.operators import aggregates, distribution

NUMBERS = ["age", "tenure_in_months", "monthly_charge", "total_revenue", "cltv", "avg_monthly_gb_download"]


@query("a12_describe", on_base(union_all(f"""
SELECT '{{c}}' AS "column", count({{c}}) AS "count", {rnd('avg({c})')} AS mean, {rnd('stddev_samp({c})')} AS stddev,
  {rnd('min({c})')} AS min, {rnd('max({c})')} AS max FROM base""", NUMBERS)))
def _(t):
    return rounded(distribution.describe(t.base(*NUMBERS), NUMBERS))


@query("a13_describe_all", on_base(union_all(f"""
SELECT '{{c}}' AS "column", count({{c}}) AS "count", {rnd('avg({c})')} AS mean, {rnd('stddev_samp({c})')} AS stddev,
  {rnd('min({c})')} AS min, {rnd('quantile_cont({c}, 0.25)')} AS p25, {rnd('quantile_cont({c}, 0.5)')} AS median,
  {rnd('quantile_cont({c}, 0.75)')} AS p75, {rnd('max({c})')} AS max, NULL::BIGINT AS "unique", NULL AS top,
  NULL::BIGINT AS freq FROM base""", ["age::DOUBLE", "monthly_charge", "avg_monthly_gb_download"]).replace(
    "'age::DOUBLE'", "'age'") + "\nUNION ALL\n" + union_all("""
SELECT '{c}', sum(n)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), arg_min(value, (-n, value)), max(n)
FROM (SELECT {c} AS value, count(*) AS n FROM base WHERE {c} IS NOT NULL GROUP BY 1)""",
                                                         ["contract", "offer", "city"])))
def _(t):
    columns = ["age", "monthly_charge", "avg_monthly_gb_download", "contract", "offer", "city"]
    return rounded(distribution.describe_all(t.base(*columns)))


@query("a14_quantile_summary", on_base(union_all(f"""
SELECT '{{0}}' AS "column", {rnd('min({1})')} AS min, {rnd('quantile_cont({1}, 0.25)')} AS p25,
  {rnd('quantile_cont({1}, 0.5)')} AS median, {rnd('quantile_cont({1}, 0.75)')} AS p75, {rnd('max({1})')} AS max
FROM base""", [(c, f"{c}::DOUBLE") for c in NUMBERS])))
def _(t):
    return rounded(distribution.quantile_summary(t.base(*NUMBERS), NUMBERS, exact=True))


@query("a14_approx_quantile_summary")
def _(t):
    return distribution.quantile_summary(t("lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@query("a15_iqr_summary", union_all(f"""
SELECT '{{c}}' AS "column", {rnd('quantile_cont({c}, 0.25)')} AS q1, {rnd('quantile_cont({c}, 0.5)')} AS q2,
  {rnd('quantile_cont({c}, 0.75)')} AS q3, {rnd('quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)')} AS iqr
FROM lineitem""", ["l_extendedprice", "l_quantity"]))
def _(t):
    return rounded(distribution.iqr_summary(t("lineitem"), ["l_extendedprice", "l_quantity"]))


@query("a15_approx_iqr_summary")
def _(t):
    return distribution.iqr_summary(t("lineitem"), ["l_extendedprice", "l_quantity"], relative_error=0.05)


@query("a15_iqr_outliers", on_base("""
SELECT customer_id, total_revenue FROM base, (SELECT quantile_cont(total_revenue, 0.25) AS q1,
  quantile_cont(total_revenue, 0.75) AS q3 FROM base)
WHERE total_revenue < q1 - 1.5 * (q3 - q1) OR total_revenue > q3 + 1.5 * (q3 - q1)"""))
def _(t):
    return distribution.iqr_outliers(t.base("customer_id", "total_revenue"), "total_revenue")


@query("a16_correlation", on_base(f"SELECT {rnd('corr(monthly_charge, churn)')} AS corr FROM base"))
def _(t):
    answered = t.base("monthly_charge", "churn").withColumn("churned", F.when(F.col("churn") == 1, "Yes").otherwise("No"))
    return rounded(distribution.correlation(answered.withColumn("target", distribution.yes_no("churned")),
                                            "monthly_charge", "target"))


CORRELATED = ["age", "tenure_in_months", "monthly_charge", "cltv", "satisfaction_score"]


@query("a17_correlation_matrix", on_base(union_all(
    f"SELECT '{{0}}' AS a, '{{1}}' AS b, {rnd('corr({0}, {1})')} AS corr FROM base",
    [(a, b) for a in CORRELATED for b in CORRELATED])))
def _(t):
    return rounded(distribution.correlation_matrix(t.base(*CORRELATED), CORRELATED))


@query("a17_correlation_with_target", on_base(union_all(
    f"SELECT '{{c}}' AS \"column\", {rnd('corr({c}, cltv)')} AS corr FROM base",
    [c for c in CORRELATED if c != "cltv"])))
def _(t):
    return rounded(distribution.correlation_with(t.base(*CORRELATED), "cltv", CORRELATED))


@query("a18_crosstab", on_base("""
SELECT contract, count(*) FILTER (WHERE churn = 0) AS "0", count(*) FILTER (WHERE churn = 1) AS "1"
FROM base GROUP BY 1"""))
def _(t):
    return aggregates.crosstab(t.base("contract", "churn"), "contract", "churn")


@query("a19_crosstab_share", on_base(f"""
SELECT contract, offer, count(*) AS "count",
  {rnd('count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY contract)', 3)} AS share FROM base GROUP BY 1, 2"""))
def _(t):
    return aggregates.crosstab_share(t.base("contract", "offer"), "contract", "offer")


@query("a29_cluster_means", on_base("SELECT contract, " + ", ".join(
    f"{rnd(f'avg({c})')} AS {c}" for c in NUMBERS) + " FROM base GROUP BY 1"))
def _(t):
    return rounded(aggregates.cluster_means(t.base("contract", *NUMBERS), "contract", NUMBERS))


@query("a30_cluster_profile", on_base("SELECT contract, count(*) AS n, " + ", ".join(
    f"{rnd(f'avg({c})')} AS {c}_mean, count({c}) AS {c}_count" for c in NUMBERS) + " FROM base GROUP BY 1"))
def _(t):
    return rounded(aggregates.cluster_profile(t.base("contract", *NUMBERS), "contract", NUMBERS))


MEANS = "means AS (" + union_all(
    "SELECT contract, '{c}' AS feature, avg({c})::DOUBLE AS mean FROM base GROUP BY 1", NUMBERS) + ")"


@query("a31_varying_features", on_base(f"""
SELECT feature, {rnd('var_samp(mean)', 4)} AS variance FROM means GROUP BY 1
ORDER BY var_samp(mean) DESC, feature LIMIT 3""", MEANS))
def _(t):
    return rounded(aggregates.rank_varying_features(t.base("contract", *NUMBERS), "contract", NUMBERS, k=3), 4)


@query("a32_normalized_cluster_means", on_base(f"""
SELECT contract, feature, {rnd('''(mean - min(mean) OVER (PARTITION BY feature))
  / nullif(max(mean) OVER (PARTITION BY feature) - min(mean) OVER (PARTITION BY feature), 0)''')} AS normalized
FROM means""", MEANS))
def _(t):
    return rounded(aggregates.normalized_cluster_means(t.base("contract", *NUMBERS), "contract", NUMBERS))


@query("a34_share_by_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority, count(*) AS "count",
  count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY strftime(o_orderdate, '%Y-%m')) AS share
FROM orders GROUP BY 1, 2""")
def _(t):
    return aggregates.share_by_month(t("orders"), "o_orderdate", "o_orderpriority")


def _histogram_sql(column, table, bins):
    return f"""
SELECT '{column}' AS "column", bin::INT AS bin, lo + bin * ((hi - lo) / {bins}) AS low,
  lo + (bin + 1) * ((hi - lo) / {bins}) AS high, coalesce(n, 0) AS "count"
FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}), range({bins}) bins(bin)
LEFT JOIN (SELECT least(floor(({column} - lo) * {bins} / (hi - lo)), {bins} - 1)::BIGINT AS bin, count(*) AS n
  FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
  WHERE {column} IS NOT NULL GROUP BY 1) USING (bin)"""


@query("a35_histogram_30", on_base(_histogram_sql("monthly_charge", "base", 30) + " UNION ALL "
                                   + _histogram_sql("cltv", "base", 30)))
def _(t):
    return distribution.histogram(t.base("monthly_charge", "cltv"), ["monthly_charge", "cltv"], 30)


@query("a35_histogram_50", _histogram_sql("l_extendedprice", "lineitem", 50))
def _(t):
    return distribution.histogram(t("lineitem"), ["l_extendedprice"], 50)


BOX = f"""
SELECT {{0}} count(*) AS n, {rnd('min(q1)')} AS q1, {rnd('min(q2)')} AS median, {rnd('min(q3)')} AS q3,
  {rnd('min(v) FILTER (WHERE inside)')} AS whisker_low, {rnd('max(v) FILTER (WHERE inside)')} AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS n_outliers
FROM (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM (
  SELECT contract, total_revenue AS v, quantile_cont(total_revenue, 0.25) OVER ({{1}}) AS q1,
    quantile_cont(total_revenue, 0.5) OVER ({{1}}) AS q2, quantile_cont(total_revenue, 0.75) OVER ({{1}}) AS q3
  FROM base WHERE total_revenue IS NOT NULL)) {{2}}"""


@query("a36_box_stats", on_base(BOX.format("", "", "")))
def _(t):
    return rounded(distribution.box_stats(t.base("total_revenue"), "total_revenue"))


@query("a36_box_stats_by_contract", on_base(BOX.format("contract,", "PARTITION BY contract", "GROUP BY contract")))
def _(t):
    return rounded(distribution.box_stats(t.base("contract", "total_revenue"), "total_revenue", by="contract"))
