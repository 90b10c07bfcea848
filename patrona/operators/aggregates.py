"""Grouped counts, shares, rates and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.operators.schema import numeric_columns
from patrona.scale import lookup_join, per_column


def group_count(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def count_present(df: DataFrame, column: str, by: str) -> DataFrame:
    """Non-null values of a column per group."""
    return df.groupBy(by).agg(F.count(column).alias(f"count_{column}"))


def crosstab(df: DataFrame, row: str, col: str, levels: Sequence | None = None, max_levels: int = 1000) -> DataFrame:
    """Counts with one output column per level of ``col``; missing cells are 0.

    Levels are read from the data unless given; more than ``max_levels`` is an
    error, since they become columns.
    """
    if levels is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"{col} has more than {max_levels} levels")
        levels = sorted(r[0] for r in found)
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == level).alias(str(level)) for level in levels])


def crosstab_share(df: DataFrame, row: str, col: str, digits: int = 3) -> DataFrame:
    """(row, col, count, share) where share is the part of the row group, rounded."""
    counts = df.groupBy(row, col).agg(F.count("*").alias("count"))
    totals = counts.groupBy(F.col(row).alias("_row")).agg(F.sum("count").alias("_total"))
    joined = counts.join(totals, counts[row].eqNullSafe(totals["_row"]))
    return joined.select(row, col, "count", F.round(F.col("count") / F.col("_total"), digits).alias("share"))


def group_mean(df: DataFrame, by: str, column: str, name: str, digits: int = 2) -> DataFrame:
    """Rounded mean per group."""
    return df.groupBy(by).agg(F.round(F.avg(column), digits).alias(name))


def rate_pct(condition: Column, digits: int = 2) -> Column:
    """Share of rows that satisfy the condition, in percent, as an aggregate."""
    return F.round(F.try_divide(100 * F.count_if(condition), F.count("*")), digits)


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """The column's mean, from a scalar subquery, in place of nulls."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), mean))


def cluster_means(df: DataFrame, cluster: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of each numeric column by cluster, ordered by cluster."""
    columns = columns or numeric_columns(df, exclude=[cluster])
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns]).orderBy(cluster)


def cluster_profile(df: DataFrame, cluster: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean and non-null count of each numeric column by cluster."""
    columns = columns or numeric_columns(df, exclude=[cluster])
    aggs = [f(c).alias(f"{c}_{name}") for c in columns for name, f in (("mean", F.avg), ("count", F.count))]
    return df.groupBy(cluster).agg(F.count("*").alias("n"), *aggs)


def long_cluster_means(df: DataFrame, cluster: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A29 in long form: (cluster, feature, mean)."""
    columns = columns or numeric_columns(df, exclude=[cluster])
    means = df.groupBy(cluster).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    return means.unpivot([cluster], list(columns), "feature", "mean")


def rank_varying_features(df: DataFrame, cluster: str, columns: Sequence[str] | None = None, k: int = 8) -> DataFrame:
    """The k features whose cluster means vary most (sample variance of the means)."""
    return (long_cluster_means(df, cluster, columns).groupBy("feature")
            .agg(F.var_samp("mean").alias("variance"))
            .orderBy(F.desc_nulls_last("variance"), "feature").limit(k))


def normalized_cluster_means(df: DataFrame, cluster: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Cluster means scaled to 0..1 per feature; null where all clusters agree."""
    means = long_cluster_means(df, cluster, columns)
    # One row per feature, so the broadcast is bounded by the number of columns.
    span = means.groupBy("feature").agg(F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    return means.join(F.broadcast(span), "feature").select(
        cluster, "feature",
        F.try_divide(F.col("mean") - F.col("lo"), F.col("hi") - F.col("lo")).alias("normalized"))


def cluster_relevance(df: DataFrame, cluster: str, kpis: Sequence[str], external: DataFrame | None = None,
                      key: str | None = None) -> DataFrame:
    """KPI means by cluster, with the means of external feedback joined by key."""
    if external is not None:
        extra = [c for c in external.columns if c != key]
        df = df.select(key, cluster, *kpis).join(external, key, "left")
        kpis = [*kpis, *[c for c in extra if c in numeric_columns(external)]]
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in kpis])


def share_by_month(df: DataFrame, time: str, cluster: str, digits: int | None = None) -> DataFrame:
    """Share of each cluster within a calendar month."""
    month = F.date_format(F.date_trunc("month", F.to_timestamp(time)), "yyyy-MM")
    counts = df.groupBy(month.alias("period"), cluster).agg(F.count("*").alias("count"))
    # One row per calendar month.
    totals = counts.groupBy("period").agg(F.sum("count").alias("_total"))
    share = F.col("count") / F.col("_total")
    return lookup_join(counts, totals, "period", "inner").select(
        "period", cluster, "count", (F.round(share, digits) if digits else share).alias("share"))


def kpis(df: DataFrame) -> DataFrame:
    """The four headline figures in one aggregate."""
    return df.agg(F.count("*").alias("total_customers"), F.round(F.avg("cltv"), 2).alias("avg_cltv"),
                  rate_pct(F.col("churn") == 1).alias("churn_rate_pct"),
                  F.round(F.avg("satisfaction_score"), 2).alias("avg_satisfaction"))


def constant_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """M09 in SQL form: (column, variance, kept) with population variance against the threshold."""
    stats = per_column(df, columns, {"variance": lambda c: F.var_pop(c.cast("double"))})
    return stats.withColumn("kept", F.col("variance") > threshold)
