"""Filters, samples, de-duplication and null accounting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patrona.scale import hash_unit, long_values, per_column

# The text that stands for a missing entry, per column.
IMPUTE_DEFAULTS = {
    "churn_reason": "Not Churned",
    "churn_category": "Not Churned",
    "internet_type": "No Internet",
    "offer": "No Offer",
}


def count_null(df: DataFrame, column: str) -> DataFrame:
    """number of rows where the column is null."""
    return df.where(F.col(column).isNull()).agg(F.count("*").alias(f"null_{column}"))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(f"`{c}`").isNull() for c in columns])


def rows_with_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """rows that hold at least one null."""
    return df.where(any_null(columns or df.columns))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """rows without nulls in the given (or all) columns."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def impute_constants(df: DataFrame, values: dict[str, str] | None = None) -> DataFrame:
    """constants in place of nulls, for the named columns that exist."""
    values = values or IMPUTE_DEFAULTS
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def bernoulli_sample(df: DataFrame, fraction: float, key: str | Sequence[str] | None = None,
                     seed: int = 42) -> DataFrame:
    """each row kept with the given probability; by key hash when a key is named."""
    if key is None:
        return df.sample(False, fraction, seed)
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(hash_unit(*keys, seed=f"sample:{seed}") < fraction)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """rows minus distinct rows, in one aggregation.

    Long text is grouped by its length and SHA-256 digest, so whole documents do
    not travel through the shuffle.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    keys = []
    for f in fields:
        if isinstance(f.dataType, T.StringType):
            keys += [F.sha2(F.col(f"`{f.name}`"), 256).alias(f"h_{f.name}"),
                     F.length(F.col(f"`{f.name}`")).alias(f"l_{f.name}")]
        else:
            keys.append(F.col(f"`{f.name}`"))
    copies = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def deduplicate(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """one copy of each row (or of each combination of the given columns)."""
    return df.dropDuplicates(list(columns) if columns else None)


def first_copies(df: DataFrame, text: str, key: str) -> DataFrame:
    """the rows whose text is not a copy of a row with a smaller key.

    Only digest and key are shuffled; each digest keeps its smallest key, summed
    map-side first, so a text with very many copies is no hot group. The kept keys
    are joined back to the rows.
    """
    firsts = (df.groupBy(F.sha2(F.col(text), 256).alias("_digest"), F.length(text).alias("_length"))
              .agg(F.min(key).alias(key)).select(key))
    return df.join(firsts, key, "left_semi")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) for all columns in one pass."""
    return per_column(df, columns or df.columns, {"n_null": lambda c: F.count_if(c.isNull())})


def _blank(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(field.dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def blank_counts(df: DataFrame) -> DataFrame:
    """(column, n_blank) where blank is null, NaN in a float column or empty text."""
    row = df.agg(*[F.count_if(_blank(f)).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"_{i}").alias("n_blank"))
        for i, f in enumerate(df.schema.fields)])))


def null_flags(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: 0/1 null flag ``<column>_nulls`` per row."""
    names = columns or [c for c in df.columns if c != key]
    return df.select(key, *[F.col(c).isNull().cast("int").alias(f"{c}_nulls") for c in names])


def nulls_by_segment(df: DataFrame, column: str, segment: str) -> DataFrame:
    """Rows per segment and missing flag, in segment order."""
    flag = f"{column}_missing"
    return (df.groupBy(segment, F.col(column).isNull().alias(flag)).agg(F.count("*").alias("count"))
            .orderBy(segment, flag))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, label: str = "n_distinct") -> DataFrame:
    """Exact number of distinct non-null values of each column, in one aggregation."""
    return per_column(df, columns or df.columns, {label: F.count_distinct})


def approx_distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """Approximate distinct counts, one pass without a shuffle of values."""
    return per_column(df, columns or df.columns, {"n_distinct": lambda c: F.approx_count_distinct(c, rsd)})


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """(column, value, count) of several columns from one grouping.

    ``top`` keeps the most frequent values per column; ties go to the smaller value.
    """
    from pyspark.sql import Window as W
    counts = (long_values(df, columns, dtype="string").groupBy("column", "value")
              .agg(F.count("*").alias("count")))
    if top is not None:
        # Spark turns rank <= k into a per-task limit ahead of the shuffle.
        order = W.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_last("value"))
        counts = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top).drop("_rank")
    return counts.orderBy("column", F.desc("count"), F.asc_nulls_last("value"))
