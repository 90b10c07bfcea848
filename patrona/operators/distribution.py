"""Profiles of value distributions: describe, quantiles, histograms, box plots, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.operators.schema import numeric_columns, text_columns
from patrona.scale import lookup_join, long_values, per_column, row_value, running_totals


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max) of numeric columns."""
    return per_column(df, columns or numeric_columns(df), {
        "count": F.count,
        "mean": lambda c: F.avg(c.cast("double")),
        "stddev": lambda c: F.stddev_samp(c.cast("double")),
        "min": lambda c: F.min(c.cast("double")),
        "max": lambda c: F.max(c.cast("double")),
    })


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, n, q0, q1, ...) with linear interpolation between ranks.

    Values are counted first, ranked with :func:`running_totals`, and the two
    values around each rank are picked by one aggregate. Unlike the built-in exact
    percentile no group's values are held in one buffer.
    """
    values = long_values(df, columns, keep=by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = values.groupBy(*by, "column", "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counted, "value", ["n"], by=[*by, "column"])
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n")
    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("all_n") - 1)
        for name, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picks.append(F.max(F.when((first <= rank) & (rank < last), F.col("value"))).alias(f"{name}{i}"))
    picked = ranked.groupBy(*by, "column").agg(F.max("all_n").alias("n"), *picks)
    quantiles = []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("n") - 1)
        quantiles.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (place - F.floor(place)))
                         .alias(f"q{i}"))
    return picked.select(*by, "column", "n", *quantiles)


def quantile_summary(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False,
                     accuracy: int = 10000) -> DataFrame:
    """(column, min, p25, median, p75, max); one pass when approximate."""
    columns = columns or numeric_columns(df)
    if exact:
        q = exact_quantiles(df, columns, [0.0, 0.25, 0.5, 0.75, 1.0])
        return q.select("column", F.col("q0").alias("min"), F.col("q1").alias("p25"), F.col("q2").alias("median"),
                        F.col("q3").alias("p75"), F.col("q4").alias("max"))

    q = _sketched(df, columns, [0.25, 0.5, 0.75], accuracy)
    return q.select("column", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("p75"), "max")


def _sketched(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int) -> DataFrame:
    """(column, min, q, max) with approximate quantiles q from one sketch per column."""
    return per_column(df, columns, {
        "min": lambda c: F.min(c.cast("double")),
        "q": lambda c: F.percentile_approx(c.cast("double"), list(probabilities), accuracy),
        "max": lambda c: F.max(c.cast("double"))})


def iqr_summary(df: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> DataFrame:
    """(column, q1, q2, q3, iqr); approximate when a relative error is given."""
    if relative_error is None:
        q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
            "column", F.col("q0").alias("q1"), F.col("q1").alias("q2"), F.col("q2").alias("q3"))
    else:
        sketch = _sketched(df, columns, [0.25, 0.5, 0.75], max(1, round(1 / relative_error)))
        q = sketch.select("column", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])
    return q.withColumn("iqr", F.col("q3") - F.col("q1"))


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5, relative_error: float | None = None) -> DataFrame:
    """Rows outside the fences q1 - factor*iqr and q3 + factor*iqr."""
    fence = row_value(iqr_summary(df, [column], relative_error).drop("column"))
    marked = df.withColumn("_f", fence)
    low = F.col("_f.q1") - factor * F.col("_f.iqr")
    high = F.col("_f.q3") + factor * F.col("_f.iqr")
    return marked.where((F.col(column) < low) | (F.col(column) > high)).drop("_f")


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Profile of numeric and text columns: count, mean, std, min, quartiles, max, unique, top, freq."""
    columns = columns or df.columns
    numbers = [c for c in numeric_columns(df) if c in columns]
    texts = [c for c in text_columns(df) if c in columns]
    parts = []
    if numbers:
        left = describe(df, numbers)
        right = quantile_summary(df, numbers, exact=True).drop("min", "max")
        parts.append(left.join(right, "column", "left").select(
            "column", "count", "mean", "stddev", "min", "p25", "median", "p75", "max",
            F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("bigint").alias("freq")))
    if texts:
        counts = (long_values(df, texts, dtype="string").groupBy("column", "value").agg(F.count("*").alias("n")))
        seen = F.col("value").isNotNull()
        # Most frequent value, the smallest one on a tie.
        best = F.min_by("value", F.struct((-F.col("n")).alias("n"), "value"))
        none = F.lit(None).cast("double")
        parts.append(counts.where(seen).groupBy("column").agg(
            F.sum("n").alias("count"), F.count("*").alias("unique"), best.alias("top"), F.max("n").alias("freq"))
            .select("column", "count", none.alias("mean"), none.alias("stddev"), none.alias("min"),
                    none.alias("p25"), none.alias("median"), none.alias("p75"), none.alias("max"),
                    "unique", "top", "freq"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of two numeric columns."""
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"))


def yes_no(column: str) -> Column:
    """1/0 for a Yes/No text target, null otherwise."""
    text = F.lower(F.trim(F.col(column)))
    return F.when(text == "yes", 1).when(text == "no", 0)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(a, b, corr) for every pair of numeric columns, both ways, from one aggregate."""
    columns = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
                   for i, (a, b) in enumerate(pairs)])
    lines = []
    for i, (a, b) in enumerate(pairs):
        lines += [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_{i}").alias("corr"))
                  for x, y in dict.fromkeys([(a, b), (b, a)])]
    return row.select(F.inline(F.array(*lines)))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, corr) of each numeric feature with the target."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    y = F.col(target).cast("double")
    return per_column(df, columns, {"corr": lambda c: F.corr(c.cast("double"), y)})


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """(column, bin, low, high, count) over equal bins from minimum to maximum.

    The maximum belongs to the last bin, empty bins are listed, and a constant
    column is one bin. Nulls and NaN are left out.
    """
    values = long_values(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    # One row of edges per column, so the broadcast is bounded by the number of columns.
    edges = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    constant = F.col("lo") == F.col("hi")
    place = F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    counts = (values.join(F.broadcast(edges), "column")
              .groupBy("column", F.when(constant, 0).otherwise(place).cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    every = edges.select("column", "lo", "hi", F.explode(
        F.sequence(F.lit(0), F.when(constant, 0).otherwise(bins - 1))).alias("bin"))
    width = F.when(constant, 0.0).otherwise((F.col("hi") - F.col("lo")) / bins)
    return (every.join(F.broadcast(counts), ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("low"),
                    F.when(constant, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
                    F.coalesce("n", F.lit(0)).alias("count"))
            .orderBy("column", "bin"))


def box_stats(df: DataFrame, column: str, by: str | None = None, factor: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and number of outliers, overall or per category."""
    keys = [by] if by else []
    source = df.select(*keys, F.col(column).cast("double").alias("value")).where(F.col("value").isNotNull())
    if by:
        source = source.where(F.col(by).isNotNull())
    q = exact_quantiles(source, ["value"], [0.25, 0.5, 0.75], by=keys).select(
        *keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    if by:
        marked = lookup_join(source, q, by, "inner")
    else:
        marked = source.withColumn("_q", row_value(q)).select("value", "_q.*")
    spread = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - factor * spread, F.col("q3") + factor * spread)
    return marked.groupBy(*keys).agg(
        F.count("*").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
