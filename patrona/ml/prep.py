"""Preparation for models: scaling, encoding, imputation, splits, folds, weights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VarianceThresholdSelector, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.ml.preparation import Preparation
from patrona.operators.distribution import exact_quantiles
from patrona.operators.schema import numeric_columns, text_columns
from patrona.scale import hash_long, hash_unit, lookup_join, long_values, row_value, running_totals


def standard_scale(df: DataFrame, columns: Sequence[str], population: bool = True) -> DataFrame:
    """(x - mean) / standard deviation, divisor 1 where the deviation is 0."""
    deviation = F.stddev_pop if population else F.stddev_samp
    moments = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(columns)
                       for name, f in (("m", F.avg), ("s", deviation))])
    marked = df.withColumn("_moments", row_value(moments))
    scaled = {}
    for i, c in enumerate(columns):
        spread = F.col(f"_moments.s_{i}")
        scaled[c] = (F.col(c) - F.col(f"_moments.m_{i}")) / F.when(spread > 0, spread).otherwise(1.0)
    return marked.withColumns(scaled).drop("_moments")


def levels_of(df: DataFrame, column: str, max_levels: int = 1000) -> list:
    """Sorted levels of a category; an error when there are more than ``max_levels``."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels")
    return sorted(r[0] for r in found)


def one_hot_columns(df: DataFrame, column: str, levels: Sequence | None = None) -> DataFrame:
    """One 0/1 column ``<column>_<level>`` per level; unknown and null rows are all 0."""
    levels = levels if levels is not None else levels_of(df, column)
    flags = {f"{column}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0)) for level in levels}
    return df.withColumns(flags).drop(column)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median in place of nulls, all columns from one ranking job."""
    medians = exact_quantiles(df, columns, [0.5])
    row = medians.agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(f"m{i}") for i, c in enumerate(columns)])
    marked = df.withColumn("_m", row_value(row))
    return marked.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m.m{i}"))
                               for i, c in enumerate(columns)}).drop("_m")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent value, the smallest on a tie."""
    counts = (long_values(df, columns, dtype="string").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("mode"))


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value in place of nulls in text columns."""
    table = modes(df, columns)
    row = table.agg(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(f"m{i}") for i, c in enumerate(columns)])
    marked = df.withColumn("_m", row_value(row))
    return marked.withColumns({c: F.coalesce(F.col(c), F.col(f"_m.m{i}")) for i, c in enumerate(columns)}).drop("_m")


def preprocessor(train: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
                 impute: bool = False, scale: bool = True, exclude: Sequence[str] = (),
                 output: str = "features", max_levels: int = 10_000) -> Preparation:
    """The preparation of these columns, by default all numeric and all text ones of ``train``.

    Nothing is learnt here; ``fit`` learns from the rows it is given.
    """
    if numeric is None:
        numeric = numeric_columns(train, exclude)
    if categorical is None:
        categorical = text_columns(train, exclude)
    return Preparation(numeric, categorical, impute, scale, output, max_levels)


def preprocessed_names(model, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Names of the slots of the assembled vector, from the fitted stages."""
    levels = [labels for stage in model.stages if hasattr(stage, "labelsArray") for labels in stage.labelsArray]
    return [*numeric, *[f"{c}_{level}" for c, labels in zip(categorical, levels) for level in labels]]


def vector_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the slots of a vector column, from its metadata."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _i, name in slots]


def cardinalities(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Distinct non-null values per column, all columns in one aggregate."""
    if not columns:
        return {}
    row = df.agg(*[F.count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"d{i}"] for i, c in enumerate(columns)}


def with_few_values(df: DataFrame, columns: Sequence[str], limit: int) -> list[str]:
    """Columns with at most ``limit`` distinct non-null values.

    A sketch rules out columns of more than twice the limit; only the others are
    counted exactly, so no large set of values is shuffled.
    """
    if not columns:
        return []
    rough = df.agg(*[F.approx_count_distinct(F.col(c), 0.02).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    near = [c for i, c in enumerate(columns) if rough[f"d{i}"] <= 2 * limit]
    counts = cardinalities(df, near)
    return [c for c in near if counts[c] <= limit]


def few_valued_to_categorical(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                              limit: int = 5) -> tuple[list[str], list[str]]:
    """Numeric columns with at most ``limit`` values join the categorical list."""
    few = with_few_values(df, numeric, limit)
    return [c for c in numeric if c not in few], [*categorical, *few]


def split_by_cardinality(df: DataFrame, categorical: Sequence[str], limit: int = 25) -> tuple[list[str], list[str]]:
    """Categoricals with at most ``limit`` values (one-hot) and the others (frequency encoding)."""
    low = with_few_values(df, categorical, limit)
    return low, [c for c in categorical if c not in low]


def drop_constant_slots(threshold: float = 1e-4, features: str = "features",
                        output: str = "selected") -> VarianceThresholdSelector:
    """Selector of vector slots whose sample variance exceeds the threshold."""
    return VarianceThresholdSelector(varianceThreshold=threshold, featuresCol=features, outputCol=output)


def pca_keeping(df: DataFrame, share: float = 0.95, features: str = "features", output: str = "pca"):
    """Centred PCA with as many components as explain ``share`` of the variance.

    Returns (frame, fitted pipeline, explained shares of the kept components).
    """
    size = len(df.select(features).first()[0])
    centre = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="_centred")
    fitted = Pipeline(stages=[centre, PCA(k=size, inputCol="_centred", outputCol="_all")]).fit(df)
    explained = np.asarray(fitted.stages[-1].explainedVariance.toArray())
    keep = min(int(np.searchsorted(np.cumsum(explained), share - 1e-12) + 1), size)
    cut = VectorSlicer(inputCol="_all", outputCol=output, indices=list(range(keep)))
    model = Pipeline(stages=[*fitted.stages, cut]).fit(df)
    return model.transform(df).drop("_centred", "_all"), model, explained[:keep]


def pca_points(df: DataFrame, k: int = 2, features: str = "features", output: str = "pca") -> DataFrame:
    """Centred projection to k components."""
    centre = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="_centred")
    model = Pipeline(stages=[centre, PCA(k=k, inputCol="_centred", outputCol=output)]).fit(df)
    return model.transform(df).drop("_centred")


def random_split(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Repeatable train and test split by key hash, without a shuffle."""
    u = hash_unit(key, seed=seed)
    return df.where(u < fraction), df.where(u >= fraction)


def _class_cuts(df: DataFrame, key: str, label: str, shares: Sequence[float], seed: int) -> DataFrame:
    """Rows with their hash ``_h`` and the hashes ``_cuts`` below which the given shares of their class lie.

    The cuts are exact ranks, so each part holds the share of its class to one row.
    """
    # The class as text, so that rows without a label form a class of their own
    hashed = df.withColumns({"_h": hash_long(key, seed=seed), "_class": F.to_json(F.struct(label))})
    counted = hashed.groupBy("_class", "_h").agg(F.count("*").alias("_n"))
    ranked = running_totals(counted, "_h", ["_n"], by=["_class"])

    def cut(share):
        wanted = F.ceil(F.round(F.col("all__n") * float(share), 6))
        return F.min(F.when(F.col("cum__n") >= wanted, F.col("_h")))
    cuts = ranked.groupBy("_class").agg(F.array(*[cut(s) for s in shares]).alias("_cuts"))
    return lookup_join(hashed, cuts, "_class").drop("_class")


def stratified_split(df: DataFrame, key: str, label: str, fraction: float = 0.8,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split that keeps class shares: each class is cut at the quantile of its key hashes."""
    marked = _class_cuts(df, key, label, [fraction], seed)
    train = F.col("_h") <= F.col("_cuts")[0]
    return marked.where(train).drop("_h", "_cuts"), marked.where(~train).drop("_h", "_cuts")


def fold_column(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from the key hash."""
    return df.withColumn(name, F.pmod(hash_long(key, seed=seed), F.lit(k)).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Fold number with equal class shares: class-wise quantiles of the key hash."""
    marked = _class_cuts(df, key, label, [i / k for i in range(1, k)], seed)
    fold = F.size(F.filter("_cuts", lambda c: c < F.col("_h")))
    return marked.withColumn(name, fold).drop("_h", "_cuts")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight n / (classes * n_class) on every row."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    totals = counts.agg(F.sum("_n").alias("n"), F.count("*").alias("k"))
    table = (counts.withColumn("_t", row_value(totals))
             .select(label, (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias(name)))
    return lookup_join(df, table, label)


def positive_weight(label: str, weight: float) -> Column:
    """Weight of the positive class, 1 for the others."""
    return F.when(F.col(label) == 1, float(weight)).otherwise(1.0)


def top_slots(names: Sequence[str], importances: Sequence[float], k: int = 20) -> list[int]:
    """Positions of the k most important slots, ties by position."""
    order = sorted(range(len(names)), key=lambda i: (-importances[i], i))
    return sorted(order[:k])


def keep_slots(indices: Sequence[int], features: str = "features", output: str = "top_features") -> VectorSlicer:
    """Slicer of the chosen vector slots."""
    return VectorSlicer(inputCol=features, outputCol=output, indices=list(indices))
