"""Evaluation metrics as DataFrame operators.

Score-ordered metrics first count labels per distinct score and then use
:func:`patrona.scale.running_totals`, so ties form one step and no task sorts the
whole score column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrona.operators.joins import consecutive_periods
from patrona.scale import fits_broadcast, row_value, running_totals
from patrona.session import materialize


def confusion_matrix(df: DataFrame, label: str, prediction: str, max_cells: int = 10_000) -> DataFrame:
    """(label, prediction, count) for every pair of classes, zero cells included.

    More than ``max_cells`` occupied cells is an error, checked before they are put into one row.
    """
    cells = (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
             .groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
             .agg(F.count("*").alias("n")))
    cells = materialize(cells, "cells")
    if not fits_broadcast(cells, max_cells):
        raise ValueError(f"more than {max_cells} pairs of {label} and {prediction}")
    row = cells.agg(
        F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("classes"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("label", "prediction"), "n"))).alias("cells"))
    grid = (row.select("classes", "cells", F.explode("classes").alias("label"))
            .select("cells", "label", F.explode("classes").alias("prediction")))
    return grid.select("label", "prediction", F.coalesce(
        F.element_at("cells", F.struct("label", "prediction")), F.lit(0)).alias("count"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 (0 where a divisor is 0)."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(F.count("*").alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                    F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counts.select(
        "n", "tp", "fp", "fn", "tn", _div(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def _score_steps(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct score: positives, negatives, their running sums from below and totals."""
    y = F.col(label).cast("int")
    counted = (df.where(F.col(score).isNotNull() & y.isNotNull())
               .groupBy(*by, F.col(score).cast("double").alias("score"))
               .agg(F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")))
    return running_totals(counted, "score", ["pos", "neg"], by=by)


def roc_auc(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve as a rank sum with mid-ranks for ties, overall or per group."""
    steps = _score_steps(df, label, score, by)
    below = F.col("cum_neg") - F.col("neg") / 2
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return steps.groupBy(*by).agg(F.try_divide(F.sum(F.col("pos") * below), pairs).alias("roc_auc"))


def precision_recall_curve(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., threshold, tp, fp, precision, recall, recall_gain), one row per distinct score."""
    steps = _score_steps(df, label, score, by)
    tp = F.col("all_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    return steps.select(
        *by, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"), (tp / (tp + fp)).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("all_pos")), F.lit(1.0)).alias("recall"),
        F.coalesce(F.try_divide(F.col("pos"), F.col("all_pos")), F.lit(0.0)).alias("recall_gain"))


def average_precision(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum over score steps of the gain in recall times the precision."""
    curve = precision_recall_curve(df, label, score, by)
    return curve.groupBy(*by).agg(F.sum(F.col("recall_gain") * F.col("precision")).alias("average_precision"))


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """(roc_auc, average_precision) from one ranking of the scores."""
    steps = _score_steps(df, label, score)
    below = F.col("cum_neg") - F.col("neg") / 2
    tp = F.col("all_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    return steps.agg(
        F.try_divide(F.sum(F.col("pos") * below), F.max("all_pos").cast("double") * F.max("all_neg")).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * tp / (tp + fp)), F.max("all_pos")).alias("average_precision"))


def threshold_for_precision(df: DataFrame, label: str, score: str, target: float = 0.6,
                            default: float = 0.5) -> DataFrame:
    """Lowest threshold whose precision reaches the target, ``default`` when none does."""
    curve = precision_recall_curve(df, label, score)
    return curve.agg(F.coalesce(F.min(F.when(F.col("precision") >= target, F.col("threshold"))), F.lit(default))
                     .alias("threshold"))


def apply_threshold(df: DataFrame, score: str, threshold: Column | float, out: str = "prediction") -> DataFrame:
    """1 where the score reaches the threshold, else 0."""
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn(out, (F.col(score) >= cut).cast("int"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, RMSE, R2 and MAPE in percent (divisor at least 1e-8), in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("variance"),
        F.avg(F.abs((y - p) / F.greatest(F.abs(y), F.lit(1e-8)))).alias("ratio"))
    return sums.select("mae", F.sqrt("mse").alias("rmse"),
                       (1 - F.try_divide(F.col("mse"), F.col("variance"))).alias("r2"),
                       (F.col("ratio") * 100).alias("mape"))


def label_agreement(df: DataFrame, label_1: str, label_2: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., n_common, ari, nmi) of two labellings; NMI with the arithmetic mean of entropies.

    Everything is computed from the contingency counts. Two constant labellings
    score 1 in both measures.
    """
    cells = df.groupBy(*by, F.col(label_1).alias("a"), F.col(label_2).alias("b")).agg(F.count("*").alias("n"))
    rows = cells.groupBy(*by, "a").agg(F.sum("n").alias("n"))
    cols = cells.groupBy(*by, "b").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")

    def spread(frame: DataFrame, name: str) -> DataFrame:
        # Sum of squares and of n ln n: all that the two scores need from a margin.
        return frame.groupBy(*by).agg(F.sum(n * n).alias(f"sq_{name}"), F.sum(n * F.ln(n)).alias(f"ln_{name}"),
                                      F.count("*").alias(f"k_{name}"), F.sum("n").alias(f"n_{name}"))
    keys = list(by)
    parts = [spread(cells, "ab"), spread(rows, "a"), spread(cols, "b")]
    if keys:
        joined = parts[0].join(parts[1], keys).join(parts[2], keys)
    else:
        joined = parts[0].select("*", row_value(parts[1]).alias("_a"), row_value(parts[2]).alias("_b")).select(
            "*", "_a.*", "_b.*")
    total = F.col("n_ab").cast("double")
    both = F.col("sq_ab") - total                                    # pairs together in both
    only_b = F.col("sq_b") - F.col("sq_ab")                          # together in the second only
    only_a = F.col("sq_a") - F.col("sq_ab")                          # together in the first only
    none = total * total - both - only_a - only_b - total            # apart in both
    ari = F.when((only_a == 0) & (only_b == 0), 1.0).otherwise(
        F.try_divide(2.0 * (both * none - only_a * only_b),
                     (both + only_a) * (only_a + none) + (both + only_b) * (only_b + none)))
    entropy_a = F.ln(total) - F.col("ln_a") / total
    entropy_b = F.ln(total) - F.col("ln_b") / total
    mutual = entropy_a + entropy_b - (F.ln(total) - F.col("ln_ab") / total)
    nmi = (F.when((F.col("k_a") == 1) & (F.col("k_b") == 1), 1.0).when(mutual <= 1e-12, 0.0)
           .otherwise(mutual / ((entropy_a + entropy_b) / 2)))
    return joined.select(*keys, F.col("n_ab").alias("n_common"), ari.alias("ari"), nmi.alias("nmi"))


def cluster_stability(df: DataFrame, key: str, period: str, cluster: str) -> DataFrame:
    """Agreement of the clusters of neighbouring snapshots, over the keys they share.

    ``df`` has one row per (key, period).
    """
    pairs = consecutive_periods(df, key, period, cluster)
    return label_agreement(pairs, "label_1", "label_2", by=("period_1", "period_2"))
