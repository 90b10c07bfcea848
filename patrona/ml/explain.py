"""Model explanation: permutation importance and sampled Shapley values."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.ml import metrics
from patrona.ml.models import probability
from patrona.scale import hash_long

BLOCK_BITS = 12


def with_donor(df: DataFrame, key: str, features: str = "features", seed: int = 42) -> DataFrame:
    """Adds ``_donor``: the features of another row, every row being donor exactly once.

    Rows are ordered by key hash and each takes the features of the next row; the
    last row of a hash block takes those of the first row of the next block. This is
    one cycle over all rows, whatever their number, without a global sort. Keys are
    unique.
    """
    marked = df.withColumns({"_values": vector_to_array(features), "_turn": hash_long(key, seed=f"donor:{seed}")})
    marked = marked.withColumn("_block", F.shiftright("_turn", 52 - BLOCK_BITS))
    order = W.partitionBy("_block").orderBy("_turn", key)
    heads = marked.groupBy("_block").agg(F.min_by("_values", F.struct("_turn", key)).alias("_head"))
    blocks = W.orderBy("_block")  # one row per block, 2**BLOCK_BITS at most
    heads = heads.select("_block", F.coalesce(F.lead("_head").over(blocks), F.first("_head").over(
        blocks.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_next"))
    return (marked.withColumn("_donor", F.lead("_values").over(order)).join(F.broadcast(heads), "_block")
            .withColumn("_donor", F.coalesce("_donor", "_next")).drop("_block", "_turn", "_next"))


def permutation_importance(model: Model, df: DataFrame, key: str, names: Sequence[str], label: str = "label",
                           features: str = "features", seed: int = 42) -> DataFrame:
    """(feature, importance): loss of ROC area when one feature is permuted across rows.

    All features are scored in one pass: each row is repeated once per feature with
    that slot taken from its donor, and the area is computed per feature.
    """
    donor = with_donor(df.select(key, label, features), key, features, seed)
    slots = F.array(*[F.lit(i) for i in range(-1, len(names))])
    mixed = donor.select(key, label, F.explode(slots).alias("slot"), "_values", "_donor").select(
        label, "slot", array_to_vector(F.transform(
            "_values", lambda x, i: F.when(i == F.col("slot"), F.get("_donor", i)).otherwise(x))).alias(features))
    scored = model.transform(mixed).select(label, "slot", probability().alias("score"))
    areas = metrics.roc_auc(scored, label, "score", by=("slot",))
    whole = areas.where(F.col("slot") == -1).select("roc_auc").scalar()
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    return areas.withColumn("whole", whole).where(F.col("slot") >= 0).select(
        feature.alias("feature"), (F.col("whole") - F.col("roc_auc")).alias("importance"))


def mean_point(df: DataFrame, features: str = "features") -> list[float]:
    """Mean of a vector column, as the point that explanations start from."""
    means = (df.select(F.posexplode(vector_to_array(features)).alias("slot", "x")).groupBy("slot")
             .agg(F.avg("x").alias("mean")).orderBy("slot").collect())  # one row per slot
    return [r["mean"] for r in means]


def walks_of(size: int, orders: int, seed: int = 42) -> list[list[int]]:
    """Feature orders in antithetic pairs: every random order and its reverse."""
    rng = random.Random(seed)
    walks = []
    while len(walks) < orders:
        order = rng.sample(range(size), size)
        walks += [order, order[::-1]]
    return walks[:max(orders, 1)]


def _walk_points(walks: Sequence[Sequence[int]], start: Sequence[float]):
    """Function giving every point of every walk of each row: (key, values, baseline to own values)."""
    size = len(start)
    before = np.zeros((len(walks), size + 1, size), bool)  # is this slot already the row's own?
    for w, walk in enumerate(walks):
        for step, slot in enumerate(walk):
            before[w, step + 1:, slot] = True
    before = before.reshape(-1, size)
    base = np.asarray(start, float)

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, values = pdf.iloc[:, 0].to_numpy(), pdf["values"].to_numpy()
            for begin in range(0, len(keys), 64):
                own = np.stack(values[begin:begin + 64])
                mixed = np.where(before[None], own[:, None, :], base)
                yield pd.DataFrame({
                    pdf.columns[0]: np.repeat(keys[begin:begin + 64], len(before)),
                    "point": np.tile(np.arange(len(before)), len(own)),
                    "values": list(mixed.reshape(-1, size))})
    return points


def _walk_changes(walks: Sequence[Sequence[int]], size: int):
    """Function turning the scores of a row's walks, which follow one another, into its contributions."""
    slots = np.array(walks)

    def changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length = len(walks) * (size + 1)
        rest: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            whole = len(pdf) // length * length
            rest = pdf.iloc[whole:]
            if not whole:
                continue
            part = pdf.iloc[:whole]
            if not (part["point"].to_numpy().reshape(-1, length) == np.arange(length)).all():
                raise ValueError("the points of a walk were torn apart")
            step = np.diff(part["score"].to_numpy().reshape(-1, len(walks), size + 1), axis=2)
            total = np.zeros((len(step), size))
            for w in range(len(walks)):
                total[:, slots[w]] += step[:, w]
            yield pd.DataFrame({pdf.columns[0]: part.iloc[::length, 0].to_numpy(),
                                "contributions": list(total / len(walks))})
        if rest is not None and len(rest):
            raise ValueError("the points of a walk were torn apart")
    return changes


def shapley_values(model: Model, df: DataFrame, key: str, names: Sequence[str], baseline: Sequence[float],
                   score: Column | None = None, features: str = "features", orders: int = 2,
                   seed: int = 42) -> DataFrame:
    """(key, feature, contribution): sampled Shapley values against a baseline point.

    A row walks from the baseline to its own values, one feature per step, in antithetic
    orders; a feature's contribution is the change of the score at its step, averaged over
    the orders, so contributions add up to the score minus that of the baseline. All points
    of a row are made, scored by the model itself and turned into contributions inside
    one task: nothing is shuffled.
    """
    walks = walks_of(len(names), orders, seed)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, vector_to_array(features).alias("values"))
    mixed = rows.mapInPandas(_walk_points(walks, baseline), f"`{key}` {kind}, point long, values array<double>")
    scored = model.transform(mixed.select(key, "point", array_to_vector("values").alias(features))).select(
        key, "point", (score if score is not None else probability()).alias("score"))
    summed = scored.mapInPandas(_walk_changes(walks, len(names)), f"`{key}` {kind}, contributions array<double>")
    feature = F.array(*[F.lit(n) for n in names])
    return summed.select(key, F.posexplode("contributions").alias("slot", "contribution")).select(
        key, F.get(feature, F.col("slot")).alias("feature"), "contribution")


def additivity(model: Model, df: DataFrame, values: DataFrame, key: str, baseline: Sequence[float],
               score: Column | None = None, features: str = "features") -> DataFrame:
    """(key, contributions, score, start): what the contributions of a row add up to, beside its score."""
    score = score if score is not None else probability()
    point = df.sparkSession.createDataFrame([([float(b) for b in baseline],)], "v array<double>").select(
        array_to_vector("v").alias(features))
    start = model.transform(point).select(score.alias("s")).first()["s"]
    sums = values.groupBy(key).agg(F.sum("contribution").alias("contributions"))
    return model.transform(df).select(key, score.alias("score"), F.lit(start).alias("start")).join(sums, key)


def shapley_summary(values: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, highest first."""
    return (values.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
            .orderBy(F.desc("mean_abs"), "feature"))
