"""Oversampling between near rows, by one rule at every size of a class.

Every row is placed along several orders. An order sorts by the interleaved bits of a
row's places along a few random directions, the places being quantiles of the class, so
that scales and outliers do not matter; each order has directions of its own. Ranks
along an order are cut into runs of ``RUN`` rows whose edges lie elsewhere in each
order. In every run all distances are computed, and the nearest rows of all orders are
ranked again by their exact distance. A second round compares each row with the
neighbours of its neighbours. A class of one run has exact neighbours; beyond that the
recall is measured by a test.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.scale import hash_long, hash_unit, running_totals
from patrona.session import materialize

ORDERS, DIRECTIONS, BITS = 6, 4, 6
#: Rows of an order that are compared with one another.
RUN = 1024
COPIES_PER_CHUNK = 256
#: Rows shuffled per group of orders when neighbours are exchanged.
_NEAR = "array<struct<d:double,id:string>>"


def _directions(size: int, seed: int) -> np.ndarray:
    rng = random.Random(seed)
    return np.array([[rng.gauss(0, 1) for _ in range(size)] for _ in range(ORDERS * DIRECTIONS)])


def _projected(df: DataFrame, size: int, seed: int) -> DataFrame:
    """Adds ``at``: the place of the row's values along every direction of every order."""
    weights = _directions(size, seed)
    label = next(f for f in df.schema.fields if f.name == "label").dataType.simpleString()

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            points = np.stack(pdf["values"].to_numpy()) if len(pdf) else np.zeros((0, size))
            yield pdf.assign(at=list(points @ weights.T))
    return df.mapInPandas(project, f"id string, label {label}, values array<double>, at array<double>")


def _order_key(cuts: Column, at: Column, order: Column) -> Column:
    """Interleaved bits of the places 0..2**BITS-1 of a row along the directions of its order."""
    key = F.lit(0).cast("long")
    for d in range(DIRECTIONS):
        slot = order * DIRECTIONS + d
        value = F.get(at, slot)
        place = F.aggregate(F.get(cuts, slot), F.lit(0), lambda n, c: n + (c < value).cast("int"))
        for b in range(BITS):
            bit = F.shiftright(place, b).bitwiseAND(1).cast("long")
            key = key + F.shiftleft(bit, b * DIRECTIONS + d)
    return key


def _ranked(rows: DataFrame, seed: int) -> DataFrame:
    """(id, label, values, order, rank, n): each row once per order, ranked in its class from 1 on."""
    slots = ORDERS * DIRECTIONS
    probs = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    cuts = rows.groupBy("label").agg(F.array(*[F.percentile_approx(F.get("at", F.lit(i)), probs, 1000)
                                               for i in range(slots)]).alias("cuts"))
    spread = (rows.join(F.broadcast(cuts), "label")  # one row per class, a thousand at most
              .withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))))
    tie = F.shiftright(hash_long("id", "order", seed=seed), 12)
    keyed = spread.select("id", "label", "values", "order", F.lit(1).cast("long").alias("n"), (
        F.shiftleft(_order_key(F.col("cuts"), F.col("at"), F.col("order")), 40) + tie).alias("_key"))
    return running_totals(materialize(keyed, "smote-orders"), "_key", ["n"], by=["label", "order"]).select(
        "id", "label", "values", "order", F.col("cum_n").alias("rank"), F.col("all_n").alias("n"))


def _nearest_in_run(k: int):
    """Function giving the k nearest other rows of each row of a run; a closure, so workers need not have this package."""
    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].to_numpy()
        points = np.stack(pdf["values"].to_numpy())
        wanted = min(k, len(points) - 1)
        squares = (points ** 2).sum(axis=1)
        near: list = [[] for _ in range(len(points))]
        for start in range(0, len(points) if wanted > 0 else 0, 512):
            rows = np.arange(start, min(start + 512, len(points)))
            distance = squares[rows, None] + squares[None, :] - 2 * points[rows] @ points.T
            distance[np.arange(len(rows)), rows] = np.inf
            picked = np.argpartition(distance, wanted - 1, axis=1)[:, :wanted]
            for row, own in zip(rows, picked):
                exact = ((points[own] - points[row]) ** 2).sum(axis=1)
                near[row] = [{"d": float(d), "id": i} for d, i in sorted(zip(exact, ids[own]))]
        return pd.DataFrame({"id": ids, "label": pdf["label"], "near": near})
    return nearest


def _closest(candidates: Column, k: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(candidates)), 1, k)


def nearest_rows(rows: DataFrame, k: int, seed: int = 42, size: int | None = None) -> DataFrame:
    """(id, label, rank, n, near): rows of (id, label, values) with their k nearest rows of the same class.

    ``near`` has the squared distances and ids, nearest first; ``rank`` is the place of the
    row in the first order of its class and ``n`` the size of the class.
    """
    size = size or len(rows.select("values").first()[0])
    rows = materialize(_projected(rows, size, seed), "smote-rows")
    label = rows.schema["label"].dataType.simpleString()
    ranked = materialize(_ranked(rows, seed), "smote-ranks")
    # The first order starts its runs at rank 1, so a class of one run is compared as a whole.
    run = F.floor((F.col("rank") - 1 + F.floor(F.col("order") * RUN / ORDERS)) / RUN)
    found = (ranked.groupBy("label", "order", run.alias("run"))
             .applyInPandas(_nearest_in_run(k), f"id string, label {label}, near {_NEAR}"))
    near = materialize(found.groupBy("id", "label").agg(
        _closest(F.flatten(F.collect_list("near")), k).alias("near")), "smote-near")  # at most k an order
    near = _second_round(near, rows, k)
    first = ranked.where("order = 0").select("id", "label", "rank", "n")
    return first.join(near, ["id", "label"], "left").withColumn(
        "near", F.coalesce("near", F.array().cast(_NEAR)))  # a class of one row has none


def _second_round(near: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Each row compared with the neighbours of its neighbours: at most k * k new pairs a row."""
    links = near.select("id", "label", F.explode("near").alias("m")).select("id", "label", F.col("m.id").alias("other"))
    beyond = links.join(near.select(F.col("id").alias("other"), "label", "near"), ["other", "label"]).select(
        "id", "label", F.explode("near").alias("m")).select("id", "label", F.col("m.id").alias("other"))
    fresh = (beyond.where(F.col("id") != F.col("other")).distinct()
             .join(links, ["id", "label", "other"], "left_anti"))
    own = rows.select("id", "label", F.col("values").alias("x"))
    theirs = rows.select(F.col("id").alias("other"), "label", F.col("values").alias("y"))
    gap = F.aggregate(F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    measured = (fresh.join(own, ["id", "label"]).join(theirs, ["other", "label"])
                .select("id", "label", F.struct(gap.alias("d"), F.col("other").alias("id")).alias("m")))
    every = measured.unionByName(near.select("id", "label", F.explode("near").alias("m")))
    place = F.row_number().over(W.partitionBy("id", "label").orderBy("m.d", "m.id"))
    return (every.withColumn("_place", place).where(F.col("_place") <= k).groupBy("id", "label")
            .agg(F.array_sort(F.collect_list("m")).alias("near")))


def smote(df: DataFrame, key: str, label: str = "label", features: str = "features", k: int = 5,
          seed: int = 42) -> DataFrame:
    """(synthetic_key, label, features): new rows that lift every class to the size of the largest.

    Each new row lies between a row of its class and one of its k nearest rows. A row's
    number of new rows follows from its rank in its class, so the total is exact; all
    classes are handled in the same jobs. The key is unique; rows without a label take no part. New rows of a class of very
    few rows are made in chunks, spread over tasks.
    """
    counts = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().limit(1001).collect()}
    if len(counts) > 1000:
        raise ValueError("the label has more than 1000 classes")
    largest = max(counts.values(), default=0)
    short = {value: largest - n for value, n in counts.items() if n < largest}
    if not short:
        return df.select(F.col(key).cast("string").alias("synthetic_key"), label, features).limit(0)
    need = F.lit(0).cast("long")
    for value, missing in short.items():
        need = F.when(F.col("label").eqNullSafe(F.lit(value)), F.lit(missing).cast("long")).otherwise(need)
    size = len(df.select(features).first()[0])
    rows = (df.select(F.col(key).cast("string").alias("id"), F.col(label).alias("label"),
                      vector_to_array(features).alias("values")).withColumn("_need", need)
            .where("_need > 0").drop("_need"))
    found = materialize(nearest_rows(rows, k, seed, size), "smote-found")
    rank = F.col("rank")
    copies = F.floor(rank * need / F.col("n")) - F.floor((rank - 1) * need / F.col("n"))
    given = found.withColumn("copies", copies.cast("long")).where("copies > 0")
    last = F.floor((F.col("copies") - 1) / COPIES_PER_CHUNK)
    chunked = given.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    if any(missing > counts[value] * COPIES_PER_CHUNK for value, missing in short.items()):
        chunked = chunked.repartition("id", "chunk")
    begin = F.col("chunk") * COPIES_PER_CHUNK
    turned = chunked.withColumn("turn", F.explode(F.sequence(
        begin, F.least(begin + COPIES_PER_CHUNK, F.col("copies")) - 1)))
    pick = F.floor(hash_unit("id", "turn", seed=seed + 1) * F.size("near")).cast("int")
    picked = turned.select("id", "label", "turn", F.coalesce(F.get("near", pick)["id"], F.col("id")).alias("other"))
    own = rows.select("id", "label", F.col("values").alias("x"))
    theirs = rows.select(F.col("id").alias("other"), "label", F.col("values").alias("y"))
    u = hash_unit("id", "turn", seed=seed + 2)
    return (picked.join(own, ["id", "label"]).join(theirs, ["other", "label"]).withColumn("_u", u).select(
        F.concat_ws("-", F.lit("synthetic"), F.col("label").cast("string"), "id", "turn").alias("synthetic_key"),
        F.col("label").alias(label),
        array_to_vector(F.zip_with("x", "y", lambda a, b: a + F.col("_u") * (b - a))).alias(features)))


def oversample(df: DataFrame, key: str, label: str = "label", features: str = "features", **options) -> DataFrame:
    """The given rows together with their synthetic rows."""
    own = df.select(F.col(key).cast("string").alias(key), label, features)
    return own.unionByName(smote(df, key, label, features, **options).withColumnRenamed("synthetic_key", key))
