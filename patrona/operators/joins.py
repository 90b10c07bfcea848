"""Joins: fact assembly, shared columns, frequency lookup, consecutive periods, label dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.scale import BROADCAST_ROWS, fits_broadcast
from patrona.session import materialize


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all shared column names."""
    shared = [c for c in a.columns if c.lower() in {d.lower() for d in b.columns}]
    if not shared:
        raise ValueError("the frames share no column")
    return a.join(b, shared, how)


def attach(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Left join of model output by key, never by row number."""
    return df.join(scores, key, "left")


def frequency_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_freqenc", null_safe: bool = False,
                     max_rows: int = BROADCAST_ROWS, hot: int = 1000) -> DataFrame:
    """Share of rows that hold the row's value, per column.

    A table of at most ``max_rows`` values is broadcast after its size is checked.
    A larger one is split: values that make up at least 1/``hot`` of the rows are
    at most ``hot`` values and are broadcast; all others are joined by shuffle,
    where no value is hot. Rows already answered by the broadcast side spread
    over the shuffle by the hash of their other columns.

    A null value gets null, or its own share with ``null_safe``.
    """
    for c in columns:
        counts = df.groupBy(c).agg(F.count("*").alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        table = counts.select(F.col(c).alias("_value"), (F.col("_n") / total).alias("_share"))
        if not null_safe:
            table = table.where(F.col("_value").isNotNull())
        table = materialize(table, "frequencies")
        out = f"{c}{suffix}"
        if fits_broadcast(table, max_rows):
            same = df[c].eqNullSafe(F.col("_value")) if null_safe else df[c] == F.col("_value")
            df = df.join(F.broadcast(table), same, "left").select(
                *[df[d] for d in df.columns], F.col("_share").alias(out))
            continue
        names = df.columns
        frequent = table.where(F.col("_share") >= 1.0 / hot)
        same = F.col(c).eqNullSafe(F.col("_value")) if null_safe else F.col(c) == F.col("_value")
        partly = (df.join(F.broadcast(frequent), same, "left").drop("_value")
                  .withColumnRenamed("_share", "_hot_share"))
        done = F.col("_hot_share").isNotNull() | F.col(c).isNull()
        partly = partly.withColumns({
            "_key": F.when(~done, F.col(c)),
            "_salt": F.when(done, F.pmod(F.xxhash64(*names), F.lit(1 << 20))).otherwise(F.lit(-1)),
        })
        rare = table.where((F.col("_share") < 1.0 / hot) & F.col("_value").isNotNull()).select(
            F.col("_value").alias("_key"), F.lit(-1).cast("bigint").alias("_salt"), F.col("_share"))
        joined = partly.join(rare, ["_key", "_salt"], "left")
        df = joined.select(*names, F.coalesce("_hot_share", "_share").alias(out))
        if null_safe:
            none = table.where(F.col("_value").isNull()).agg(F.max("_share")).scalar()
            df = df.withColumn(out, F.when(F.col(c).isNull(), none).otherwise(F.col(out)))
    return df


def consecutive_periods(df: DataFrame, key: str, period: str, label: str) -> DataFrame:
    """(key, period_1, period_2, label_1, label_2) for keys seen in two neighbouring snapshots.

    Neighbours are snapshots that follow each other among the periods present in
    the data. ``df`` has one row per (key, period), so a key's window is no longer
    than the number of periods and no self-join is needed. The list of snapshots is
    checked to be small before it is ordered in one window and broadcast.
    """
    periods = df.select(F.col(period).alias("period_1")).distinct()
    periods = materialize(periods, "periods")
    if not fits_broadcast(periods):
        raise ValueError(f"{period} has more than {BROADCAST_ROWS} values: use snapshots such as months")
    following = periods.withColumn("period_2", F.lead("period_1").over(W.orderBy("period_1")))
    order = W.partitionBy(key).orderBy(period)
    pairs = df.select(F.col(key), F.col(period).alias("period_1"), F.col(label).alias("label_1"),
                      F.lead(period).over(order).alias("_next"), F.lead(label).over(order).alias("label_2"))
    return (pairs.where(F.col("_next").isNotNull())
            .join(F.broadcast(following), "period_1")
            .where(F.col("_next") == F.col("period_2"))
            .select(key, "period_1", "period_2", "label_1", "label_2"))


def map_label(column: str | Column, labels: Mapping, default=None) -> Column:
    """Value from a small dictionary, ``default`` for unknown keys."""
    col = F.col(column) if isinstance(column, str) else column
    entries = [F.lit(x) for pair in labels.items() for x in pair]
    found = F.element_at(F.create_map(*entries), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both snapshots."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def require_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    """True when all columns exist."""
    return set(columns) <= set(df.columns)
