"""Building blocks that keep the other operators safe on large or skewed data.

* ``lookup_join``      size-checked broadcast of a lookup table
* ``running_totals``   exact prefix sums without a single-partition step
* ``hash_unit``        repeatable uniform number per row, stable under retries
* ``hash_sample``      exact-size sample in hash order
* ``per_column``       several statistics of many columns in one aggregate
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.session import materialize

BROADCAST_ROWS = 50_000


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when the table holds at most ``max_rows`` rows; pass a written table, an aggregate would run for it."""
    return table.limit(max_rows + 1).count() <= max_rows


def lookup_join(df: DataFrame, table: DataFrame, on: str | Sequence[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``df`` to a lookup table that has one row per key.

    The table is written once and its rows are counted there. It is broadcast within
    the limit, so a hot key of ``df`` costs no shuffle; a larger table is joined by
    shuffle, where adaptive execution splits skewed partitions.
    """
    table = materialize(table, "lookup")
    if fits_broadcast(table, max_rows):
        table = F.broadcast(table)
    return df.join(table, on, how)


def row_value(row: DataFrame) -> Column:
    """All columns of a one-row aggregate as a struct literal (scalar subquery)."""
    return row.select(F.struct("*").alias("_row")).scalar()


def bucket_side(spark: SparkSession) -> int:
    """Side length m of the m*m range buckets used by :func:`running_totals`.

    About one bucket per shuffle partition, up to 4,096 buckets: more would only
    make the list of cuts longer.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(64, max(2, math.ceil(math.sqrt(parts))))


def running_totals(df: DataFrame, order_col: str, totals: Sequence[str], by: Sequence[str] = (),
                   side: int | None = None) -> DataFrame:
    """Inclusive running sums of ``totals`` in ascending ``order_col`` order, per ``by`` group.

    ``df`` holds one row per (by, order_col). Adds ``cum_<c>`` and ``all_<c>``
    (the group total) for each c in ``totals``.

    The order column is cut into range buckets at approximate quantiles of its
    distinct values. Sums run inside each (group, bucket) window and start from
    the sum of the buckets before it, which comes from a table of groups x buckets
    rows. No window ever holds a whole group, whatever its size, and the result
    does not depend on where the cuts fall.
    """
    side = side or bucket_side(df.sparkSession)
    n_cuts = side * side
    probs = [i / (n_cuts + 1) for i in range(1, n_cuts + 1)]
    # The subquery reads every total so that its exchange equals the main plan's and is reused.
    stats = df.agg(F.percentile_approx(order_col, probs, 20 * n_cuts).alias("cuts"),
                   *[F.sum(c).alias(f"s{i}") for i, c in enumerate(totals)])
    cuts = F.col("_stats.cuts")
    value = F.col(order_col)
    # Two-level search: whole runs of `side` cuts first, then the cuts of one run.
    run_ends = F.transform(F.sequence(F.lit(side), F.lit(n_cuts), F.lit(side)), lambda i: F.get(cuts, i - 1))
    coarse = F.size(F.filter(run_ends, lambda c: c < value))
    fine = F.size(F.filter(F.slice(cuts, F.col("_coarse") * side + 1, F.lit(side)), lambda c: c < value))
    cut = (df.withColumn("_stats", row_value(stats))
             .withColumn("_coarse", coarse)
             .withColumn("_bucket", F.col("_coarse") * side + fine)
             .drop("_stats", "_coarse"))

    per_bucket = cut.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in totals])
    group = W.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in totals],
        *[F.sum(f"_t_{c}").over(group).alias(f"all_{c}") for c in totals])

    inside = W.partitionBy(*by, "_bucket").orderBy(order_col).rowsBetween(W.unboundedPreceding, W.currentRow)
    keys = [*by, "_bucket"]
    left = cut.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in totals])
    condition = [left[k].eqNullSafe(offsets[k]) for k in keys]
    joined = left.join(offsets, condition, "inner").select(
        *[left[c] for c in df.columns],
        *[(left[f"_in_{c}"] + offsets[f"_before_{c}"]).alias(f"cum_{c}") for c in totals],
        *[offsets[f"all_{c}"] for c in totals])
    return joined


def level_code(value: Column, levels: Sequence[str]) -> Column:
    """Place of a text among its known levels, from 1 on; 0 for null, an error for any other text."""
    code = F.array_position(F.array(*map(F.lit, levels)), value)
    return F.when(value.isNull(), 0).when(code > 0, code).otherwise(F.raise_error(F.concat(F.lit("unknown level "), value)))


def level_of(code: Column, levels: Sequence[str]) -> Column:
    """The level of a code of :func:`level_code`."""
    return F.get(F.array(*map(F.lit, levels)), (code - 1).cast("int"))


def latest_level(value: Column, order: Column, levels: Sequence[str]) -> Column:
    """Aggregate: the level of the row with the highest order key, as ``max_by``.

    Order and level code are packed into one long, so that it is a plain maximum in a hash
    aggregate; a maximum over text would sort every row. The order key is whole, below 2**55.
    """
    packed = F.max(F.shiftleft(order.cast("long"), 8).bitwiseOR(level_code(value, levels).cast("long")))
    return level_of(packed.bitwiseAND(255), levels)


def least_level(value: Column, levels: Sequence[str]) -> Column:
    """Aggregate: the first of the sorted levels that occurs, as ``min``."""
    return level_of(F.min(F.when(value.isNotNull(), level_code(value, levels))), levels)


def hash_long(*key: str | Column, seed: int | str = 42) -> Column:
    """52-bit hash of the key and the seed, the same on every run and engine.

    Draws for different purposes take different seeds (``"sample:42"``): a split of a
    sample by the hash that drew it would leave one side empty.
    """
    text = F.concat_ws(":", *key, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def hash_unit(*key: str | Column, seed: int | str = 42) -> Column:
    """Uniform number in [0, 1) from :func:`hash_long`.

    Unlike ``rand`` the value belongs to the row, not to its place in a
    partition, so a task that is run again draws the same number.
    """
    return hash_long(*key, seed=seed) / F.lit(float(1 << 52))


def hash_sample(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest key hash: an exact-size, repeatable random sample.

    When the frame is much larger than n, rows that cannot be among the n smallest
    (six standard deviations and more above the n-th expected hash) are dropped
    before the top-n step; if fewer than n survive, all rows take part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    h = hash_long(*keys, seed=f"sample:{seed}")  # not the hash that splits and folds use
    total = df.count()
    if total <= n:
        return df
    ranked = df.withColumn("_h", h)
    limit = (n + 6 * math.sqrt(n) + 20) / total
    if limit < 0.5:
        near = ranked.where(F.col("_h") < int(limit * (1 << 52)))
        if not near.limit(n).count() < n:
            ranked = near
    return ranked.orderBy("_h", *keys).limit(n).drop("_h")


def per_column(df: DataFrame, cols: Sequence[str], stats: dict[str, Callable[[Column], Column]],
               label: str = "column") -> DataFrame:
    """One row per column, one column per statistic, from a single aggregate of ``df``."""
    row = df.agg(*[F.struct(*[fn(F.col(f"`{c}`")).alias(name) for name, fn in stats.items()]).alias(f"_{i}")
                   for i, c in enumerate(cols)])
    lines = [F.struct(F.lit(c).alias(label), *[F.col(f"_{i}.{name}").alias(name) for name in stats])
             for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*lines)))


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), dtype: str = "double",
                label: str = "column") -> DataFrame:
    """(keep..., column, value) with one row per cell, values cast to one type."""
    typed = df.select(*keep, *[F.col(f"`{c}`").cast(dtype).alias(c) for c in cols])
    return typed.unpivot(list(keep), list(cols), label, "value")
