"""Repeatable synthetic customer attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.scale import hash_unit


def synthetic_profiles(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Random attributes for each given key.

    churn is 1 with probability 0.3, cltv exponential with mean 500, segment uniform
    on 0..4, tenure uniform on 1..59, monthly charge normal with mean 70 and
    deviation 20. The numbers come from the key and the seed, so a retried task
    draws them again.
    """
    def u(i):
        return hash_unit(key, seed=seed * 100 + i)
    normal = F.sqrt(-2 * F.ln(1 - u(5))) * F.cos(F.lit(2 * 3.141592653589793) * u(6))
    return keys.select(
        key, (u(1) >= 0.7).cast("int").alias("churn"), (-500 * F.ln(1 - u(2))).alias("cltv"),
        F.floor(u(3) * 5).cast("int").alias("segment"), (1 + F.floor(u(4) * 59)).cast("int").alias("tenure"),
        (70 + 20 * normal).alias("monthly_charges"))
