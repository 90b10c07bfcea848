"""Cluster numbers that keep their meaning, mergeable sketches, latest values by hash aggregation."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patrona import scale
from patrona.catalogue.registry import QUERIES, load_catalogue
from patrona.ml import identity
from patrona.operators import sketches
from patrona.plans import scoring
from patrona.sources.tables import Tables
from conftest import SF_DIR


def test_assignment_is_the_best_one():
    rng = random.Random(1)
    for rows, columns in ((1, 1), (3, 3), (4, 6), (6, 6)):
        for _ in range(20):
            weights = [[rng.randrange(20) for _ in range(columns)] for _ in range(rows)]
            found = identity.assignment(weights)
            best = max(sum(weights[i][c] for i, c in enumerate(p)) for p in itertools.permutations(range(columns), rows))
            assert len(set(found)) == rows and sum(weights[i][c] for i, c in enumerate(found)) == best
    assert identity.assignment([]) == []
    with pytest.raises(ValueError):
        identity.assignment([[1], [2]])


def test_matched_clusters_keep_their_numbers(spark):
    """A new fit with other numbers and one cluster more; the largest overlap decides, not the first one."""
    former = [0] * 50 + [1] * 40 + [2] * 30
    latter = [2] * 45 + [0] * 5 + [0] * 30 + [3] * 10 + [1] * 30
    both = spark.createDataFrame(list(zip(former, latter)), "former int, latter int")
    assert identity.matched_numbers(both, "former", "latter") == {2: 0, 0: 1, 1: 2, 3: 3}
    got = both.withColumn("again", identity.matched_clusters(both, "former", "latter")).groupBy("latter").agg(
        F.min("again"), F.max("again")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {2: (0, 0), 0: (1, 1), 1: (2, 2), 3: (3, 3)}


def test_another_seed_leaves_names_unchanged(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        level = i % 5
        rows.append((i, 300.0 - 60 * level + rng.normal(), 10.0 * level + rng.normal(), 500.0 * level + rng.normal(),
                     12.0 * level + rng.normal()))
    df = spark.createDataFrame(rows, "customer_id long, recency double, frequency double, monetary double, tenure double")
    names = []
    for seed in (1, 2):
        model = scoring.fit_segments(df, scoring.SEGMENT_FIELDS, scoring.SEGMENT_DIRECTION, seed=seed)
        names.append({r["customer_id"]: (r["segment_id"], r["segment_name"]) for r in scoring.score_segments(df, model).collect()})
    assert names[0] == names[1]
    # The level of the generator is the segment, the highest first.
    assert {names[0][i][0] for i in range(4, 200, 5)} == {0} and {names[0][i][0] for i in range(0, 200, 5)} == {4}
    assert names[0][4][1] == "Champions"
    model.write().overwrite().save(str(tmp_path / "segments"))
    again = type(model).load(str(tmp_path / "segments"))
    assert {r["customer_id"]: r["segment_id"] for r in scoring.score_segments(df, again).collect()} == {
        k: v[0] for k, v in names[0].items()}


def test_sketch_states_are_merged(spark):
    rng = np.random.default_rng(5)
    values = rng.exponential(5, 30_000).round(3)
    df = spark.createDataFrame([(i % 7, float(v), f"c{i % 900}", None) for i, v in enumerate(values)],
                               "day int, v double, c string, e double")
    states = sketches.distinct_states(df, ["v", "c", "e"], by=["day"])
    assert states.count() == 14  # a column without any value has no state
    found = {r["column"]: r for r in sketches.merged_distinct(states).collect()}
    assert abs(found["c"]["n_distinct"] - 900) <= 30 and found["v"]["n_rows"] == 30_000
    assert abs(found["v"]["n_distinct"] - len(np.unique(values))) <= 0.033 * len(np.unique(values))
    # One pass over all rows gives the same registers as merged parts.
    whole = {r["column"]: r["n_distinct"] for r in sketches.merged_distinct(sketches.distinct_states(df, ["v", "c"])).collect()}
    assert whole == {c: found[c]["n_distinct"] for c in whole}
    quantiles = sketches.merged_quantiles(sketches.quantile_states(df, ["v"], by=["day"]), [0.1, 0.5, 0.99]).collect()
    for r in quantiles:
        assert abs((values <= r["quantile"]).mean() - r["probability"]) < 0.02 and r["n_rows"] == 30_000


def test_latest_level(spark):
    data = [(1, 5, "b"), (1, 9, "a"), (1, 7, "c"), (2, 1, None), (2, 0, "a"), (3, None, "b")]
    df = spark.createDataFrame(data, "k int, o long, v string")
    levels = ["a", "b", "c"]
    out = df.groupBy("k").agg(scale.latest_level(F.col("v"), F.col("o"), levels).alias("last"),
                              scale.least_level(F.col("v"), levels).alias("first"))
    assert sorted(map(tuple, out.collect())) == [(1, "a", "a"), (2, None, "a"), (3, None, "b")]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="unknown level"):
        df.groupBy("k").agg(scale.latest_level(F.col("v"), F.col("o"), ["a", "b"])).collect()


def test_base_view_needs_no_sort_aggregate(spark):
    plan = Tables(spark, SF_DIR).base()._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    load_catalogue()
    plan = QUERIES["a21_satisfaction_by_internet"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
