"""Skew, ties and block bounds of the shared building blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from patrona import scale
from patrona.ml import oversampling, prep
from patrona.operators.distribution import box_stats, exact_quantiles, histogram
from patrona.operators.joins import frequency_encode


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("side", [2, 3, 7])
def test_running_totals_equal_plain_sums(spark, side):
    rng = np.random.default_rng(1)
    values = np.unique(np.round(rng.exponential(5, 800), 3))
    data = [(g, float(v), int(rng.integers(0, 9))) for g in ("a", "b", None) for v in values]
    out = scale.running_totals(spark.createDataFrame(data, "g string, v double, n long"), "v", ["n"], by=["g"], side=side)
    got = {(r["g"], r["v"]): (r["cum_n"], r["all_n"]) for r in out.collect()}
    for g in ("a", "b", None):
        mine = sorted((v, n) for h, v, n in data if h == g)
        total, cum = sum(n for _v, n in mine), 0
        for v, n in mine:
            cum += n
            assert got[(g, v)] == (cum, total)


def test_running_totals_of_empty_frame(spark):
    empty = spark.createDataFrame([], "v double, n long")
    assert scale.running_totals(empty, "v", ["n"]).collect() == []


def test_exact_quantiles_with_hot_value(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([np.full(400, 3.25), rng.normal(0, 100, 801)])
    df = spark.createDataFrame([("x", float(v)) for v in values] + [("y", 1.0), ("y", None)], "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    out = {r["g"]: r for r in exact_quantiles(df, ["v"], probs, by=["g"]).collect()}
    want = np.quantile(values, probs)
    assert np.allclose([out["x"][f"q{i}"] for i in range(len(probs))], want)
    assert out["y"]["n"] == 1 and out["y"]["q3"] == 1.0


def test_histogram_constant_column_and_maximum(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (10.0, 5.0), (None, None)], "v double, c double")
    out = histogram(df, ["v", "c"], 3)
    v = [r for r in out.collect() if r["column"] == "v"]
    assert [r["count"] for r in sorted(v, key=lambda r: r["bin"])] == [2, 0, 1]
    c = [r for r in out.collect() if r["column"] == "c"]
    assert [(r["bin"], r["low"], r["high"], r["count"]) for r in c] == [(0, 5.0, 5.0, 3)]


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 7.0), (None, 1.0)], "g string, v double")
    out = {r["g"]: r for r in box_stats(df, "v", by="g").collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"]["whisker_low"], out["a"]["whisker_high"], out["a"]["n_outliers"]) == (1.0, 4.0, 1)


def test_frequency_encode_paths_agree(spark):
    values = ["hot"] * 300 + [f"v{i % 190}" for i in range(580)] + [None] * 20
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    want = {v: values.count(v) / len(values) for v in set(values)}
    for null_safe in (False, True):
        small = frequency_encode(df, ["v"], null_safe=null_safe)
        split = frequency_encode(df, ["v"], null_safe=null_safe, max_rows=10, hot=20)
        assert rows(small) == rows(split)
        for r in split.collect():
            expected = want[r["v"]] if r["v"] is not None or null_safe else None
            assert r["v_freqenc"] == pytest.approx(expected) if expected is not None else r["v_freqenc"] is None


def test_hash_sample_is_exact_and_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    one, two = scale.hash_sample(df, "k", 500), scale.hash_sample(df.repartition(7), "k", 500)
    assert rows(one) == rows(two) and one.count() == 500
    ranked = df.orderBy(scale.hash_long("k", seed="sample:42"), "k").limit(500)
    assert rows(one) == rows(ranked)
    assert scale.hash_sample(df.limit(10), "k", 500).count() == 10


def test_hash_unit_is_uniform(spark):
    u = [r[0] for r in spark.range(20000).select(scale.hash_unit("id")).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.01


def _imbalanced(spark, n_minor=400):
    rng = np.random.default_rng(3)
    data = [(i, 0.0, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(1000)]
    # A third of the minority are copies of one row.
    for i in range(n_minor):
        point = [5.0, 5.0, 5.0] if i % 3 == 0 else [float(x) for x in rng.normal(5, 1, 3)]
        data.append((1000 + i, 1.0, point))
    df = spark.createDataFrame(data, "id long, label double, v array<double>")
    return df.select("id", "label", array_to_vector("v").alias("features"))


def test_smote_counts_and_range(spark):
    df = _imbalanced(spark)
    made = oversampling.smote(df, "id")
    out = made.select("synthetic_key", "label", vector_to_array("features").alias("v")).collect()
    assert len(out) == 600 and len({r["synthetic_key"] for r in out}) == 600
    assert {r["label"] for r in out} == {1.0}
    minority = np.array([r["v"] for r in df.where("label = 1").select(vector_to_array("features").alias("v")).collect()])
    points = np.array([r["v"] for r in out])
    assert (points >= minority.min(axis=0) - 1e-9).all() and (points <= minority.max(axis=0) + 1e-9).all()
    again = oversampling.smote(df.repartition(5), "id")
    assert rows(again.select("synthetic_key")) == rows(made.select("synthetic_key"))
    balanced = {r[0]: r[1] for r in oversampling.oversample(df, "id").groupBy("label").count().collect()}
    assert balanced == {0.0: 1000, 1.0: 1000}


def test_smote_neighbours_are_the_nearest(spark):
    df = _imbalanced(spark, 60)
    minority = np.array([r["v"] for r in df.where("label = 1").select(vector_to_array("features").alias("v")).collect()])
    near = np.argsort(((minority[:, None] - minority[None]) ** 2).sum(-1) + np.eye(len(minority)) * 1e9, axis=1)[:, :5]
    made = oversampling.smote(df, "id").select(vector_to_array("features").alias("v")).collect()
    for r in made[::25]:
        p = np.array(r["v"])
        gap = min(np.linalg.norm(np.cross(minority[j] - minority[i], p - minority[i]))
                  / max(np.linalg.norm(minority[j] - minority[i]), 1e-12)
                  for i in range(len(minority)) for j in near[i])
        assert gap < 1e-6


def test_nearest_rows_of_a_large_class(spark):
    """Recall of the true five nearest rows in a class of 20,000 rows of eight dimensions."""
    points = np.random.default_rng(8).normal(0, 300.0, (20_000, 8))
    frame = pd.DataFrame({"id": [str(i) for i in range(len(points))], "label": 1.0, "values": points.tolist()})
    found = oversampling.nearest_rows(spark.createDataFrame(frame, "id string, label double, values array<double>"), 5)
    got = {int(r["id"]): {int(m["id"]) for m in r["near"]} for r in found.collect()}
    assert len(got) == 20_000 and all(len(v) == 5 and i not in v for i, v in got.items())
    hits = 0
    for i in range(0, 20_000, 100):
        distance = ((points - points[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        hits += len(got[i] & set(np.argsort(distance)[:5].tolist()))
    assert hits / 1000 >= 0.9, hits


def test_smote_of_a_tiny_class(spark):
    """Two rows and one row that need many copies: made in chunks, all distinct or equal to the single row."""
    data = [(i, 0.0, [0.0]) for i in range(1500)] + [(2000, 1.0, [1.0]), (2001, 1.0, [2.0]), (3000, 2.0, [9.0])]
    df = spark.createDataFrame(data, "id long, label double, v array<double>").select(
        "id", "label", array_to_vector("v").alias("features"))
    made = oversampling.smote(df, "id").select("synthetic_key", "label", vector_to_array("features")[0].alias("x")).collect()
    pair, single = [r for r in made if r["label"] == 1.0], [r for r in made if r["label"] == 2.0]
    assert len(pair) == 1498 and len(single) == 1499 and len({r["synthetic_key"] for r in made}) == 2997
    assert all(1.0 <= r["x"] <= 2.0 for r in pair) and len({r["x"] for r in pair}) == 1498
    assert {r["x"] for r in single} == {9.0}


def test_smote_of_balanced_classes_is_empty(spark):
    df = spark.createDataFrame([(1, 0.0, [1.0]), (2, 1.0, [2.0])], "id long, label double, v array<double>").select(
        "id", "label", array_to_vector("v").alias("features"))
    assert oversampling.smote(df, "id").count() == 0


def test_hot_part_is_split_by_adaptive_execution(spark):
    """A join whose left side has one key for most rows is divided among tasks, with the same result."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("part"), (F.col("id") % 977).alias("o"))
        parts = spark.range(5000).select(F.col("id").alias("part"), (F.col("id") % 6).alias("kind"))
        out = lines.join(parts, "part", "left").groupBy("o").agg(F.count_if(F.col("kind") == 1).alias("n"))
        total = out.agg(F.sum("n")).first()[0]
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert total == lines.where(F.col("part") % 6 == 1).count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sample_and_split_use_different_hashes(spark):
    from patrona.ml import prep
    from patrona.operators import quality
    rows = spark.range(20_000)
    for sample in (quality.bernoulli_sample(rows, 0.1, "id"), scale.hash_sample(rows, "id", 2_000)):
        train, test = prep.random_split(sample, "id")
        share = train.count() / sample.count()
        assert 0.77 < share < 0.83 and train.count() + test.count() == sample.count()


def test_stratified_parts_keep_rows_without_label(spark):
    from pyspark.sql import functions as F
    from patrona.ml import prep
    rows = spark.range(2_000).withColumn("label", F.when(F.col("id") % 10 > 0, F.col("id") % 2))
    train, test = prep.stratified_split(rows, "id", "label")
    assert train.count() == 1_600 and test.count() == 400
    assert train.where("label is null").count() == 160
    folds = prep.stratified_folds(rows, "id", "label", k=5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4] and {r["count"] for r in folds} == {400}


def test_lookup_join_runs_the_table_once(spark):
    from pyspark.sql import functions as F
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(1_000).withColumn("k", F.col("id") % 7)
    table = rows.mapInPandas(count, rows.schema).groupBy("k").agg(F.count("*").alias("n"))
    assert scale.lookup_join(rows, table, "k").count() == 1_000 and seen.value == 1_000
    beyond = scale.lookup_join(rows, rows.groupBy("k").agg(F.count("*").alias("n")), "k", max_rows=3)
    assert beyond.count() == 1_000 and beyond.where("n is null").count() == 0


def test_donors_are_a_permutation(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    from patrona.ml.explain import with_donor
    for n in (2, 50, 12_000):
        rows = spark.range(n).withColumn("features", array_to_vector(F.array(F.col("id").cast("double"))))
        pairs = [(r["id"], int(r["_donor"][0])) for r in with_donor(rows, "id").select("id", "_donor").collect()]
        assert sorted(d for _, d in pairs) == list(range(n)) and all(a != b for a, b in pairs)


def test_segments_keep_rows_with_missing_fields(spark):
    from patrona.plans import scoring
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else float(i % 5), float(i)) for i in range(200)],
                                 "customer_id long, x double, y double")
    model = scoring.fit_segments(rows, ["x", "y"], k=3)
    assert scoring.score_segments(rows, model).count() == 200
