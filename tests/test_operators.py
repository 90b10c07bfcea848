"""Edge cases of the operators on small frames: nulls, blanks, NaN, ties, bucket ends, zero divisors."""

import math

import pytest
from pyspark.sql import functions as F

from patrona.functions import features, rules
from patrona.ml import prep
from patrona.operators import aggregates, distribution, joins, quality, schema
from patrona.plans import reports, scoring, star
from patrona.sources import files


def one(df):
    return df.collect()[0].asDict()


def column(df, name):
    return [r[name] for r in df.collect()]


def test_names(spark):
    raw = spark.createDataFrame([(1, 2, 3)], [" Customer ID", "Zip-Code (main)", "a{b};=c\n"])
    assert schema.clean_column_names(raw).columns == ["customer_id", "zip_code_main", "abc"]
    assert schema.normalize_names(raw).columns[0] == "Customer_ID"
    with pytest.raises(ValueError):
        schema.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))
    with pytest.raises(ValueError):
        schema.rename_by_position(raw, ["x"])


def test_select_and_drop(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "customer_id long, name string, v double")
    assert schema.select_existing(df, ["v", "zip", "v"]).columns == ["v"]
    assert schema.select_existing(df, ["Customer_ID", "NAME", "V"], match_case=False, at_least=3).columns == [
        "customer_id", "name", "v"]
    with pytest.raises(ValueError):
        schema.select_existing(df, ["zip"], at_least=3)
    assert schema.drop_columns(df, "Customer_ID", "absent").columns == ["name", "v"]
    assert schema.numeric_columns(df, ["customer_id"]) == ["v"] and schema.text_columns(df) == ["name"]
    assert one(schema.candidate_keys(df)) == {"column": "customer_id", "n_distinct": 1, "n_rows": 1, "is_key": True}


def test_blank_counts(spark):
    df = spark.createDataFrame([("", float("nan"), 1), (None, None, None), ("x", 1.0, 2)], "s string, d double, i int")
    assert {r["column"]: r["n_blank"] for r in quality.blank_counts(df).collect()} == {"s": 2, "d": 2, "i": 1}
    assert {r["column"]: r["n_null"] for r in quality.null_counts(df).collect()} == {"s": 1, "d": 1, "i": 1}


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, None), (None, None)], "s string, i int")
    assert one(quality.duplicate_count(df)) == {"n_rows": 5, "n_distinct": 3, "n_duplicates": 2}
    assert one(quality.duplicate_count(df.limit(0))) == {"n_rows": 0, "n_distinct": 0, "n_duplicates": 0}
    assert quality.rows_with_null(df).count() == 3 and quality.drop_null_rows(df).count() == 2
    assert quality.drop_null_rows(df, ["s"]).count() == 3
    filled = quality.impute_constants(spark.createDataFrame([(None, "x")], "offer string, other string"))
    assert one(filled) == {"offer": "No Offer", "other": "x"}


def test_first_copies(spark):
    df = spark.createDataFrame([(3, "t"), (1, "t"), (2, "u")], "id long, text string")
    assert sorted(column(quality.first_copies(df, "text", "id"), "id")) == [1, 2]


def test_value_counts_and_top(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), (None, 3)], "s string, i int")
    got = [(r["column"], r["value"], r["count"]) for r in quality.value_counts(df, ["s", "i"], top=1).collect()]
    assert got == [("i", "1", 2), ("s", "a", 2)]


@pytest.mark.parametrize("months,three,four,group", [
    (0, "<1yr", "0-12 Months", "<1 year"), (11, "<1yr", "0-12 Months", "<1 year"),
    (12, "1-2yr", "12-24 Months", "1-2 years"), (23, "1-2yr", "12-24 Months", "1-2 years"),
    (24, "2+yrs", "24-48 Months", "1-2 years"), (47, "2+yrs", "24-48 Months", "2+ years"),
    (48, "2+yrs", "48+ Months", "2+ years"), (None, "2+yrs", "48+ Months", "2+ years")])
def test_tenure_buckets(spark, months, three, four, group):
    df = spark.createDataFrame([(months,)], "tenure_in_months int")
    got = one(df.select(features.tenure_bucket_3().alias("a"), features.tenure_bucket_4().alias("b"),
                        features.tenure_group().alias("c"), features.tenure_bucket_3(null_label=None).alias("d")))
    assert (got["a"], got["b"], got["c"]) == (three, four, group)
    assert got["d"] == (None if months is None else three)


def test_satisfaction_and_age(spark):
    df = spark.createDataFrame([(2.0, 29), (3.5, 30), (3.6, 50), (None, 51)], "satisfaction_score double, age int")
    assert column(df.select(features.satisfaction_bucket().alias("b")), "b") == ["Low", "Medium", "High", None]
    assert column(df.select(features.age_group().alias("b")), "b") == ["Under 30", "30-50", "30-50", "50+"]


def test_revenue_features(spark):
    df = spark.createDataFrame([(100.0, 0, 50.0), (100.0, None, -1.0), (-1.0, 4, 2.0)],
                               "total_revenue double, tenure_in_months int, total_charges double")
    assert column(df.select(features.revenue_per_month().alias("v")), "v") == [100.0, None, -0.2]
    assert column(df.select(features.revenue_per_month_guarded().alias("v")), "v") == [100.0, 100.0, -0.25]
    assert column(df.select(features.spend_ratio().alias("v")), "v")[2] is None
    assert column(df.select(features.spend_ratio_guarded().alias("v")), "v") == [0.5, -0.01, 2.0]


def test_service_counts(spark):
    df = spark.createDataFrame([(1, "Yes", 1.0), (None, "Fiber optic", 0.0), (0, "No", None)], "a int, b string, c double")
    assert column(df.select(features.service_count(["a", "c"]).alias("n")), "n") == [2, 0, 0]
    # A double 1.0 reads "1.0" as text and is not one of the subscribed values.
    assert column(df.select(features.service_count_text(["a", "b", "c"]).alias("n")), "n") == [2, 1, 0]
    assert column(df.select(features.service_sum(["a", "c"]).alias("n")), "n") == [2.0, None, None]


def test_feedback_features(spark):
    df = spark.createDataFrame([
        ("1", " 34 ", "1,234.5", "4", "2", "3", " LOW", "Gold ", "2"),
        ("2", "x", None, None, "5", None, "other", "iron", None),
        ("3", "50", "0", "1", "1", "2", "high", None, "4")],
        "customer_id string, age string, income string, product_quality string, service_quality string, "
        "purchase_frequency string, feedback_score string, loyalty_level string, satisfaction_score string")
    out = {r["customer_id"]: r for r in features.feedback_features(df).collect()}
    assert out["1"]["income"] == 1234.5 and out["2"]["age"] is None
    assert [out[k]["feedback_score_num"] for k in "123"] == [1, None, 3]
    assert [out[k]["loyalty_level_clean"] for k in "123"] == [3, None, None]
    assert [out[k]["quality_avg"] for k in "123"] == [3.0, None, 1.0]
    assert out["2"]["engagement_score"] == pytest.approx(0.4 * 3.0)
    assert out["2"]["income_log"] == 0.0 and out["1"]["income_log"] == pytest.approx(math.log1p(1234.5))
    assert [out[k]["satisfaction_bucket"] for k in "123"] == ["Low", None, "High"]


def test_churn_rule_score_and_levels(spark):
    df = spark.createDataFrame([(81.0, 11, "Month-to-month"), (80.0, 12, "One year"), (81.0, 11, "One year"),
                                (None, None, None)], "c double, t int, k string")
    scored = df.select(rules.churn_rule_score("c", "t", "k").alias("s")).withColumn(
        "level", rules.risk_level(F.col("s")))
    assert [(round(r["s"], 9), r["level"]) for r in scored.collect()] == [
        (1.0, "High"), (0.0, "Low"), (0.7, "Medium"), (0.0, "Low")]


def test_value_rules(spark):
    df = spark.createDataFrame([(100.0, 5, "Premium"), (10.0, 20, "Standard"), (10.0, 20, "Other")],
                               "c double, t int, s string")
    assert column(df.select(rules.value_rule("c", "t", "s").alias("v")), "v") == [3600.0, 480.0, 400.0]
    bands = spark.createDataFrame([(2000.0,), (2000.1,), (5000.0,), (5000.1,), (6000.0,), (None,)], "v double")
    assert column(bands.select(rules.value_category(F.col("v")).alias("b")), "b")[:4] == [
        "Low Value", "Medium Value", "Medium Value", "High Value"]
    assert column(bands.select(rules.value_band(F.col("v")).alias("b")), "b") == [
        "Low", "Low", "Medium", "Medium", "High", None]


def test_rule_segment_first_match(spark):
    df = spark.createDataFrame([(70001.0, "High"), (70000.0, "High"), (40001.0, "Medium"), (39999.0, "High"),
                                (40000.0, "Low")], "i double, f string")
    assert column(df.select(rules.rule_segment("i", "f").alias("s")), "s") == [
        "Premium Users", "Occasional Users", "Regular Users", "Budget Users", "Occasional Users"]


def test_sentiment(spark):
    df = spark.createDataFrame([("GREAT goodness", 3), ("bad and hateful, good", 3), ("nothing", 3), ("worst", 4),
                                ("love", 1), ("nothing", 2)], "text string, rating int")
    moods = df.select(rules.sentiment("text", "rating").alias("m"))
    assert column(moods, "m") == ["Positive", "Negative", "Neutral", "Positive", "Positive", "Negative"]
    assert column(moods.select(rules.follow_up(F.col("m")).alias("a")), "a")[:3] == [
        "Share success story", "Follow up with customer service", "Monitor for improvements"]


def test_request_checks(spark):
    df = spark.createDataFrame([("1", None, "2.5"), ("2", "abc", "1"), ("3", " 4 ", "")], "id string, a string, b string")
    good, bad = rules.split_bad_numbers(df, ["a", "b"])
    assert [tuple(r) for r in good.collect()] == [("1", 0.0, 2.5)]
    assert sorted((r["id"], r["bad_field"]) for r in bad.collect()) == [("2", "a"), ("3", "b")]
    accepted, rejected = rules.split_required(df, ["a", "b"])
    assert column(accepted, "id") == ["2"]
    assert sorted((r["id"], r["missing_field"]) for r in rejected.collect()) == [("1", "a"), ("3", "b")]
    valid, invalid = rules.split_valid(spark.createDataFrame([(5.0, 17), (0.0, 18), (6.0, 101)], "rating double, age int"))
    assert valid.count() == 0
    assert sorted(column(invalid, "reason")) == ["age", "rating", "rating,age"] or sorted(
        column(invalid, "reason")) == ["age", "age,rating", "rating"]


def test_batch_scoring_returns_every_request(spark):
    df = spark.createDataFrame([(1, "5", "90", "1", "Month-to-month", "Basic"), (2, "x", "90", "1", "One year", "Gold"),
                                (3, None, "20", "", "One year", "Premium")],
                               "request_id int, tenure string, monthly_charges string, total_charges string, "
                               "contract_type string, service_type string")
    churn = {r["request_id"]: r for r in scoring.score_churn(df).collect()}
    assert {k: r["bad_field"] for k, r in churn.items()} == {1: None, 2: "tenure", 3: "total_charges"}
    assert churn[1]["prediction"] == 1 and churn[1]["risk_level"] == "High"
    assert churn[2]["prediction"] is None and churn[2]["risk_level"] is None
    value = {r["request_id"]: (r["cltv"], r["bad_field"]) for r in scoring.score_value(df).collect()}
    assert value == {1: (90.0 * 24, None), 2: (None, "tenure"), 3: (None, "total_charges")}


def test_few_values_are_counted_exactly(spark):
    df = spark.range(1000).select(*[(F.col("id") % n).alias(f"c{n}") for n in (4, 5, 6, 25, 26, 900)])
    assert prep.with_few_values(df, df.columns, 5) == ["c4", "c5"]
    assert prep.split_by_cardinality(df, df.columns, 25) == (["c4", "c5", "c6", "c25"], ["c26", "c900"])
    assert prep.with_few_values(df, [], 5) == [] and prep.with_few_values(df.limit(0), ["c4"], 5) == ["c4"]


def test_rates_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "churn int")
    assert one(reports.churn_rate(empty)) == {"churn_rate_pct": None}


def test_crosstab_and_share(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "y")], "g string, l string")
    assert sorted(tuple(r) for r in aggregates.crosstab(df, "g", "l").where("g is not null").collect()) == [("a", 2, 1)]
    shares = {(r["g"], r["l"]): r["share"] for r in aggregates.crosstab_share(df, "g", "l").collect()}
    assert shares == {("a", "x"): 0.667, ("a", "y"): 0.333, (None, "y"): 1.0}
    with pytest.raises(ValueError):
        aggregates.crosstab(df, "g", "l", max_levels=1)


def test_cluster_profiles(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 3.0, 5.0), (1, 10.0, 5.0), (1, None, 5.0)], "cluster int, v double, c double")
    assert [tuple(r) for r in aggregates.cluster_means(df, "cluster").collect()] == [(0, 2.0, 5.0), (1, 10.0, 5.0)]
    assert column(aggregates.rank_varying_features(df, "cluster", k=1), "feature") == ["v"]
    norm = {(r["cluster"], r["feature"]): r["normalized"] for r in aggregates.normalized_cluster_means(df, "cluster").collect()}
    assert norm == {(0, "v"): 0.0, (1, "v"): 1.0, (0, "c"): None, (1, "c"): None}


def test_describe_all_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", None), ("a", 4.0), (None, 3.0)], "s string, v double")
    out = {r["column"]: r.asDict() for r in distribution.describe_all(df).collect()}
    assert (out["s"]["top"], out["s"]["freq"], out["s"]["unique"], out["s"]["count"]) == ("a", 2, 2, 4)
    assert (out["v"]["count"], out["v"]["median"], out["v"]["p25"]) == (4, 2.5, 1.75)


def test_yes_no_correlation(spark):
    df = spark.createDataFrame([("Yes", 3.0), ("no ", 1.0), (None, 9.0), ("yes", 3.0)], "churn string, v double")
    assert one(distribution.correlation(df.withColumn("y", distribution.yes_no("churn")), "v", "y"))["corr"] == pytest.approx(1)


def test_consecutive_periods(spark):
    df = spark.createDataFrame([(1, "2020-01", "a"), (1, "2020-03", "b"), (2, "2020-01", "a"), (2, "2020-05", "c"),
                                (1, "2020-05", "a")], "id long, period string, label string")
    got = sorted(tuple(r) for r in joins.consecutive_periods(df, "id", "period", "label").collect())
    # 2020-03 follows 2020-01 in the data; customer 2 skipped it.
    assert got == [(1, "2020-01", "2020-03", "a", "b"), (1, "2020-03", "2020-05", "b", "a")]


def test_label_dictionary(spark):
    df = spark.createDataFrame([(0,), (9,), (None,)], "c int")
    assert column(df.select(joins.map_label("c", rules.SEGMENT_NAMES, "Unknown").alias("n")), "n") == [
        "Champions", "Unknown", "Unknown"]
    assert column(df.select(joins.map_label("c", rules.CLUSTER_NAMES).alias("n")), "n")[1] is None


def test_fact_keeps_customers_without_feedback(spark):
    contracts = spark.createDataFrame([(1, 10.0), (2, 20.0)], "customer_id long, monthly_charge double")
    feedback = spark.createDataFrame([(1, 1, 3)], "customer_id long, churn int, satisfaction_score int")
    fact = star.fact_activity(contracts, feedback)
    assert sorted(tuple(r) for r in fact.collect()) == [(1, 10.0, 1, 3), (2, 20.0, None, None)]


def test_csv_blank_number_is_null(spark, tmp_path):
    names = [c.split()[0] for c in files.TELCO_DDL.replace("\n", " ").split(",")]
    line = ["7590", "Female", "0", "Yes", "No", "1"] + ["No"] * 9 + ["Month-to-month", "Yes", "Check", "29.85", " ", "No"]
    (tmp_path / "telco.csv").write_text(",".join(names) + "\n" + ",".join(line) + "\n")
    row = files.read_csv(spark, str(tmp_path / "telco.csv"), files.TELCO_DDL).first()
    assert row["MonthlyCharges"] == 29.85 and row["TotalCharges"] is None and len(row) == 21


def test_natural_join_and_key_attach(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, s string")
    b = spark.createDataFrame([(1, 9)], "id long, cluster int")
    assert joins.natural_join(a, b).columns == ["id", "s", "cluster"]
    assert sorted(r["cluster"] or 0 for r in joins.attach(a, b, "id").collect()) == [0, 9]
    with pytest.raises(ValueError):
        joins.natural_join(a, spark.createDataFrame([(1,)], "z long"))


def test_drop_duplicate_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("cluster", "x", "cluster")
    out = schema.drop_duplicate_names(df)
    assert out.columns == ["cluster", "x"] and tuple(out.first()) == (1, 2)
