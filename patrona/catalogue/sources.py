"""Queries that write the given tables with a sink and read them back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from patrona.catalogue.common import rnd, rounded
from patrona.catalogue.registry import on_base, query
from patrona.catalogue.shaping import hash_sql
from patrona.plans import star
from patrona.session import scratch_path
from patrona.sources import catalog, files
from patrona.sources.synthetic import synthetic_profiles
from patrona.sources.tables import BASE_COLUMNS


@query("s01_csv_inferred", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = files.write_csv(t("customer"), scratch_path(t.spark, "customer-csv"))
    return files.read_csv(t.spark, path)


@query("s02_csv_schema", on_base("SELECT customer_id, offer, monthly_charge, tenure_in_months FROM base"))
def _(t):
    path = files.write_csv(t.base("customer_id", "offer", "monthly_charge", "tenure_in_months"),
                           scratch_path(t.spark, "base-csv"))
    return files.read_csv(t.spark, path, "customer_id bigint, offer string, monthly_charge double, tenure_in_months int")


@query("s03_parquet_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000""")
def _(t):
    orders = files.read_parquet(t.spark, f"{t.root}/orders.parquet")
    return orders.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("s04_parquet_sink", "SELECT * FROM orders")
def _(t):
    return files.read_parquet(t.spark, files.write_parquet(t("orders"), scratch_path(t.spark, "orders")))


@query("s05_object_store_sink", "SELECT * FROM part")
def _(t):
    path = scratch_path(t.spark, "part")
    hadoop = t.spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(hadoop).toString()  # the session's default store where the path names none
    return files.read_parquet(t.spark, files.write_parquet(t("part"), uri))


def _schema(t, name):
    """Fresh schema in the shared folder."""
    path = scratch_path(t.spark, name)
    schema = f"{name}_{path[-8:]}"
    catalog.create_schema(t.spark, schema, path)
    return schema


@query("s06_managed_table", """
SELECT c_custkey AS customer_id, c_mktsegment AS market_segment, c_acctbal AS account_balance FROM customer""")
def _(t):
    raw = t("customer").select(F.col("c_custkey").alias("Customer ID"), F.col("c_mktsegment").alias("Market-Segment"),
                               F.col("c_acctbal").alias("Account Balance"))
    return catalog.save_conformed(raw, f"{_schema(t, 'conformed')}.customer")


@query("s07_create_schema", "SELECT 1::BIGINT AS n_schemas, count(*) AS n_rows FROM region")
def _(t):
    schema = _schema(t, "places")
    regions = catalog.save_table(t("region"), f"{schema}.region")
    return (regions.agg(F.count("*").alias("n_rows"))
            .withColumn("n_schemas", t.spark.sql(f"SHOW SCHEMAS LIKE '{schema}'").agg(F.count("*")).scalar()))


def _star_tables(t):
    wide = t.base(*[c for c in BASE_COLUMNS if any(c in cols for cols in star.SUBJECTS.values())])
    schema = _schema(t, "star")
    wide = catalog.save_table(wide, f"{schema}.wide_customer")
    catalog.save_star(t.spark, schema, star.star_schema(star.split_subjects(wide)))
    return schema


STAR = [*[f"dim_{name}" for name in star.SUBJECTS], "fact_customer_activity"]


@query("s08_create_star_tables", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM customer" for name in STAR))
def _(t):
    schema = _star_tables(t)
    counts = [t.spark.table(f"{schema}.{name}").agg(F.count("*").alias("n_rows"))
              .select(F.lit(name).alias("table_name"), "n_rows") for name in STAR]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


def _bucketed_star(t):
    wide = t.base(*[c for c in BASE_COLUMNS if any(c in cols for cols in star.SUBJECTS.values())])
    return catalog.save_bucketed_star(wide, _schema(t, "bucketed"), "customer_id")


@query("s08_bucketed_star_fact", on_base("""
SELECT customer_id, monthly_charge, total_charges, total_revenue, cltv, churn, churn_score, satisfaction_score
FROM base"""))
def _(t):
    return _bucketed_star(t)["fact_customer_activity"]


@query("j02_bucketed_join_mean", on_base(f"""
SELECT internet_type, {rnd('avg(satisfaction_score)')} AS mean_satisfaction, count(*) AS n FROM base GROUP BY 1"""))
def _(t):
    """Two bucketed dimensions joined on the customer key: no shuffle but that of the groups."""
    tables = _bucketed_star(t)
    joined = tables["dim_customer_services"].join(tables["dim_customer_feedback"], "customer_id")
    return rounded(joined.groupBy("internet_type").agg(F.avg("satisfaction_score").alias("mean_satisfaction"),
                                                       F.count("*").alias("n")))


@query("s09_list_tables", "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name" for name in [*STAR, "wide_customer"]))
def _(t):
    return catalog.list_tables(t.spark, _star_tables(t))


@query("s10_csv_sink", on_base(
    "SELECT customer_id AS \"Customer_ID\", churn_score / 100e0 AS churn_proba, churn AS churn_pred FROM base"))
def _(t):
    scores = t.base("customer_id", "churn_score", "churn").select(
        F.col("customer_id").alias("Customer_ID"), (F.col("churn_score") / 100).alias("churn_proba"),
        F.col("churn").alias("churn_pred"))
    path = files.write_csv(scores, scratch_path(t.spark, "scores"))
    return files.read_csv(t.spark, path, "Customer_ID bigint, churn_proba double, churn_pred int")


@query("s11_saved_model", "SELECT count(*) AS n_rows, count(*) AS n_same FROM embeddings")
def _(t):
    from pyspark.ml.functions import array_to_vector
    from patrona.ml.models import best_kmeans
    rows = t("embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    model = best_kmeans(rows, 3, starts=1)
    path = files.save_model(PipelineModel(stages=[model]), scratch_path(t.spark, "model"))
    again = files.load_pipeline(path).transform(rows).select("vec_id", F.col("cluster").alias("again"))
    both = model.transform(rows).select("vec_id", "cluster").join(again, "vec_id")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("cluster") == F.col("again")).alias("n_same"))


def _unit(i):
    return f"{hash_sql('c_custkey', 4200 + i)}::DOUBLE / 4503599627370496"


@query("s14_synthetic_profiles", f"""
SELECT c_custkey, ({_unit(1)} >= 0.7)::INT AS churn, {rnd(f'-500 * ln(1 - {_unit(2)})')} AS cltv,
  floor({_unit(3)} * 5)::INT AS segment, (1 + floor({_unit(4)} * 59))::INT AS tenure,
  {rnd(f'70 + 20 * sqrt(-2 * ln(1 - {_unit(5)})) * cos(2 * pi() * {_unit(6)})')} AS monthly_charges FROM customer""")
def _(t):
    return rounded(synthetic_profiles(t("customer"), "c_custkey"))


@query("s15_recorded_run", on_base("""
SELECT 'run-1' AS run_id, 'churn_rate' AS name, 'churn' AS target, count(*)::DOUBLE AS n_rows,
  count(*) FILTER (WHERE churn = 1)::DOUBLE AS n_churned FROM base"""))
def _(t):
    found = t.base("churn").agg(F.count("*").alias("n_rows"), F.count_if(F.col("churn") == 1).alias("n_churned")).first()
    path = scratch_path(t.spark, "runs")
    catalog.record_run(t.spark, path, "run-1", "churn_rate", {"target": "churn"}, found.asDict())
    return catalog.read_runs(t.spark, path).select(
        "run_id", "name", F.col("params.target").alias("target"), F.col("metrics.n_rows").alias("n_rows"),
        F.col("metrics.n_churned").alias("n_churned"))
