"""Bucketed star tables: no shuffle in their join, and a swap that keeps the former table until the new one is complete."""

import pytest
from pyspark.sql import functions as F

from patrona.sources import catalog


def _wide(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("customer_id"), (F.col("id") % 7).alias("satisfaction_score"), (F.col("id") * 1.5).alias("cltv"),
        (F.col("id") % 2).cast("int").alias("churn"), F.concat(F.lit("t"), F.col("id") % 3).alias("internet_type"))


@pytest.fixture
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS star_test")
    yield "star_test"
    spark.sql("DROP SCHEMA star_test CASCADE")


def test_join_of_bucketed_tables_has_no_exchange(spark, schema):
    tables = catalog.save_bucketed_star(_wide(spark), schema, "customer_id", buckets=4)
    assert tables["fact_customer_activity"].count() == 400
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables["dim_customer_contracts"].join(tables["dim_customer_feedback"], "customer_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_failed_write_leaves_the_former_table(spark, schema):
    name = f"{schema}.customers"
    catalog.save_bucketed(_wide(spark), name, "customer_id", 4)
    bad = _wide(spark).withColumn("cltv", F.when(F.col("customer_id") == 399, F.raise_error(F.lit("broken")).cast("double"))
                                  .otherwise(F.col("cltv")))
    with pytest.raises(Exception, match="broken"):
        catalog.save_bucketed(bad, name, "customer_id", 4)
    assert spark.table(name).count() == 400
    catalog.save_bucketed(_wide(spark, 30), name, "customer_id", 4)
    assert spark.table(name).count() == 30
    left = {r["table_name"] for r in catalog.list_tables(spark, schema).collect()}
    assert "customers" in left and "customers__former" not in left


def test_files_of_a_failed_write_do_not_hinder_the_next(spark, schema):
    name = f"{schema}.customers_again"
    catalog.save_bucketed(_wide(spark, 10), name, "customer_id", 4)
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    _wide(spark, 5).write.parquet(place + "__next/_temporary/0")
    catalog.save_bucketed(_wide(spark, 30), name, "customer_id", 4)
    assert spark.table(name).count() == 30


def test_tables_never_swapped_in_go_with_the_next_write(spark, schema):
    _wide(spark, 5).write.saveAsTable(f"{schema}.customers_late__next_1")
    catalog.save_bucketed(_wide(spark, 30), f"{schema}.customers_late", "customer_id", 4)
    assert {r["table_name"] for r in catalog.list_tables(spark, schema).collect()} >= {"customers_late"}
    assert not spark.catalog.tableExists(f"{schema}.customers_late__next_1")
