"""Catalog tables: schemas, managed tables, create-table-as, listings and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrona.operators.schema import clean_column_names
from patrona.plans import star

RUN_SCHEMA = "run_id string, name string, params map<string,string>, metrics map<string,double>, ts timestamp"


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def save_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Overwrite a managed table and read it."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)


def swap_table(spark: SparkSession, finished: str, name: str) -> None:
    """Give a finished table its name; the former table of that name stays until then and goes afterwards."""
    former = f"{name}__former"
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {finished} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {former}")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A managed table bucketed and sorted by its key, written aside and swapped in when it is complete.

    Tables with as many buckets of the same key are joined without a shuffle. A write
    that fails leaves the table that was there; tasks of it may still leave files in its
    folder, so each write has a name of its own. Tables that were never swapped in go first.
    """
    schema, _, table = name.rpartition(".")
    schema = schema or df.sparkSession.catalog.currentDatabase()
    left = list_tables(df.sparkSession, schema).where(F.col("table_name").startswith(f"{table.lower()}__next_"))
    for row in left.collect():
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {schema}.{row['table_name']}")
    finished = f"{name}__next_{uuid.uuid4().hex}"
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(finished)
    swap_table(df.sparkSession, finished, name)
    return df.sparkSession.table(name)


def create_table_as(spark: SparkSession, name: str, select: str | DataFrame) -> DataFrame:
    """Create or replace a table from a query."""
    return save_table(spark.sql(select) if isinstance(select, str) else select, name)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Names of the tables of a schema."""
    return spark.sql(f"SHOW TABLES IN {schema}").select(F.col("tableName").alias("table_name"))


def save_conformed(df: DataFrame, name: str) -> DataFrame:
    """Conformed table of a raw frame: cleaned names, then a managed table."""
    return save_table(clean_column_names(df), name)


def save_star(spark: SparkSession, schema: str, tables: Mapping[str, DataFrame]) -> None:
    """Write the tables of a star schema."""
    for name, df in tables.items():
        create_table_as(spark, f"{schema}.{name}", df)


def save_bucketed_star(wide: DataFrame, schema: str, key: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Wide table, subject tables and fact table, all bucketed by ``key``.

    The wide table is shuffled once, when it is written; whatever is derived from it keeps
    its buckets. By default there are as many buckets as shuffle partitions.
    """
    spark = wide.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = save_bucketed(wide.repartition(buckets, key), f"{schema}.wide_customer", key, buckets)
    tables = {name: save_bucketed(df, f"{schema}.dim_{name}", key, buckets)
              for name, df in star.split_subjects(wide).items()}
    fact = star.fact_activity(tables["customer_contracts"], tables["customer_feedback"])
    return {f"dim_{name}": df for name, df in tables.items()} | {
        "wide_customer": wide,
        "fact_customer_activity": save_bucketed(fact, f"{schema}.fact_customer_activity", key, buckets)}


def record_run(spark: SparkSession, path: str, run_id: str, name: str, params: Mapping, metrics: Mapping) -> None:
    """Append one training run to the run log."""
    row = [(run_id, name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})]
    (spark.createDataFrame(row, "run_id string, name string, params map<string,string>, metrics map<string,double>")
     .withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs."""
    return spark.read.schema(RUN_SCHEMA).parquet(path)
