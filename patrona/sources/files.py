"""File sources and sinks: CSV, Parquet, object stores, saved models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

# Column types of the telco churn file.
TELCO_DDL = """
    customerID string, gender string, SeniorCitizen integer, Partner string, Dependents string, tenure integer,
    PhoneService string, MultipleLines string, InternetService string, OnlineSecurity string, OnlineBackup string,
    DeviceProtection string, TechSupport string, StreamingTV string, StreamingMovies string, Contract string,
    PaperlessBilling string, PaymentMethod string, MonthlyCharges double, TotalCharges double, Churn string
"""


def read_csv(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """CSV with a header; types from the DDL, or inferred by an extra pass over the file.

    With a DDL a blank number reads as null.
    """
    reader = spark.read.option("header", True)
    return reader.schema(ddl).csv(path) if ddl else reader.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S03."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> str:
    """Overwrite; any URI the cluster can write, credentials from its environment."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrite, with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_model(model, path: str) -> str:
    """Fitted model or pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    """S11."""
    return PipelineModel.load(path)
