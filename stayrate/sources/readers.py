"""Table scans. Schemas are given, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions.columns import coerce_number, yes_no_flag
from stayrate.schemas import raw_subscriber_schema
from stayrate.sources.storage import require_path


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Subscriber CSV with a header. A header that does not match the contract fails the read."""
    return spark.read.schema(raw_subscriber_schema()).csv(path, header=True, enforceSchema=False)


def clean_raw(raw: DataFrame) -> DataFrame:
    """Raw landing rows to the typed table: numeric TotalCharges, Churn as 0/1 or NULL."""
    return raw.withColumns({"TotalCharges": coerce_number(F.col("TotalCharges")), "Churn": yes_no_flag(F.col("Churn"))})


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    for path in paths:
        require_path(spark, path, "input table")
    return spark.read.parquet(*paths)


def read_parquet_parts(spark: SparkSession, directory: str) -> DataFrame:
    """The part files of one table directory, by name pattern; fails when there are none."""
    return spark.read.parquet(f"{directory.rstrip('/')}/part-*.parquet")
