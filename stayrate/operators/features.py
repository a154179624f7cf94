"""Derived subscriber features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions import columns as C
from stayrate.operators.bounded import fixed, join_grouped


def add_tenure_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("tenure_bucket", C.tenure_bucket(F.col("tenure")))


def contract_averages(df: DataFrame) -> DataFrame:
    """Average monthly charge per contract type, to the cent."""
    return df.groupBy("Contract").agg(F.round(F.avg("MonthlyCharges"), 2).alias("avg_charge_by_contract"))


def add_contract_average(df: DataFrame, averages: DataFrame | None = None, *, overall: float | None = None) -> DataFrame:
    """Attach the contract average. Rows without a contract have none and drop out.

    Pass ``averages`` taken from the training rows to keep held-out rows out of them. A contract that
    they do not know gets ``overall``; without one such rows keep a NULL average.
    """
    known = fixed(contract_averages(df)) if averages is None else averages
    joined = join_grouped(df.filter("Contract IS NOT NULL"), known, "Contract", how="left")
    if overall is not None:
        joined = joined.withColumn("avg_charge_by_contract", F.coalesce("avg_charge_by_contract", F.lit(float(overall))))
    return joined.select(*df.columns, "avg_charge_by_contract")


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Charge and service features; needs the contract average."""
    return df.withColumns(
        {
            "charge_ratio": C.charge_ratio(F.col("MonthlyCharges"), F.col("avg_charge_by_contract")),
            "charge_per_month": C.charge_per_month(F.col("TotalCharges"), F.col("tenure")),
            "complaint_proxy": C.complaint_proxy(F.col("TechSupport"), F.col("OnlineSecurity")),
            "service_count": C.service_count(),
        }
    )


def engineer_features(df: DataFrame, averages: DataFrame | None = None, *, overall: float | None = None) -> DataFrame:
    """The whole relational feature step."""
    bucketed = df.transform(add_tenure_bucket)
    return bucketed.transform(add_contract_average, averages, overall=overall).transform(add_derived_columns)
