"""Column contracts shared by the readers, the quality checks and the feature operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The subscriber table every job reads, in column order.
SUBSCRIBER_TYPES: dict[str, str] = {
    "customerID": "string",
    "gender": "string",
    "SeniorCitizen": "bigint",
    "Partner": "string",
    "Dependents": "string",
    "tenure": "bigint",
    "PhoneService": "string",
    "MultipleLines": "string",
    "InternetService": "string",
    "OnlineSecurity": "string",
    "OnlineBackup": "string",
    "DeviceProtection": "string",
    "TechSupport": "string",
    "StreamingTV": "string",
    "StreamingMovies": "string",
    "Contract": "string",
    "PaperlessBilling": "string",
    "PaymentMethod": "string",
    "MonthlyCharges": "double",
    "TotalCharges": "double",
    "Churn": "bigint",
}

# The add-on services that make up service_count (internet access is not one of them).
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]

# The columns that are string-indexed and one-hot encoded.
CATEGORICAL_COLUMNS = [
    "gender",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "tenure_bucket",
]

# The numeric inputs that lead the feature vector.
NUMERIC_COLUMNS = [
    "SeniorCitizen",
    "tenure",
    "MonthlyCharges",
    "TotalCharges",
    "avg_charge_by_contract",
    "charge_ratio",
    "charge_per_month",
    "complaint_proxy",
    "service_count",
]

# What the feature store keeps beside the vector and the label.
METADATA_COLUMNS = [
    "customerID",
    "tenure_bucket",
    "complaint_proxy",
    "service_count",
    "charge_ratio",
    "charge_per_month",
]

# Column contracts of predictions and of score outputs; a None kind keeps the input's.
PREDICTION_CONTRACT = {"label": "double", "prediction": "double", "probability": None}
SCORE_CONTRACT = {"customerID": None, "prediction": "double", "churn_probability": None, "label": "double"}
SCORE_OPTIONAL = ("customerID", "label")

# Columns that receive noise when the table is scaled up.
NOISY_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]
NOISE_FACTOR = 0.05
CHUNK_ROWS = 500_000
ROW_GROUP_ROWS = 100_000
TARGET_ROWS = 2_000_000

# Model names, in the order that settles a tie on AUC.
MODEL_NAMES = ["LR", "RF", "GBT"]


def subscriber_schema() -> T.StructType:
    """The typed subscriber table."""
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in SUBSCRIBER_TYPES.items()))


def raw_subscriber_schema() -> T.StructType:
    """The CSV landing table: same columns, with the two dirty ones still text."""
    kinds = {**SUBSCRIBER_TYPES, "TotalCharges": "string", "Churn": "string"}
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
