"""Feature importances under the names that the feature vector itself carries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def feature_names(df: DataFrame, column: str = "features") -> dict[int, str]:
    """Slot to name, from the vector column's metadata (kept through Parquet)."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: a["name"] for group in attributes.values() for a in group if "name" in a}


def importance_table(models: Mapping[str, PipelineModel], names: Mapping[int, str], spark: SparkSession) -> DataFrame:
    """(model, slot, feature, importance) of tree models, padded to equal length with 0.0.

    One row per vector slot and model: this is the size of the models, not of the data.
    """
    vectors = {m: pipeline.stages[-1].featureImportances for m, pipeline in models.items()}
    width = max([0, *(len(v) for v in vectors.values()), *(slot + 1 for slot in names)])
    rows = [
        (m, slot, names.get(slot, f"feature_{slot}"), float(v[slot]) if slot < len(v) else 0.0)
        for m, v in vectors.items()
        for slot in range(width)
    ]
    return spark.createDataFrame(rows, "model string, slot int, feature string, importance double")


def side_by_side(importances: DataFrame, models: list[str]) -> DataFrame:
    """One row per feature with a column per model, ranked by the first model."""
    columns = [F.sum(F.when(F.col("model") == m, F.col("importance")).otherwise(0.0)).alias(m) for m in models]
    return importances.groupBy("slot", "feature").agg(*columns).orderBy(F.desc(models[0]), "feature")


def top_features(importances: DataFrame, model: str, n: int = 5) -> DataFrame:
    chosen = importances.filter(F.col("model") == model)
    return chosen.orderBy(F.desc("importance"), "feature").limit(n).select("feature", "importance")
