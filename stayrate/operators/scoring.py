"""Applying fitted pipelines. Every operator here is map-only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import positive_probability
from stayrate.schemas import PREDICTION_CONTRACT, SCORE_CONTRACT, SCORE_OPTIONAL

_MODEL_OUTPUTS = ("rawPrediction", "probability", "prediction")


def by_contract(df: DataFrame, contract: Mapping[str, str | None], optional: Sequence[str] = ()) -> DataFrame:
    """The contract's columns in its order and types; ``optional`` ones only where ``df`` has them."""
    present = {name: kind for name, kind in contract.items() if name in df.columns or name not in optional}
    return df.select(*(F.col(name) if kind is None else F.col(name).cast(kind).alias(name) for name, kind in present.items()))


def prediction_frame(scored: DataFrame) -> DataFrame:
    """label, prediction and probability of a transformed table."""
    return by_contract(scored, PREDICTION_CONTRACT)


def score_projection(scored: DataFrame) -> DataFrame:
    """[customerID], prediction, churn_probability, [label]; those in brackets when the table has them."""
    return by_contract(scored, SCORE_CONTRACT, SCORE_OPTIONAL)


def score_batch(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score every row that the pipeline accepts."""
    return score_projection(
        model.transform(df).withColumn("churn_probability", positive_probability(F.col("probability")))
    )


def stacked_predictions(models: Mapping[str, PipelineModel], df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """(model, label, prediction, score) of all models, from one scan of ``df``."""
    carried = [c for c in df.columns if c not in _MODEL_OUTPUTS]
    current, outputs = df.select(*carried), []
    for name, model in models.items():
        output = F.struct(
            F.lit(name).alias("model"),
            F.col("prediction").cast("double").alias("prediction"),
            positive_probability(F.col("probability")).alias("score"),
        )
        current = model.transform(current).select(*carried, *outputs, output.alias(f"_out_{name}"))
        outputs.append(f"_out_{name}")
    return current.select(
        *keep, F.col("label").cast("double").alias("label"), F.inline(F.array(*outputs))
    ).select(*keep, "model", "label", "prediction", "score")
