"""Classification metrics from a confusion matrix, and the threshold sweep.

Rates are over rows with a label of 0 or 1, here and in the sweep; ``unlabelled`` counts the others.
Inputs carry ``label`` and ``prediction`` (0/1) or ``label`` and ``score``. ``by`` groups the
result, so all models are measured in one pass over their stacked predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.columns import nan_to_null, safe_ratio
from stayrate.schemas import MODEL_NAMES

# 0.20 to 0.80 in steps of 0.05, rounded so that 0.4 is 0.4.
THRESHOLDS = [round(0.20 + 0.05 * i, 2) for i in range(13)]


def confusion_matrix(predictions: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp; a cell without rows is 0."""

    def cell(label: int, prediction: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    return predictions.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def unlabelled(predictions: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows that no rate counts, because their label is neither 0 nor 1."""
    return predictions.groupBy(*by).agg(F.count_if(~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("unlabelled"))


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, weighted F1, and precision, recall and F1 of both classes, beside the cells."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = matrix.withColumns(
        {
            "accuracy": safe_ratio(tp + tn, tn + fp + fn + tp),
            "precision_0": safe_ratio(tn, tn + fn),
            "recall_0": safe_ratio(tn, tn + fp),
            "precision_1": safe_ratio(tp, tp + fp),
            "recall_1": safe_ratio(tp, tp + fn),
        }
    )
    f1 = rates.withColumns({f"f1_{k}": _f1(F.col(f"precision_{k}"), F.col(f"recall_{k}")) for k in (0, 1)})
    weighted = (tn + fp) * F.col("f1_0") + (fn + tp) * F.col("f1_1")
    return f1.withColumn("weighted_f1", safe_ratio(weighted, tn + fp + fn + tp))


def threshold_sweep(
    scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS, *, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion cells and rates at every threshold, from one pass over the scores.

    The scores reduce to counts per number of thresholds reached, at most one row more than
    there are thresholds; each of those rows then counts towards every threshold.
    """
    ordered = sorted(float(t) for t in thresholds)
    score = F.coalesce(nan_to_null(F.col("score").cast("double")), F.lit(float("-inf")))
    reached = sum((score >= F.lit(t)).cast("int") for t in ordered)
    reduced = scored.groupBy(*by, reached.alias("_reached")).agg(
        F.count_if(F.col("label") == 1).alias("_pos"), F.count_if(F.col("label") == 0).alias("_neg")
    )
    expanded = reduced.select("*", F.posexplode(F.array(*map(F.lit, ordered))).alias("_step", "threshold"))
    hit = F.col("_step") < F.col("_reached")

    def total(counted: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(counted)).otherwise(0))

    cells = expanded.groupBy(*by, "threshold").agg(
        total("_pos", hit).alias("tp"),
        total("_neg", hit).alias("fp"),
        total("_pos", ~hit).alias("fn"),
        total("_neg", ~hit).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = cells.select(
        *by,
        "threshold",
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        "tp",
        "fp",
        "fn",
        "tn",
    )
    f1 = _f1(F.col("precision"), F.col("recall"))
    return rates.select(*by, "threshold", "precision", "recall", f1.alias("f1"), "accuracy", "tp", "fp", "fn", "tn")


def best_threshold(sweep: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest F1; the lowest threshold wins a tie."""
    rank = F.struct("f1", -F.col("threshold"))
    return sweep.groupBy(*by).agg(F.max_by(F.struct(*(c for c in sweep.columns if c not in by)), rank).alias("_best")).select(
        *by, "_best.*"
    )


def best_model(metrics: DataFrame, *, measure: str = "auc", order: Sequence[str] = MODEL_NAMES) -> DataFrame:
    """The row with the highest ``measure``; the first model in ``order`` wins a tie."""
    position = F.array_position(F.array(*map(F.lit, order)), F.col("model"))
    return metrics.orderBy(F.desc(measure), F.when(position == 0, len(order) + 1).otherwise(position), "model").limit(1)


def binned_auc(predictions: DataFrame, *, raw: str = "probability", bins: int = 1000) -> float:
    """Spark's own area under ROC; ``bins=0`` makes it exact."""
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=raw, metricName="areaUnderROC", numBins=bins)
    return evaluator.evaluate(predictions)


def auc_error(auc: Column, positives: Column, negatives: Column) -> Column:
    """Standard error of an area under ROC (Hanley and McNeil)."""
    q1, q2 = auc / (2 - auc), 2 * auc * auc / (1 + auc)
    spread = auc * (1 - auc) + (positives - 1) * (q1 - auc * auc) + (negatives - 1) * (q2 - auc * auc)
    return F.sqrt(F.greatest(spread, F.lit(0.0)) / F.nullif(positives * negatives, F.lit(0)))
