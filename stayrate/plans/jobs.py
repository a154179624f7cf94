"""Scale up, ingest, build features, train, evaluate, score.

Each job takes a session and paths, writes its tables and returns small result frames. Large
tables pass from job to job through storage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators import curves, importance, metrics, quality
from stayrate.operators.cleaning import resolve_label, usable_labels
from stayrate.operators.encoding import FeatureModel, fit_features
from stayrate.operators.sampling import scale_up
from stayrate.operators.scoring import score_batch, stacked_predictions
from stayrate.operators.training import (
    TrainingConfig,
    cv_table,
    feature_stages,
    load_or_train,
    model_report,
    sample_rows,
    split_rows,
    spread_rows,
    train_all,
)
from stayrate.schemas import MODEL_NAMES, TARGET_ROWS
from stayrate.sources.models import load_model, save_model
from stayrate.sources.readers import clean_raw, read_parquet, read_raw_csv
from stayrate.sources.writers import (
    check_score_format,
    write_file_count,
    write_parquet,
    write_report,
    write_row_bounded,
    write_scores,
)


def scale_up_job(
    spark: SparkSession, csv_path: str, output: str, *, rows: int = TARGET_ROWS, seed: int = 42
) -> DataFrame:
    """Raw CSV to a scaled-up Parquet table of exactly ``rows`` rows; returns its class distribution."""
    source = clean_raw(read_raw_csv(spark, csv_path))
    write_row_bounded(scale_up(source, rows, seed=seed), output)
    stored = spark.read.parquet(output)
    quality.check_row_count(stored, rows)
    return quality.class_distribution(stored)


def ingest_job(
    spark: SparkSession, table: str, report: str | None = None, *, target_rows: int | None = TARGET_ROWS
) -> DataFrame:
    """Schema and data-quality report of a subscriber table, written as JSON when a path is given.

    Counts, nulls and ranges come from the footers and file sizes from the scan; only the class column is read, and
    columns with negative values.
    """
    df = read_parquet(spark, table)
    result = (
        quality.quality_report(df, target_rows=target_rows, profile=quality.footer_profile(spark, table))
        .unionByName(quality.issue_rows(quality.schema_issues(df)))
        .unionByName(quality.partition_rows(quality.partition_profile(df)))
        .unionByName(quality.partition_rows(quality.file_skew(df), "files"))
    )
    if report is None:
        return result
    write_report(result, report)
    return spark.read.schema(result.schema).json(report)


def feature_job(
    spark: SparkSession,
    table: str,
    output: str,
    *,
    files: int | None = None,
    fit_on: DataFrame | None = None,
    feature_model: FeatureModel | None = None,
    save_model_to: str | None = None,
    extra: tuple[str, ...] = (),
    max_categories: int | None = None,
) -> DataFrame:
    """Subscriber table to feature store; returns the counts of the written table and of rows left out.

    One write routes the rows by label: folders ``label_status=used``, ``missing`` and ``quarantined``, of which
    only the first has labels. The averages and encoders are learned from the whole table, from ``fit_on`` (training rows
    only), or taken from an earlier ``feature_model``. Save them to encode later months alike.
    Rows without a contract or with a missing number get no vector; they are counted.
    """
    subscribers = read_parquet(spark, table)
    model = feature_model or fit_features(subscribers if fit_on is None else fit_on, max_categories=max_categories)
    if save_model_to is not None:
        model.save(save_model_to)
    write_file_count(model.transform(subscribers, extra=extra), output, files=files, by=["label_status"])
    written = quality.check_written(spark.read.parquet(output))
    # One column. (``observe`` would count in passing, but a session that has observed something can no
    # longer serialize the functions of a fitted pipeline.)
    found = subscribers.agg(F.count("*").alias("rows_read"), F.count_if(F.col("Contract").isNull()).alias("skipped_contract")).first()
    return written.withColumns(
        {
            "rows_read": F.lit(found["rows_read"]).cast("long"),
            "skipped_contract": F.lit(found["skipped_contract"]).cast("long"),
            "skipped_number": F.lit(found["rows_read"] - found["skipped_contract"]).cast("long") - F.col("row_count"),
        }
    )


@dataclass(frozen=True)
class TrainingResult:
    models: Mapping[str, PipelineModel]
    report: DataFrame
    cross_validation: DataFrame
    best: str
    #: rows whose label is neither 0 nor 1; no model saw them and no rate counts them
    quarantined: int = 0


def training_job(
    spark: SparkSession, features: str, model_root: str | None = None, config: TrainingConfig = TrainingConfig()
) -> TrainingResult:
    """Cross-validated search for each classifier, measured on held-out rows; saves the best of each."""
    usable, unusable = usable_labels(resolve_label(read_parquet(spark, features)))
    quarantined = unusable.count()
    train, test = split_rows(usable, config)
    # Both are read many times; on disk they leave the memory to the learners' own caches.
    train = spread_rows(train).persist(StorageLevel.DISK_ONLY)
    predictions = None
    try:
        fitted = train_all(train, config)
        models = {name: cv.bestModel for name, cv in fitted.items()}
        if model_root is not None:
            for name, model in models.items():
                save_model(model, model_root, name)
        predictions = stacked_predictions(models, test).persist(StorageLevel.MEMORY_AND_DISK)
        report = spark.createDataFrame(model_report(predictions).collect())  # one row per model
    finally:
        train.unpersist()
        if predictions is not None:
            predictions.unpersist()
    best = metrics.best_model(report).first()["model"]
    return TrainingResult(models, report, cv_table(fitted, spark), best, quarantined)


@dataclass(frozen=True)
class EvaluationConfig:
    """``holdout_only`` measures rows that training did not see, by the same split.

    ``train_missing`` allows training with fixed settings where no saved model exists.
    """

    training: TrainingConfig = TrainingConfig()
    holdout_only: bool = True
    train_missing: bool = False
    threshold_model: str = "GBT"
    importance_models: tuple[str, ...] = ("GBT", "RF")


def evaluation_job(
    spark: SparkSession, features: str, model_root: str, output: str, config: EvaluationConfig = EvaluationConfig()
) -> DataFrame:
    """Measure the saved models and write report, curves, thresholds, importances and summary.

    Below ``output``: report, roc_points, pr_points, areas, thresholds, importances, summary, and in
    quarantined the number of rows whose label is neither 0 nor 1.
    Returns the one-row summary.
    """
    table, unusable = usable_labels(resolve_label(read_parquet(spark, features)))
    write_parquet(unusable.agg(F.count("*").alias("rows")), f"{output}/quarantined")
    names = config.training.models
    train, test = split_rows(table, config.training)
    train_rows = train.drop("fold") if config.train_missing else None
    models = {n: load_or_train(spark, model_root, n, train_rows, seed=config.training.seed) for n in names}
    measured = test if config.holdout_only else sample_rows(table, config.training)

    by = ["model"]
    predictions = stacked_predictions(models, measured).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranked = curves.ranked_counts(predictions, by=by)
        write_parquet(ranked, f"{output}/ranked_counts")
        ranked = spark.read.parquet(f"{output}/ranked_counts")
        write_parquet(curves.roc_points(ranked, by=by), f"{output}/roc_points")
        write_parquet(curves.pr_points(ranked, by=by), f"{output}/pr_points")

        cells = metrics.class_metrics(metrics.confusion_matrix(predictions, by=by)).withColumnRenamed("weighted_f1", "f1")
        areas = curves.curve_areas(ranked, by=by).withColumnRenamed("roc_auc", "auc")
        write_parquet(cells.join(areas, "model"), f"{output}/report")
        write_parquet(metrics.threshold_sweep(predictions, by=by), f"{output}/thresholds")
    finally:
        predictions.unpersist()

    tree_models = {n: models[n] for n in config.importance_models if n in models}
    names_by_slot = importance.feature_names(vector_schema(measured))
    importances = importance.importance_table(tree_models, names_by_slot, spark)
    if tree_models:
        write_parquet(importance.side_by_side(importances, list(tree_models)), f"{output}/importances")

    report = spark.read.parquet(f"{output}/report")
    chosen = config.threshold_model if config.threshold_model in models else names[0]
    sweep = spark.read.parquet(f"{output}/thresholds").filter(F.col("model") == chosen).drop("model")
    result = summary(report, metrics.best_threshold(sweep), importance.top_features(importances, chosen))
    write_report(result, f"{output}/summary")
    return spark.read.schema(result.schema).json(f"{output}/summary")


def vector_schema(df: DataFrame) -> DataFrame:
    """``df`` with its feature vector, assembled from the numeric columns when it has none."""
    for stage in feature_stages(df):
        df = stage.transform(df)
    return df


def summary(report: DataFrame, threshold: DataFrame, top: DataFrame) -> DataFrame:
    """One nested row: figures per model to 4 places, best model, best threshold, top features."""

    def rounded(name: str, alias: str):
        return F.round(name, 4).alias(alias)

    def class_rates(k: int):
        return F.struct(*(rounded(f"{rate}_{k}", rate) for rate in ("precision", "recall", "f1"))).alias(f"class_{k}")

    figures = F.struct(
        rounded("auc", "auc"),
        rounded("f1", "f1"),
        rounded("accuracy", "accuracy"),
        class_rates(0),
        class_rates(1),
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
    )
    # Every input here has a handful of rows: models, one threshold, five features.
    names = [n for n in MODEL_NAMES if n in {r["model"] for r in report.select("model").collect()}]
    per_model = report.agg(*(F.first(F.when(F.col("model") == n, figures), ignorenulls=True).alias(n) for n in names))
    best = metrics.best_model(report).first()["model"]
    chosen = threshold.first()
    features = [r["feature"] for r in top.collect()]
    return per_model.select(
        *names,
        F.lit(best).alias("best_model"),
        F.lit(chosen["threshold"]).alias("best_threshold"),
        F.round(F.lit(chosen["f1"]), 4).alias("threshold_f1"),
        F.array(*map(F.lit, features)).cast("array<string>").alias("top_features"),
    )


def scoring_job(
    spark: SparkSession,
    table: str,
    model_root: str,
    output: str,
    *,
    model_name: str = "GBT",
    output_format: str = "parquet",
) -> DataFrame:
    """Score a monthly table with a saved model. One pass, no shuffle.

    Returns one row: rows read, scored and skipped (a missing number in a table without a vector).
    """
    output_format = check_score_format(output_format)
    df = read_parquet(spark, table)
    write_scores(score_batch(load_model(spark, model_root, model_name), df), output, output_format=output_format)
    written = spark.read.parquet(output) if output_format == "parquet" else spark.read.csv(output, header=True)
    n, kept = df.count(), written.count()  # from the footers where the format has them
    return spark.createDataFrame([(n, kept, n - kept)], "rows_read long, rows_scored long, rows_skipped long")


def fast_training(sample_fraction: float = 0.2, base: TrainingConfig = TrainingConfig()) -> TrainingConfig:
    """The short search on a sample: what ``--fast`` means unless a fraction is given."""
    return replace(base, fast=True, sample_fraction=sample_fraction)
