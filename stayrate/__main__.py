"""Command line for the jobs: ``spark-submit`` this module or run ``python -m stayrate <job>``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from stayrate.operators.encoding import FeatureModel
from stayrate.operators.training import TrainingConfig
from stayrate.operators.sampling import hash_split
from stayrate.plans import jobs
from stayrate.schemas import TARGET_ROWS
from stayrate.sources.readers import read_parquet
from stayrate.sources.storage import remove_scratch


def _add_split(job: argparse.ArgumentParser) -> None:
    job.add_argument("--split-key", default="customerID", help="rows with the same value fall on the same side")
    job.add_argument("--null-keys", nargs="*", default=[], help="columns that tell rows with a NULL key apart")
    job.add_argument("--seed", type=int, default=42)


def _training(args: argparse.Namespace, **more) -> TrainingConfig:
    return TrainingConfig(split_key=args.split_key, null_keys=tuple(args.null_keys), seed=args.seed, **more)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stayrate", description="Subscriber-churn batch jobs on Spark.")
    commands = parser.add_subparsers(dest="job", required=True)

    job = commands.add_parser("scale-up", help="raw CSV to a scaled-up Parquet table")
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--rows", type=int, default=TARGET_ROWS)
    job.add_argument("--seed", type=int, default=42)

    job = commands.add_parser("ingest", help="schema and data-quality report")
    job.add_argument("--input", required=True)
    job.add_argument("--report", required=True)
    job.add_argument("--target-rows", type=int, default=TARGET_ROWS)

    job = commands.add_parser("features", help="subscriber table to feature store")
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--files", type=int, help="number of output files; default: one per partition")
    job.add_argument("--save-model", help="keep the learned averages and encoders here")
    job.add_argument("--use-model", help="use averages and encoders saved earlier")
    job.add_argument("--extra", nargs="*", default=[], help="further columns to keep, such as source_row")
    job.add_argument("--max-categories", type=int, help="fail when a column has more values; default: no bound")
    job.add_argument("--fit-on-train", action="store_true", help="learn from the training side of the split only")
    _add_split(job)

    job = commands.add_parser("train", help="cross-validated search of three classifiers")
    job.add_argument("--input", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--fast", action="store_true", help="short search on a fifth of the rows")
    job.add_argument("--sample-fraction", type=float, help="default: all rows, a fifth with --fast")
    _add_split(job)

    job = commands.add_parser("evaluate", help="report, curves, thresholds, importances, summary")
    job.add_argument("--input", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--sample-fraction", type=float, default=1.0)
    job.add_argument("--threshold-model", default="GBT", help="the model whose threshold is searched")
    _add_split(job)
    job.add_argument("--all-rows", action="store_true", help="include the training rows")
    job.add_argument("--train-missing", action="store_true", help="train where no model is saved")

    job = commands.add_parser("score", help="score a monthly table")
    job.add_argument("--input", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--model", default="GBT")
    job.add_argument("--output", required=True)
    job.add_argument("--format", default="parquet")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    # Beyond this size of a generated method HotSpot interprets it.
    builder = SparkSession.builder.appName(f"stayrate-{args.job}").config("spark.sql.codegen.hugeMethodLimit", "8000")
    spark = builder.getOrCreate()
    if args.job == "scale-up":
        jobs.scale_up_job(spark, args.input, args.output, rows=args.rows, seed=args.seed).show()
    elif args.job == "ingest":
        jobs.ingest_job(spark, args.input, args.report, target_rows=args.target_rows).show(100, truncate=False)
    elif args.job == "features":
        earlier = FeatureModel.load(spark, args.use_model) if args.use_model else None
        fit_on = None
        if args.fit_on_train:
            rows = read_parquet(spark, args.input)
            fit_on, _ = hash_split(rows, args.split_key, seed=args.seed, null_keys=args.null_keys)
        jobs.feature_job(
            spark,
            args.input,
            args.output,
            files=args.files,
            fit_on=fit_on,
            feature_model=earlier,
            save_model_to=args.save_model,
            extra=tuple(args.extra),
            max_categories=args.max_categories,
        ).show()
    elif args.job == "train":
        config = jobs.fast_training(base=_training(args)) if args.fast else _training(args)
        if args.sample_fraction is not None:
            config = replace(config, sample_fraction=args.sample_fraction)
        result = jobs.training_job(spark, args.input, args.models, config)
        result.cross_validation.show(truncate=False)
        result.report.show()
        print(f"best by AUC: {result.best}; rows without a usable label: {result.quarantined}")
    elif args.job == "evaluate":
        config = jobs.EvaluationConfig(
            training=_training(args, sample_fraction=args.sample_fraction),
            threshold_model=args.threshold_model,
            holdout_only=not args.all_rows,
            train_missing=args.train_missing,
        )
        jobs.evaluation_job(spark, args.input, args.models, args.output, config).show(truncate=False)
    else:
        jobs.scoring_job(spark, args.input, args.models, args.output, model_name=args.model, output_format=args.format).show()
    remove_scratch(spark)


if __name__ == "__main__":
    main()
