"""Prints one JSON line with seconds per query and job.

Two parts: registered queries over the tables at BENCH_SF_DIR, and the jobs at BENCH_ROWS rows
(2,000,000 by default) of a table scaled up from them. ``train_fast`` is the short search over a
10% sample, ``train_full`` the whole grids over a 1% sample.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stayrate.operators import curves, features, metrics, quality, sampling  # noqa: E402
from stayrate.operators.training import TrainingConfig  # noqa: E402
from stayrate.plans import jobs  # noqa: E402
from stayrate.sources.writers import write_parquet  # noqa: E402
from stayrate.testbed import tables  # noqa: E402
from stayrate.testbed.queries import QUERIES  # noqa: E402

HEADLINE = [
    "feature_table",
    "contract_avg_join",
    "csv_scan",
    "quality_report",
    "class_distribution",
    "stddev_profile",
    "threshold_sweep",
    "best_threshold",
    "roc_points",
    "roc_auc",
    "pr_area",
    "class_metrics",
    "hash_split",
    "bootstrap_rows",
    "gaussian_noise",
    "string_index",
    "one_hot",
    "assembled_features",
    "written_validation",
]


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayrate-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")  # beyond it HotSpot interprets
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_ROWS", "2000000"))
    scratch = tempfile.mkdtemp(prefix="stayrate-bench-")
    spark = session(cpus, scratch)
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> object:
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
        return result

    run(tables.subscribers(spark, sf_dir))  # start-up is not part of any query
    for name in HEADLINE:
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))

    scaled, store, models = f"{scratch}/scaled", f"{scratch}/features", f"{scratch}/models"
    source = tables.planted_subscribers(spark, sf_dir)
    timed("rows_scale_up", lambda: write_parquet(sampling.scale_up(source, rows), scaled))
    table = spark.read.parquet(scaled)
    timed("rows_quality_report", lambda: run(quality.quality_report(table)))
    timed("rows_engineer_features", lambda: run(features.engineer_features(table)))
    timed("rows_feature_job", lambda: jobs.feature_job(spark, scaled, store, extra=("source_row",)))
    scores = table.select(F.col("Churn").alias("label"), (F.col("MonthlyCharges") / F.lit(1e6)).alias("score"))
    timed("rows_hash_sample", lambda: run(sampling.hash_sample(table, "customerID", 0.1)))
    timed("rows_threshold_sweep", lambda: run(metrics.threshold_sweep(scores)))
    timed("rows_roc_auc", lambda: run(curves.curve_areas(curves.ranked_counts(scores))))
    config = TrainingConfig(fast=True, sample_fraction=0.1, split_key="source_row")
    timed("train_fast", lambda: jobs.training_job(spark, store, models, config))
    # The whole grids, 36 fits and 3 refits, on a hundredth of the rows.
    full = TrainingConfig(sample_fraction=0.01, split_key="source_row")
    timed("train_full", lambda: jobs.training_job(spark, store, config=full))
    timed("rows_scoring_job", lambda: jobs.scoring_job(spark, store, models, f"{scratch}/scores"))
    evaluation = jobs.EvaluationConfig(training=config, holdout_only=False)
    timed("evaluate_sample", lambda: jobs.evaluation_job(spark, store, models, f"{scratch}/evaluation", evaluation))

    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "rows": rows,
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
