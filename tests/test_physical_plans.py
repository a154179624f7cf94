"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from stayrate.operators import curves, features, metrics, quality, sampling, scoring
from stayrate.operators.bounded import join_grouped
from stayrate.operators.encoding import fit_features
from stayrate.operators.training import train_fixed
from stayrate.testbed import tables
from stayrate.testbed.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "subscribers")
    tables.planted_subscribers(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_contract_average_does_not_move_the_facts(stored):
    joined = features.engineer_features(stored)
    assert "BroadcastHashJoin" in plan(joined)
    assert exchanges(joined) == 0


def test_groups_are_never_broadcast_after_an_explode(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    groups = lines.groupBy("l_orderkey").agg(F.avg("l_quantity").alias("mean"))
    joined = join_grouped(lines, groups, "l_orderkey").select("l_orderkey", "l_linenumber", "mean")
    before = plan(joined)
    joined.count()
    for text in (before, plan(joined)):
        assert "Generate explode" not in text
    scans = [line for line in before.splitlines() if "FileScan" in line]
    assert all("l_extendedprice" not in line for line in scans)


def test_only_needed_columns_are_scanned(stored):
    scan = [line for line in plan(features.contract_averages(stored)).splitlines() if "FileScan" in line]
    assert len(scan) == 1 and "ReadSchema: struct<Contract:string,MonthlyCharges:double>" in scan[0]


def test_filters_reach_the_scan(stored):
    assert "PushedFilters: [IsNotNull(tenure), LessThan(tenure,12)]" in plan(stored.filter("tenure < 12"))
    store = plan(fit_features(stored).transform(stored))
    pushed = next(line for line in store.splitlines() if "PushedFilters" in line)
    for c in ("Contract", "tenure", "TotalCharges"):
        assert f"IsNotNull({c})" in pushed


def test_feature_step_and_scoring_are_map_only(stored):
    model = fit_features(stored)
    store = model.transform(stored)
    assert exchanges(store) == 0
    scores = scoring.score_batch(train_fixed(store, "LR"), store)
    assert exchanges(scores) == 0 and "Exchange" not in plan(scores).replace("BroadcastExchange", "")


def test_sampling_and_scaling_do_not_move_the_rows(stored):
    assert "Exchange" not in plan(sampling.hash_sample(stored, "customerID", 0.1))
    text = plan(sampling.scale_up(stored, 1000))
    # The numbered source is a written table, small enough here to be broadcast.
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text and "ExistingRDD" not in text


def test_profiles_aggregate_before_the_shuffle(stored):
    for df in (quality.null_counts(stored), metrics.confusion_matrix(stored.selectExpr("double(Churn) label", "double(Churn) prediction"))):
        assert plan(df).count("FileScan") == 1
        assert "partial_" in plan(df)


def test_curve_over_scores_has_no_single_partition_step(spark, sf_dir):
    scored = tables.scored(spark, sf_dir)
    text = plan(curves.score_counts(scored))
    assert "partial_" in text and "SinglePartition" not in text
    ranked = plan(curves.ranked_counts(scored))
    # The distinct scores are windowed per block; only the block totals meet in one partition.
    assert ranked.count("SinglePartition") <= 1
    above, _, below = ranked.partition("SinglePartition")
    assert "HashAggregate" in below


def test_curve_window_reuses_the_join_partitioning(spark, sf_dir):
    ranked = plan(curves.ranked_counts(tables.stacked_scores(spark, sf_dir), by=["model"]))
    assert "SinglePartition" not in ranked
    assert "ShuffledHashJoin" in ranked  # neither side has a known size; only buckets over the limit are broadcast
    assert all("_over" in line for line in ranked.splitlines() if "BroadcastHashJoin" in line)
    above_join = ranked.partition("ShuffledHashJoin")[0]
    assert "Window" in above_join and "Exchange" not in above_join


def test_no_python_in_any_relational_query(spark, sf_dir):
    learned = {"lr_scores", "rf_scores", "gbt_scores", "cv_metrics", "model_comparison", "feature_importance", "top_features"}
    learned |= {"binned_auc", "batch_predict", "evaluation_summary", "vector_input_scores", "cv_checks"}
    for name in sorted(set(QUERIES) - learned):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_skewed_class_still_profiles(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 1).otherwise(0).alias("Churn"))
    rows = quality.class_distribution(df).collect()
    assert [(r["Churn"], r["count"], r["pct"]) for r in rows] == [(0, 2000, 66.67), (1, 1000, 33.33)]
