"""Learners on the planted label, which contract and tenure predict."""

import threading

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayrate.operators import importance, metrics, sampling, scoring, training
from stayrate.operators.encoding import fit_features
from stayrate.sources.models import load_model, save_model
from stayrate.testbed import tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "features")
    subscribers = tables.planted_subscribers(spark, SF)
    train, _ = sampling.hash_split(subscribers, "customerID")
    fit_features(train).transform(subscribers).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def split(store):
    return sampling.hash_split(store, "customerID")


@pytest.fixture(scope="module")
def models(split):
    return {name: training.train_fixed(split[0], name) for name in ("LR", "RF", "GBT")}


def test_models_beat_the_floor_on_held_out_rows(models, split):
    report = training.model_report(scoring.stacked_predictions(models, split[1])).collect()
    assert sorted(r["model"] for r in report) == ["GBT", "LR", "RF"]
    assert all(r["auc"] > 0.62 for r in report), report
    assert {r["tn"] + r["fp"] + r["fn"] + r["tp"] for r in report} == {split[1].count()}


def test_stacked_predictions_equal_single_ones(models, split):
    stacked = scoring.stacked_predictions(models, split[1], keep=["customerID"])
    for name, model in models.items():
        single = scoring.score_batch(model, split[1]).select("customerID", "label", "prediction", F.col("churn_probability").alias("score"))
        mine = stacked.filter(F.col("model") == name).select("customerID", "label", "prediction", "score")
        assert mine.exceptAll(single).count() == 0 and mine.count() == single.count()


def test_exact_area_agrees_with_spark(models, split):
    frame = models["LR"].transform(split[1])
    exact = training.model_report(scoring.stacked_predictions({"LR": models["LR"]}, split[1])).first()["auc"]
    assert metrics.binned_auc(frame, bins=0) == pytest.approx(exact, abs=1e-9)


def test_grid_is_searched(split):
    """Grid points with different settings must give different results."""
    config = training.TrainingConfig(models=("LR",))
    estimator, grid = training.candidates(config)["LR"]
    assert all(param.parent == estimator.uid for point in grid for param in point)
    train = training.model_inputs(sampling.with_fold(split[0], "customerID", 3), ("fold",))
    fitted = training.cross_validate(train, estimator, [grid[0], grid[-1]], config)
    assert fitted.avgMetrics[0] != fitted.avgMetrics[1]
    best = fitted.bestModel.stages[-1]
    assert best.getRegParam() in (0.01, 0.1)


def test_grids(spark):
    full = {n: len(g) for n, (_, g) in training.candidates(training.TrainingConfig()).items()}
    fast = {n: len(g) for n, (_, g) in training.candidates(training.TrainingConfig(fast=True)).items()}
    assert full == {"LR": 4, "RF": 4, "GBT": 4} and fast == {"LR": 1, "RF": 1, "GBT": 1}
    assert training.TrainingConfig().folds == 3 and training.TrainingConfig(fast=True).folds == 2


def test_saved_model_scores_the_same(spark, models, split, tmp_path):
    save_model(models["GBT"], str(tmp_path), "GBT")
    loaded = load_model(spark, str(tmp_path), "GBT")
    a, b = scoring.score_batch(models["GBT"], split[1]), scoring.score_batch(loaded, split[1])
    assert a.columns == ["customerID", "prediction", "churn_probability", "label"]
    assert a.exceptAll(b).count() == 0


def test_load_or_train(spark, split, tmp_path):
    with pytest.raises(FileNotFoundError, match="LR_best"):
        training.load_or_train(spark, str(tmp_path), "LR")
    fallback = training.load_or_train(spark, str(tmp_path), "LR", split[0])
    save_model(fallback, str(tmp_path), "LR")
    assert training.load_or_train(spark, str(tmp_path), "LR").stages[-1].coefficients == fallback.stages[-1].coefficients


def test_optional_columns_in_scores(models, split):
    bare = split[1].select("features")
    assert scoring.score_batch(models["LR"], bare).columns == ["prediction", "churn_probability"]


def test_numeric_columns_are_assembled(spark):
    subscribers = tables.planted_subscribers(spark, SF).select("customerID", "tenure", "MonthlyCharges", F.col("Churn").cast("double").alias("label"))
    model = training.train_fixed(subscribers, "LR")
    assert model.stages[0].getInputCols() == ["tenure", "MonthlyCharges"]
    with pytest.raises(ValueError, match="no numeric feature"):
        training.train_fixed(subscribers.select("customerID", "label"), "LR")


def test_given_vectors_are_used_as_they_are(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        array_to_vector("embedding").alias("features"), F.when(F.col("label") < 3, 1.0).otherwise(0.0).alias("label")
    )
    model = training.train_fixed(rows, "LR")
    assert len(model.stages) == 1 and model.stages[0].numFeatures == 64


def test_importances_carry_the_right_names(spark, models, store):
    trees = {m: models[m] for m in ("GBT", "RF")}
    table = importance.importance_table(trees, importance.feature_names(store), spark)
    ranked = importance.side_by_side(table, ["GBT", "RF"]).collect()
    assert [r["GBT"] for r in ranked] == sorted((r["GBT"] for r in ranked), reverse=True)
    assert sum(r["GBT"] for r in ranked) == pytest.approx(1.0) and sum(r["RF"] for r in ranked) == pytest.approx(1.0)
    top = [r["feature"] for r in importance.top_features(table, "GBT").collect()]
    assert len(top) == 5 and "tenure" in top  # the planted rule uses tenure and contract


def test_split_without_a_key_column(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    with pytest.raises(ValueError, match="customerID"):
        training.split_rows(df, training.TrainingConfig())
    train, test = training.split_rows(df, training.TrainingConfig(split_key=None))
    assert train.columns == ["x", "label", "fold"] and test.columns == ["x", "label"]
    assert train.count() + test.count() == 1000 and 700 < train.count() < 900


def test_sampling_does_not_move_rows_between_sides(spark, store):
    whole_train, _ = training.split_rows(store, training.TrainingConfig())
    part_train, part_test = training.split_rows(store, training.TrainingConfig(sample_fraction=0.5))
    assert 0 < part_train.count() < whole_train.count()
    _, whole_test = training.split_rows(store, training.TrainingConfig())
    assert part_test.select("customerID").exceptAll(whole_test.select("customerID")).count() == 0


def test_training_rows_are_dealt_evenly_whatever_the_files_are(store):
    rows = training.model_inputs(store.coalesce(1))
    spread = training.spread_rows(rows, rows=1000)
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    n = rows.count()
    assert len(sizes) == -(-n // 1000) and max(r["count"] for r in sizes) <= 1100
    assert spread.exceptAll(rows).count() == 0 and spread.count() == n
    assert training.spread_rows(rows, rows=n) is rows
    width = training.vector_width(rows)
    assert width == len(importance.feature_names(store)) > 0
    assert training.spread_rows(rows, numbers=1000 * width).rdd.getNumPartitions() == len(sizes)


def test_searched_forests_keep_node_ids_and_stay_the_same(store):
    searched = training.candidates(training.TrainingConfig())
    forest, grid = searched["RF"]
    assert forest.getCacheNodeIds() and not searched["GBT"][0].getCacheNodeIds()
    training.checkpoint_dir(store.sparkSession)
    rows = training.model_inputs(store).repartition(3).localCheckpoint()
    kept, walked = (forest.copy({**grid[-1], forest.numTrees: 20, forest.cacheNodeIds: keep}).fit(rows) for keep in (True, False))
    assert max(tree.depth for tree in kept.trees) == 10
    assert kept.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1]


def test_tasks_of_a_fit_are_few_and_bounded(spark):
    """Each task costs time in each of the hundreds of jobs of a boosted fit, whatever it reads."""
    table = spark.range(0, 250_000, 1, 20).select(*(F.col("id").cast("double").alias(f"x{i}") for i in range(54)), F.lit(1.0).alias("label"))
    sizes = [r["count"] for r in training.spread_rows(table).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 250_000 and max(sizes) <= 100_000
    wide = table.select("*", *(F.col("x0").alias(f"y{i}") for i in range(146)))
    assert training.spread_rows(wide).rdd.getNumPartitions() == 5


def test_a_fit_deals_out_its_rows(store, monkeypatch):
    monkeypatch.setattr(training.spread_rows, "__kwdefaults__", {"rows": 1000, "numbers": training.TASK_NUMBERS})
    fitted = []
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, rows: fitted.append(rows))
    training.train_fixed(store.coalesce(1), "GBT")
    assert fitted[0].rdd.getNumPartitions() == -(-store.count() // 1000)


def test_searches_run_side_by_side(store, monkeypatch):
    """Each search waits for the others to begin: one after the other would never end."""
    begun = threading.Barrier(3, timeout=20)
    monkeypatch.setattr(training, "cross_validate", lambda train, estimator, grid, config: (begun.wait(), config.parallelism))
    found = training.train_all(store, training.TrainingConfig())
    assert {c for _, c in found.values()} == {4} and set(found) == {"LR", "RF", "GBT"}
