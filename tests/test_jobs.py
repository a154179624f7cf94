"""The jobs end to end, from a CSV file to scores."""

import json

import pytest
from pyspark.ml.functions import vector_to_array

from stayrate.__main__ import main
from stayrate.operators.sampling import hash_split
from stayrate.operators.training import TrainingConfig
from stayrate.plans import jobs
from stayrate.testbed import tables

FAST = TrainingConfig(fast=True, split_key="source_row")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw = tables.planted_subscribers(spark, "/root/testdata/sf0.01")
    raw.selectExpr("* EXCEPT (Churn)", "if(Churn = 1, 'Yes', 'No') AS Churn").coalesce(1).write.csv(f"{root}/raw", header=True)
    distribution = jobs.scale_up_job(spark, f"{root}/raw", f"{root}/scaled", rows=3000)
    assert sum(r["count"] for r in distribution.collect()) == 3000
    return str(root)


@pytest.fixture(scope="module")
def store(spark, folder):
    train, _ = hash_split(spark.read.parquet(f"{folder}/scaled"), "source_row")
    profile = jobs.feature_job(
        spark, f"{folder}/scaled", f"{folder}/features", files=4, fit_on=train, extra=("source_row",)
    ).first()
    assert (profile["row_count"], profile["null_features"], profile["null_labels"]) == (3000, 0, 0)
    return f"{folder}/features"


@pytest.fixture(scope="module")
def trained(spark, folder, store):
    return jobs.training_job(spark, store, f"{folder}/models", FAST)


def test_ingest(spark, folder):
    report = jobs.ingest_job(spark, f"{folder}/scaled", f"{folder}/report", target_rows=3000).collect()
    failed = {(r["check"], r["column"]) for r in report if r["ok"] is False}
    # The scaled table carries two more columns than the contract.
    assert failed == {("schema_unexpected", "row_id"), ("schema_unexpected", "source_row")}
    assert any(r["check"] == "row_count" and r["value"] == 3000 and r["ok"] for r in report)


def test_training(trained):
    report = {r["model"]: r for r in trained.report.collect()}
    assert set(report) == {"LR", "RF", "GBT"}
    assert report[trained.best]["auc"] == max(r["auc"] for r in report.values()) > 0.62
    assert trained.cross_validation.count() == 3


def test_evaluation(spark, folder, store, trained):
    config = jobs.EvaluationConfig(training=FAST)
    row = jobs.evaluation_job(spark, store, f"{folder}/models", f"{folder}/out", config).first()
    report = {r["model"]: r for r in trained.report.collect()}
    assert row["best_model"] == trained.best
    for name in ("LR", "RF", "GBT"):
        # Same held-out rows as training measured, so the same figures.
        assert row[name]["auc"] == pytest.approx(report[name]["auc"], abs=1e-4)
        (tn, fp), (fn, tp) = row[name]["confusion_matrix"]
        assert (tn, fp, fn, tp) == tuple(report[name][c] for c in ("tn", "fp", "fn", "tp"))
    assert len(row["top_features"]) == 5 and 0.2 <= row["best_threshold"] <= 0.8
    assert spark.read.parquet(f"{folder}/out/thresholds").count() == 39
    assert spark.read.parquet(f"{folder}/out/roc_points").filter("score = double('infinity')").count() == 3
    assert spark.read.parquet(f"{folder}/out/importances").columns == ["slot", "feature", "GBT", "RF"]


def test_labels_are_routed_in_one_write(spark, tmp_path):
    given = {"1": "Yes", "2": "No", "3": "maybe", "4": None, "5": "", "6": "0"}
    cases = [(last, value) for last, value in given.items()]
    labels = spark.createDataFrame(cases, "last string, given string")
    raw = tables.subscribers(spark, "/root/testdata/sf0.001").selectExpr("* EXCEPT (Churn)", "right(customerID, 1) AS last")
    raw.join(labels, "last", "inner").withColumnRenamed("given", "Churn").drop("last").write.parquet(f"{tmp_path}/raw")
    counts = jobs.feature_job(spark, f"{tmp_path}/raw", f"{tmp_path}/store").first()
    store = spark.read.parquet(f"{tmp_path}/store")
    by_label = {}
    for r in store.collect():
        by_label.setdefault(given[r["customerID"][-1]], set()).add((r["label"], r["label_status"]))
    assert by_label == {
        "Yes": {(1.0, "used")}, "No": {(0.0, "used")}, "0": {(0.0, "used")},
        "maybe": {(None, "quarantined")}, "": {(None, "quarantined")}, None: {(None, "missing")},
    }
    assert (counts["used"], counts["missing"], counts["quarantined"]) == tuple(
        store.filter(f"label_status = '{s}'").count() for s in ("used", "missing", "quarantined")
    )
    assert sorted(p.name for p in tmp_path.glob("store/label_status=*")) == [f"label_status={s}" for s in ("missing", "quarantined", "used")]
    result = jobs.training_job(spark, f"{tmp_path}/store", config=TrainingConfig(fast=True, models=("LR",)))
    assert result.quarantined == counts["missing"] + counts["quarantined"] > 0
    assert sum(result.report.first()[c] for c in ("tn", "fp", "fn", "tp")) <= counts["used"]


def test_evaluation_without_models_fails_unless_asked(spark, folder, store):
    with pytest.raises(FileNotFoundError, match="LR_best"):
        jobs.evaluation_job(spark, store, f"{folder}/none", f"{folder}/none_out", jobs.EvaluationConfig(training=FAST))


def test_scoring_from_the_command_line(spark, folder, store, trained):
    main(["score", "--input", store, "--models", f"{folder}/models", "--output", f"{folder}/scores"])
    scores = spark.read.parquet(f"{folder}/scores")
    assert scores.columns == ["customerID", "prediction", "churn_probability", "label"]
    assert scores.count() == 3000 and scores.filter("churn_probability NOT BETWEEN 0 AND 1").count() == 0
    jobs.scoring_job(spark, store, f"{folder}/models", f"{folder}/csv", model_name="LR", output_format="csv")
    assert spark.read.csv(f"{folder}/csv", header=True).count() == 3000


def test_later_months_are_encoded_alike(spark, folder, store):
    save = f"{folder}/feature_model"
    main(["features", "--input", f"{folder}/scaled", "--output", f"{folder}/m1", "--files", "2", "--save-model", save])
    spark.read.parquet(f"{folder}/scaled").filter("Contract = 'Two year'").write.parquet(f"{folder}/month2")
    main(["features", "--input", f"{folder}/month2", "--output", f"{folder}/m2", "--use-model", save])
    first = spark.read.parquet(f"{folder}/m1").select("customerID", vector_to_array("features").alias("v"))
    second = spark.read.parquet(f"{folder}/m2").select("customerID", vector_to_array("features").alias("v"))
    assert second.count() > 0 and second.exceptAll(first).count() == 0


def test_evaluation_of_one_linear_model(spark, folder, store, trained):
    config = jobs.EvaluationConfig(training=TrainingConfig(fast=True, split_key="source_row", models=("LR",)))
    row = jobs.evaluation_job(spark, store, f"{folder}/models", f"{folder}/lr_only", config).first()
    assert row["best_model"] == "LR" and row["top_features"] == [] and row["best_threshold"] is not None


def test_scoring_checks_its_inputs(spark, folder, store):
    with pytest.raises(ValueError, match="parquet, csv"):
        jobs.scoring_job(spark, store, f"{folder}/models", f"{folder}/x", output_format="orc")
    with pytest.raises(FileNotFoundError, match="XX_best"):
        jobs.scoring_job(spark, store, f"{folder}/models", f"{folder}/x", model_name="XX")
    with pytest.raises(FileNotFoundError, match="nowhere"):
        jobs.scoring_job(spark, f"{folder}/nowhere", f"{folder}/models", f"{folder}/x")


def test_summary_file_is_nested_json(spark, folder, store, trained):
    config = jobs.EvaluationConfig(training=FAST, holdout_only=False)
    jobs.evaluation_job(spark, store, f"{folder}/models", f"{folder}/all", config)
    (line,) = [r["value"] for r in spark.read.text(f"{folder}/all/summary").collect()]
    summary = json.loads(line)
    assert set(summary["GBT"]) == {"auc", "f1", "accuracy", "class_0", "class_1", "confusion_matrix"}
    assert sum(map(sum, summary["GBT"]["confusion_matrix"])) == 3000
