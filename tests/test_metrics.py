import pytest

from stayrate.operators import metrics

# Published figures of three models: tn, fp, fn, tp -> accuracy, weighted F1, precision/recall/F1 per class.
GOLDEN = {
    "LR": ((132410, 14138, 24708, 28500), (0.8055, 0.7982), (0.8427, 0.9035, 0.8721), (0.6684, 0.5356, 0.5947)),
    "RF": ((134975, 11573, 27477, 25731), (0.8045, 0.7924), (0.8309, 0.9210, 0.8736), (0.6898, 0.4836, 0.5686)),
    "GBT": ((133411, 13137, 22718, 30490), (0.8205, 0.8145), (0.8545, 0.9104, 0.8815), (0.6989, 0.5730, 0.6297)),
}


def test_published_metrics(spark):
    matrices = [(model, *cells) for model, (cells, *_) in GOLDEN.items()]
    frame = spark.createDataFrame(matrices, "model string, tn bigint, fp bigint, fn bigint, tp bigint")
    for row in metrics.class_metrics(frame).collect():
        _, overall, negative, positive = GOLDEN[row["model"]]
        assert (round(row["accuracy"], 4), round(row["weighted_f1"], 4)) == overall
        assert tuple(round(row[f"{m}_0"], 4) for m in ("precision", "recall", "f1")) == negative
        assert tuple(round(row[f"{m}_1"], 4) for m in ("precision", "recall", "f1")) == positive


def test_weighted_f1_equals_spark(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(float(i % 3 == 0), float(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = metrics.class_metrics(metrics.confusion_matrix(df)).first()
    assert found["weighted_f1"] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(df))
    assert found["accuracy"] == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df))


def test_empty_cells_are_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    row = metrics.class_metrics(metrics.confusion_matrix(df)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 0)
    assert row["precision_1"] == row["recall_1"] == row["f1_1"] == 0.0


def test_thresholds_are_clean_decimals():
    assert metrics.THRESHOLDS[0] == 0.2 and metrics.THRESHOLDS[4] == 0.4 and metrics.THRESHOLDS[-1] == 0.8
    assert len(metrics.THRESHOLDS) == 13


def test_sweep_properties(spark):
    rows = [(i / 100, float(i % 3 == 0)) for i in range(101)] + [(None, 1.0), (float("nan"), 0.0)]
    sweep = metrics.threshold_sweep(spark.createDataFrame(rows, "score double, label double")).orderBy("threshold").collect()
    assert [r["threshold"] for r in sweep] == metrics.THRESHOLDS
    assert {r["tp"] + r["fn"] for r in sweep} == {35} and {r["fp"] + r["tn"] for r in sweep} == {68}
    recalls = [r["recall"] for r in sweep]
    assert recalls == sorted(recalls, reverse=True)


def test_score_on_a_threshold_counts(spark):
    df = spark.createDataFrame([(0.3, 1.0), (0.8, 0.0)], "score double, label double")
    rows = {r["threshold"]: r for r in metrics.threshold_sweep(df).collect()}
    assert rows[0.3]["tp"] == 1 and rows[0.35]["tp"] == 0 and rows[0.8]["fp"] == 1


def test_lowest_threshold_wins_a_tie(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.1, 0.0)], "score double, label double")
    best = metrics.best_threshold(metrics.threshold_sweep(df)).first()
    assert (best["threshold"], best["f1"]) == (0.2, 1.0)


def test_first_model_wins_a_tie(spark):
    df = spark.createDataFrame([("GBT", 0.8), ("RF", 0.8), ("LR", 0.7), ("other", 0.8)], "model string, auc double")
    assert metrics.best_model(df).first()["model"] == "RF"
