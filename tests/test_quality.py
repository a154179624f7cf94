import pytest
from pyspark.sql import functions as F

from stayrate.operators import quality
from stayrate.schemas import SUBSCRIBER_TYPES, subscriber_schema
from stayrate.testbed import tables


def test_schema_contract_holds(spark):
    assert quality.schema_issues(spark.createDataFrame([], subscriber_schema())).count() == 0


def test_schema_issues(spark):
    df = spark.createDataFrame([], subscriber_schema()).drop("gender").withColumn("tenure", F.lit("x")).withColumn("extra", F.lit(1))
    issues = {(r["issue"], r["column"], r["expected"], r["actual"]) for r in quality.schema_issues(df).collect()}
    assert issues == {
        ("missing", "gender", "string", None),
        ("mistyped", "tenure", "bigint", "string"),
        ("unexpected", "extra", None, "int"),
    }


def test_report_runs_two_aggregations(spark, sf_dir):
    report = quality.quality_report(tables.subscribers(spark, sf_dir), target_rows=150)
    assert report._jdf.queryExecution().executedPlan().toString().count("orders.parquet") == 2
    rows = {(r["check"], r["column"]): r for r in report.collect()}
    assert rows["row_count", "*"]["value"] == 150 and rows["row_count", "*"]["ok"]
    assert all(rows["null_count", c]["ok"] for c in SUBSCRIBER_TYPES)
    assert rows["class_count", "Churn=0"]["value"] + rows["class_count", "Churn=1"]["value"] == 150
    assert rows["min", "tenure"]["value"] == 0
    assert len(rows) == 1 + 21 + 6 + 2 + 4


def test_class_distribution_counts_null_class(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "Churn bigint")
    assert [tuple(r) for r in quality.class_distribution(df).collect()] == [(None, 1, 25.0), (0, 2, 50.0), (1, 1, 25.0)]


def test_partition_profile_measures_skew(spark):
    even = quality.partition_profile(spark.range(0, 1000, 1, 4)).first()
    assert (even["partitions"], even["rows"], even["skew"]) == (4, 1000, 1.0)
    lopsided = spark.range(0, 100, 1, 2).filter("id < 45 OR id >= 95")
    assert quality.partition_profile(lopsided).first()["skew"] == pytest.approx(1.8)


def test_written_check_rejects_null_label(spark):
    df = spark.createDataFrame([("v", 1.0), ("v", None)], "features string, label double")
    with pytest.raises(ValueError, match="1 null labels"):
        quality.check_written(df)


def test_row_count_check(spark):
    assert quality.check_row_count(spark.range(5), 5) == 5
    with pytest.raises(ValueError, match="expected 6 rows, found 5"):
        quality.check_row_count(spark.range(5), 6)
