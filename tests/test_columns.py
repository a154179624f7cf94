"""Scalar expressions on hand-written edge rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stayrate.functions import columns as C
from stayrate.functions.hashing import hash_bigint, hash_fraction_below, hash_normal


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_coerce_number(spark):
    values = ["29.85", " 29.85 ", "", " ", "abc", "NaN", None, "1e3", "1.5d", "-4"]
    assert apply(spark, values, "string", C.coerce_number) == [29.85, 29.85, 0, 0, 0, 0, 0, 1000, 0, -4]


def test_coerce_number_of_a_number(spark):
    assert apply(spark, [1.25, float("nan"), None], "double", C.coerce_number) == [1.25, 0.0, 0.0]


def test_yes_no_flag(spark):
    assert apply(spark, ["Yes", "No", "maybe", "yes", None], "string", C.yes_no_flag) == [1, 0, None, None, None]


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("string", ["Yes", "No", "1", "0", None, "maybe"], [1, 0, 1, 0, 0, 0]),
        ("bigint", [1, 0, 2, None], [1, 0, 0, 0]),
    ],
)
def test_binarize_label(spark, kind, values, expected):
    assert apply(spark, values, kind, C.binarize_label) == expected


def test_numeric_label(spark):
    values = ["Yes", "No", "1", "0.0", None, "maybe"]
    assert apply(spark, values, "string", C.numeric_label) == [1, 0, 1, 0, None, None]
    assert apply(spark, [1, 0, None], "bigint", C.numeric_label) == [1, 0, None]


def test_label_status_and_strict_label(spark):
    values = ["Yes", "No", "1", "0.0", " 1 ", None, "maybe", "", "2", "NaN"]
    assert apply(spark, values, "string", C.label_status) == ["used"] * 5 + ["missing"] + ["quarantined"] * 4
    assert apply(spark, values, "string", C.strict_label) == [1, 0, 1, 0, 1, None, None, None, None, None]
    assert apply(spark, [1, 0, 2, None], "bigint", C.label_status) == ["used", "used", "quarantined", "missing"]


def test_strict_label_names_the_value(spark):
    assert apply(spark, ["Yes", None], "string", lambda c: C.numeric_label(c, strict=True)) == [1, None]
    with pytest.raises(PySparkException, match="maybe"):
        apply(spark, ["maybe"], "string", lambda c: C.numeric_label(c, strict=True))


def test_tenure_bucket_edges(spark):
    values = [-1, 0, 12, 13, 24, 25, 48, 49, None]
    expected = ["loyal", "new", "new", "growing", "growing", "mature", "mature", "loyal", "loyal"]
    assert apply(spark, values, "bigint", C.tenure_bucket) == expected


def test_charge_per_month_guards_zero_tenure(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 3), (10.0, None), (None, 3)], "t double, n bigint")
    rows = df.select(C.charge_per_month(F.col("t"), F.col("n"))).collect()
    assert [r[0] for r in rows] == [10.0, 3.33, None, None]


def test_complaint_proxy(spark):
    rows = [("No", "No"), ("No", "Yes"), ("No internet service", "No internet service"), (None, "No"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(C.complaint_proxy(F.col("a"), F.col("b"))).collect()] == [1, 0, 0, 0, 0]


def test_service_count(spark):
    rows = [("Yes", "1", 1), ("No", "No phone service", 0), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c bigint")
    assert [r[0] for r in df.select(C.service_count(["a", "b", "c"])).collect()] == [3, 0, 0]


def test_clip_keeps_null(spark):
    assert apply(spark, [-1.0, 0.0, None, 2.5], "double", C.clip_lower) == [0.0, 0.0, None, 2.5]


def test_round_half_even(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5, 2.4, None]
    assert apply(spark, values, "double", C.round_half_even) == [0, 2, 2, 0, -2, 2, None]


def test_subscriber_id(spark):
    expected = ["CUST-0000-000000", "CUST-0000-499999", "CUST-0001-000000", "CUST-0003-000007"]
    values = [0, 499_999, 500_000, 1_500_007]
    assert apply(spark, values, "bigint", lambda c: C.subscriber_id(c, 500_000)) == expected


def test_threshold_is_inclusive(spark):
    assert apply(spark, [0.3, 0.29, None, float("nan")], "double", lambda c: C.at_threshold(c, 0.3)) == [1, 0, 0, 0]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(C.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_hash_draws(spark):
    df = spark.range(20_000)
    row = df.agg(
        F.avg(hash_fraction_below("sample", 42, F.col("id"), 0.1).cast("int")).alias("share"),
        F.avg(hash_normal("n", 42, F.col("id"))).alias("mean"),
        F.stddev(hash_normal("n", 42, F.col("id"))).alias("sd"),
        F.corr(
            hash_fraction_below("sample", 42, F.col("id"), 0.5).cast("int"),
            hash_fraction_below("split", 42, F.col("id"), 0.5).cast("int"),
        ).alias("corr"),
        F.count_if(hash_bigint("sample", 42, F.col("id")).isNull()).alias("nulls"),
    ).first()
    assert abs(row["share"] - 0.1) < 0.01
    assert abs(row["mean"]) < 0.03 and abs(row["sd"] - 1) < 0.03
    assert abs(row["corr"]) < 0.03  # a sample must not predict the split
    assert row["nulls"] == 0


def test_hash_of_null_key_is_kept(spark):
    assert apply(spark, [None], "string", lambda c: hash_bigint("split", 42, c)) != [None]
