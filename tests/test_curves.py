"""Distributed curves against brute force on the driver."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from stayrate.operators import curves
from stayrate.sources import storage

SCHEMA = "score double, label double"


def brute_force(rows):
    points, tp, fp = [], 0, 0
    for score in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(1 for s, y in rows if s == score and y == 1)
        fp += sum(1 for s, y in rows if s == score and y == 0)
        points.append((score, tp, fp))
    return points


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def ranked(spark, rows, buckets=4, **limit):
    return curves.ranked_counts(spark.createDataFrame(rows, SCHEMA), buckets=buckets, **limit)


def auc(spark, rows):
    return curves.curve_areas(ranked(spark, rows)).first()["roc_auc"]


@pytest.mark.parametrize("distinct", [3, 50, 10_000])
def test_ranked_counts_match_brute_force(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(distinct) / distinct, float(rng.random() < 0.3)) for _ in range(400)]
    found = ranked(spark, rows, buckets=5).orderBy("score", ascending=False).collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in found] == brute_force(rows)
    assert auc(spark, rows) == pytest.approx(brute_auc(rows), abs=1e-12)


def test_one_score_holds_a_third_of_the_rows(spark):
    rng = random.Random(7)
    rows = [(0.5, float(i % 2)) for i in range(200)] + [(rng.random(), float(rng.random() < 0.4)) for _ in range(400)]
    found = ranked(spark, rows, buckets=8).orderBy("score", ascending=False).collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in found] == brute_force(rows)


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(0.5, 1.0), (0.5, 0.0), (0.5, 1.0), (0.5, 0.0)], 0.5),
        ([(0.9, 1.0), (0.8, 1.0), (0.2, 0.0)], 1.0),
        ([(0.1, 1.0), (0.8, 0.0), (0.9, 0.0)], 0.0),
        ([(0.3, 1.0), (0.2, 1.0)], 1.0),
        ([(0.3, 0.0), (0.2, 0.0)], 0.0),
    ],
    ids=["all tied", "perfect", "inverted", "only positives", "only negatives"],
)
def test_auc_edges(spark, rows, expected):
    assert auc(spark, rows) == expected


def test_empty_input(spark):
    empty = ranked(spark, [])
    assert curves.curve_areas(empty).first()["roc_auc"] is None
    assert curves.roc_points(empty).count() == 0 and curves.pr_points(empty).count() == 0


def test_missing_scores_rank_last_and_count(spark):
    rows = [(0.9, 1.0), (None, 0.0), (float("nan"), 1.0), (0.1, 0.0)]
    found = ranked(spark, rows).orderBy("tp", "fp").collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in found] == [(0.9, 1, 0), (0.1, 1, 1), (None, 2, 2)]


def test_roc_and_pr_points(spark):
    frame = ranked(spark, [(0.9, 1.0), (0.8, 0.0), (0.7, 1.0), (0.1, 0.0)])
    roc = [(r["fpr"], r["tpr"]) for r in curves.roc_points(frame).orderBy("score", ascending=False).collect()]
    assert roc == [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 1), (1, 1), (1, 1)]
    pr = [(r["recall"], r["precision"]) for r in curves.pr_points(frame).orderBy("score", ascending=False).collect()]
    assert pr == [(0, 1), (0.5, 1), (0.5, 0.5), (1, 2 / 3), (1, 0.5)]
    areas = curves.curve_areas(frame).first()
    assert areas["pr_auc_trapezoid"] == pytest.approx(0.5 * 1 + 0.5 * (0.5 + 2 / 3) / 2)
    assert areas["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_groups_are_separate(spark):
    rows = [("a", 0.9, 1.0), ("a", 0.1, 0.0), ("b", 0.9, 0.0), ("b", 0.1, 1.0)]
    df = spark.createDataFrame(rows, "model string, score double, label double")
    areas = curves.curve_areas(curves.ranked_counts(df, by=["model"], buckets=3, limit=1), by=["model"])
    assert {r["model"]: r["roc_auc"] for r in areas.collect()} == {"a": 1.0, "b": 0.0}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.integers(0, 12).map(lambda i: i / 12), st.sampled_from([0.0, 1.0])), min_size=2, max_size=60),
    buckets=st.integers(1, 6),
    limit=st.sampled_from([1, 3, 1000]),
)
def test_curve_properties(spark, rows, buckets, limit):
    rows = [*rows, (0.25, 1.0), (0.75, 0.0)]
    frame = ranked(spark, rows, buckets=buckets, limit=limit)
    found = frame.orderBy("score", ascending=False).collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in found] == brute_force(rows)
    area = curves.curve_areas(frame).first()["roc_auc"]
    assert area == pytest.approx(brute_auc(rows))
    assert area + auc(spark, [(1 - s, y) for s, y in rows]) == pytest.approx(1.0)


@pytest.mark.parametrize("limit", [1, 5, 10**6])
def test_scores_of_any_size(spark, limit):
    """Margins, infinities and the ends of the doubles are as good as probabilities; a missing score ranks last."""
    rng = random.Random(3)
    edges = [0.0, -0.0, 1.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), 0.9999999999999999]
    values = edges * 3 + [rng.gauss(0, 3) for _ in range(150)] + [0.3 + i * 1e-12 for i in range(60)]
    rows = [(v, float(rng.random() < 0.4)) for v in values]
    found = ranked(spark, rows, buckets=16, limit=limit).orderBy("score", ascending=False).collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in found] == brute_force(rows)
    missing = ranked(spark, [*rows, (None, 1.0), (float("nan"), 1.0)], limit=limit).filter("score IS NULL").first()
    assert (missing["pos"], missing["tp"]) == (2, sum(y == 1 for _, y in rows) + 2)


def test_a_full_bucket_is_cut_again(spark):
    narrow = spark.range(20_000).select((F.lit(0.5) + F.col("id") * 1e-9).alias("score"), (F.col("id") % 2).cast("double").alias("label"))
    placed = curves.score_counts(narrow).withColumn("_bucket", curves.score_bucket(F.col("score")))
    cells = curves.parted(placed, curves.bucket_sizes(placed), limit=1000).groupBy("_bucket", "_part").count().collect()
    assert len({r["_bucket"] for r in cells}) == 1 and max(r["count"] for r in cells) <= 1000
    found = curves.ranked_counts(narrow, limit=1000)
    assert found.filter("tp + fp <> 20000 - round((score - 0.5) * 1e9)").count() == 0


def test_no_sample_and_no_written_table(spark, monkeypatch):
    monkeypatch.setattr(storage, "scratch_path", None)  # writing one would fail
    rows = spark.range(1000).selectExpr("id / 1000 AS score", "double(id % 2) AS label")
    plan = curves.ranked_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "FileScan" not in plan
    assert curves.curve_areas(curves.ranked_counts(rows)).first()["positives"] == 500
