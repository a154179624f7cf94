"""Exact ROC and precision-recall curves, computed on the executors.

Scores are first reduced to one row per distinct score, so a score shared by a third of all rows
costs no more than any other and ties always count together. The distinct scores then fall into
buckets, whose borders are a function of the score alone: nothing is sampled, and nothing has to be written to
keep the borders. Running counts are a window within a bucket plus the totals of the buckets above it.
A bucket of more than ``BUCKET_ROWS`` distinct scores is cut again, evenly between its least and largest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.columns import nan_to_null

#: Buckets between 0 and 1; a few more take what lies outside.
BUCKETS = 4096
BUCKET_ROWS = 1_000_000
_CELL = ["_bucket", "_part"]

# Products of two row counts pass 2**63 beyond three billion rows.
_WIDE = "decimal(38,0)"


def score_counts(scored: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*by, nan_to_null(F.col("score").cast("double")).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def score_bucket(score: Column, buckets: int = BUCKETS) -> Column:
    """A whole number that never falls as the score rises; a missing score comes first of all."""
    within = F.floor(score * buckets).cast("int")
    number = F.when(score < 0, F.when(score == float("-inf"), -2).otherwise(-1)).when(score < 1, within)
    return F.when(score.isNull(), -3).otherwise(number.when(score == float("inf"), buckets + 1).otherwise(buckets))


def bucket_sizes(placed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores, positives and negatives of each bucket, and half its least score and its width."""
    # Halves, since the width of a bucket that reaches both ends of the doubles is not a double.
    half = F.col("score") / 2
    return placed.groupBy(*by, "_bucket").agg(
        F.count("*").alias("_n"), F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.min(half).alias("_low"), (F.max(half) - F.min(half)).alias("_width")
    )


def parted(placed: DataFrame, sizes: DataFrame, *, by: Sequence[str] = (), limit: int = BUCKET_ROWS, how: str = "left") -> DataFrame:
    """``placed`` with ``_part``: 0, or where its bucket is over the limit which even piece of it.

    Only buckets over the limit are broadcast. There are at most as many as the distinct scores divided by
    the limit, and as groups times buckets; mostly there is none.
    """
    pieces = F.ceil(F.col("_n") / limit * 2).cast("int")
    over = sizes.filter(F.col("_n") > limit).select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_bucket").alias("_over"), pieces.alias("_pieces"), "_low", "_width")
    met = F.col("_bucket") == F.col("_over")
    for c in by:
        met = met & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    part = F.floor((F.col("score") / 2 - F.col("_low")) / F.nullif(F.col("_width"), F.lit(0.0)) * F.col("_pieces")).cast("int")
    return placed.join(F.broadcast(over), met, how).select(*placed.columns, F.coalesce(part, F.lit(0)).alias("_part"))


def ranked_counts(
    scored: DataFrame, *, by: Sequence[str] = (), buckets: int = BUCKETS, limit: int = BUCKET_ROWS
) -> DataFrame:
    """Distinct scores with running and total counts, highest score first.

    Columns: ``by``, score, pos, neg, tp, fp (up to and including the score), total_pos, total_neg.
    A missing score ranks last.
    """
    by = list(by)
    placed = score_counts(scored, by=by).withColumn("_bucket", score_bucket(F.col("score"), buckets))
    sizes = bucket_sizes(placed, by)
    cells = parted(placed, sizes, by=by, limit=limit)

    # One row per group and bucket. Pieces are counted where a bucket has them; else the plan drops that branch as it runs.
    pieces = parted(placed, sizes, by=by, limit=limit, how="inner").groupBy(*by, *_CELL).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    whole = sizes.filter(F.col("_n") <= limit).select(*by, "_bucket", F.lit(0).alias("_part"), "_pos", "_neg")
    falling = [F.desc(c) for c in _CELL]
    above = Window.partitionBy(*by).orderBy(*falling).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    offsets = whole.unionByName(pieces).select(
        *by,
        *_CELL,
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_pos_before"),
        F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_neg_before"),
        F.sum("_pos").over(everything).alias("total_pos"),
        F.sum("_neg").over(everything).alias("total_neg"),
    )

    # The hint keeps the planner from broadcasting the distinct scores, whose size it cannot know.
    # Join and window share one partitioning: the scores shuffle once here.
    in_cell = Window.partitionBy(*by, *_CELL).orderBy(F.col("score").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return cells.join(offsets.hint("shuffle_hash"), [*by, *_CELL]).select(
        *by,
        "score",
        "pos",
        "neg",
        (F.sum("pos").over(in_cell) + F.col("_pos_before")).alias("tp"),
        (F.sum("neg").over(in_cell) + F.col("_neg_before")).alias("fp"),
        "total_pos",
        "total_neg",
    )


def _at_least_one(name: str):
    return F.greatest(F.col(name), F.lit(1))


def roc_points(ranked: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score, between (0, 0) at score +inf and (1, 1) at score -inf."""
    points = ranked.select(
        *by,
        "score",
        "tp",
        "fp",
        (F.col("tp") / _at_least_one("total_pos")).alias("tpr"),
        (F.col("fp") / _at_least_one("total_neg")).alias("fpr"),
    )
    totals = ranked.groupBy(*by).agg(F.max("total_pos").alias("p"), F.max("total_neg").alias("n"))
    zero = F.lit(0).cast("bigint")
    ends = totals.filter("p IS NOT NULL").select(
        *by,
        F.inline(
            F.array(
                _point(F.lit(float("inf")), zero, zero, 0.0),
                _point(F.lit(float("-inf")), F.col("p"), F.col("n"), 1.0),
            )
        ),
    )
    return points.unionByName(ends)


def _point(score, tp, fp, rate: float):
    return F.struct(
        score.alias("score"), tp.alias("tp"), fp.alias("fp"), F.lit(rate).alias("tpr"), F.lit(rate).alias("fpr")
    )


def pr_points(ranked: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Recall and precision per distinct score, after the start (recall 0, precision 1) at +inf."""
    points = ranked.select(
        *by,
        "score",
        (F.col("tp") / _at_least_one("total_pos")).alias("recall"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision"),
    )
    start = (
        ranked.groupBy(*by)
        .agg(F.count("*").alias("_n"))
        .filter("_n > 0")
        .select(*by, F.lit(float("inf")).alias("score"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    )
    return points.unionByName(start)


def curve_areas(ranked: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Areas under both curves: one aggregation over the distinct scores.

    ``roc_auc`` is exact: its numerator is a whole number. ``pr_auc_trapezoid`` joins the points
    linearly; ``average_precision`` is the step sum.
    """
    pos, neg = F.col("pos"), F.col("neg")
    tp_before, fp_before = F.col("tp") - pos, F.col("fp") - neg
    twice_area = neg.cast(_WIDE) * (2 * tp_before + pos).cast(_WIDE)
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    precision_before = F.when(tp_before + fp_before == 0, 1.0).otherwise(
        tp_before / F.greatest(tp_before + fp_before, F.lit(1))
    )
    positives, negatives = (F.max(c).cast("double") for c in ("total_pos", "total_neg"))
    return ranked.groupBy(*by).agg(
        F.max("total_pos").alias("positives"),
        F.max("total_neg").alias("negatives"),
        # Without negatives the curve is the left edge up to (0, 1) and the top edge to (1, 1).
        F.when(negatives == 0, F.when(positives > 0, 1.0).otherwise(0.5))
        .otherwise(F.sum(twice_area.cast(_WIDE)).cast("double") / (2.0 * F.greatest(positives, F.lit(1.0)) * negatives))
        .alias("roc_auc"),
        (F.sum(pos * (precision + precision_before)) / (2.0 * F.greatest(positives, F.lit(1.0)))).alias("pr_auc_trapezoid"),
        (F.sum(pos * precision) / F.greatest(positives, F.lit(1.0))).alias("average_precision"),
    )
