import pytest
from pyspark.sql import functions as F

from stayrate.operators import sampling
from stayrate.operators.ordering import BLOCK, PLACE, block_of, block_starts, number_rows, place_rows
from stayrate.testbed import tables


def test_number_rows_is_the_rank(spark):
    df = spark.range(0, 1000, 1, 7).select((F.lit(999) - F.col("id")).alias("k"))
    numbered = number_rows(df, "k", blocks=5)
    assert numbered.filter("k <> row_index").count() == 0 and numbered.count() == 1000


def test_number_rows_splits_copies_of_one_row(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1500, -1).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be merged again
    try:
        numbered = number_rows(df, "k", blocks=6)
        spread = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread < 2000  # the pieces of the 1500 copies do not sit in one task
    row = numbered.agg(F.countDistinct("row_index"), F.min("row_index"), F.max("row_index")).first()
    assert tuple(row) == (3000, 0, 2999)
    assert numbered.filter("k = -1").agg(F.max("row_index")).first()[0] == 1499


def test_default_blocks_follow_the_size(spark):
    """Small tables get few blocks, whatever the session's shuffle partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(0, 5000, 1, 3).select((F.lit(4999) - F.col("id")).alias("k"))
        placed = place_rows(df, [F.col("k")])[0].withColumn(BLOCK, block_of(F.col(PLACE)))
        assert placed.agg(F.countDistinct(BLOCK)).first()[0] < 50
        assert sorted(block_starts(placed)) == sorted(r[0] for r in placed.select(BLOCK).distinct().collect())
        borders = placed.groupBy(BLOCK).agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy(BLOCK).collect()
        assert all(a["high"] < b["low"] for a, b in zip(borders, borders[1:]))
        assert number_rows(df, "k").filter("k <> row_index").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_bootstrap_is_exact_and_unique(spark, sf_dir, threshold):
    source = tables.subscribers(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        drawn = sampling.bootstrap_rows(source, 1234)
        drawn.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    row = drawn.agg(F.count("*"), F.countDistinct("customerID"), F.max("source_row")).first()
    assert row[0] == row[1] == 1234 and row[2] < 150


def test_bootstrap_does_not_depend_on_layout(spark, sf_dir):
    source = tables.subscribers(spark, sf_dir)
    a = sampling.scale_up(source.coalesce(1), 500)
    b = sampling.scale_up(source.repartition(7), 500)
    shown = ["customerID", "source_row", "gender", "Contract"]
    assert a.select(shown).exceptAll(b.select(shown)).count() == 0


def test_bootstrap_of_nothing_is_an_error(spark, sf_dir):
    with pytest.raises(ValueError, match="empty"):
        sampling.bootstrap_rows(tables.subscribers(spark, sf_dir).filter("1 = 0"), 10)


def test_noise_is_proportional_and_clipped(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("row_id"), F.lit(100.0).alias("MonthlyCharges"), F.lit(0).cast("bigint").alias("tenure")
    )
    noisy = sampling.add_noise(df, {"MonthlyCharges": 40.0, "tenure": 30.0})
    row = noisy.agg(F.avg("MonthlyCharges"), F.stddev("MonthlyCharges"), F.min("tenure"), F.max("tenure")).first()
    assert row[0] == pytest.approx(100, abs=0.1) and row[1] == pytest.approx(2.0, abs=0.1)
    assert row[2] == 0 and 3 <= row[3] <= 8
    assert dict(noisy.dtypes)["tenure"] == "bigint"


def test_split_keeps_groups_together(spark):
    df = spark.range(5000).select("id", (F.col("id") % 100).alias("source_row"))
    train, test = sampling.hash_split(df, "source_row")
    assert train.count() + test.count() == 5000
    assert train.select("source_row").intersect(test.select("source_row")).count() == 0


def test_sample_and_split_do_not_depend_on_layout(spark):
    df = spark.range(0, 5000, 1, 1)
    assert sampling.hash_sample(df, "id", 0.3).exceptAll(sampling.hash_sample(df.repartition(8), "id", 0.3)).count() == 0
    assert 1300 < sampling.hash_sample(df, "id", 0.3).count() < 1700


def test_folds_cover_everything(spark):
    counts = sampling.with_fold(spark.range(3000), "id", 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == [0, 1, 2] and min(r["count"] for r in counts) > 900


def test_null_keys_fail_or_are_told_apart(spark):
    df = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id")
    with pytest.raises(Exception, match="NULL in the key k"):
        sampling.hash_sample(df, "k", 0.1).count()
    train, test = sampling.hash_split(df, "k", null_keys=["id"])
    assert 700 < train.count() < 900 and train.count() + test.count() == 1000
    assert 50 < sampling.hash_sample(df, "k", 0.1, null_keys=["id"]).count() < 150
