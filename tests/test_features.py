from pyspark.sql import functions as F

from stayrate.operators import features
from stayrate.operators.bounded import fixed, join_grouped
from stayrate.testbed import tables


def test_null_contract_drops_out(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 5.0), (None, 7.0)], "Contract string, MonthlyCharges double")
    rows = features.add_contract_average(df).orderBy("MonthlyCharges").collect()
    assert [(r["Contract"], r["avg_charge_by_contract"]) for r in rows] == [("b", 5.0), ("a", 15.0), ("a", 15.0)]


def test_averages_can_come_from_training_rows(spark):
    train = spark.createDataFrame([("a", 10.0)], "Contract string, MonthlyCharges double")
    test = spark.createDataFrame([("a", 90.0)], "Contract string, MonthlyCharges double")
    joined = features.add_contract_average(test, features.contract_averages(train))
    assert joined.first()["avg_charge_by_contract"] == 10.0


def test_unknown_contracts_get_the_overall_average(spark):
    test = spark.createDataFrame([("a", 90.0), ("new", 1.0), (None, 2.0)], "Contract string, MonthlyCharges double")
    averages = spark.createDataFrame([("a", 10.0)], "Contract string, avg_charge_by_contract double")
    joined = features.add_contract_average(test, averages, overall=7.5)
    assert sorted(tuple(r) for r in joined.collect()) == [("a", 90.0, 10.0), ("new", 1.0, 7.5)]


def test_many_groups_with_a_hot_key_join_completely(spark):
    # One key holds a third of all rows; 12,000 groups.
    facts = spark.range(18_000).select("id", F.when(F.col("id") < 6_000, 0).otherwise(F.col("id")).alias("key"))
    groups = facts.groupBy("key").agg(F.count("*").alias("n"))
    for grouped in (groups, fixed(groups)):
        joined = join_grouped(facts, grouped, "key")
        row = joined.agg(F.count("*"), F.sum("n")).first()
        assert tuple(row) == (18_000, 6_000 * 6_000 + 12_000)


def test_same_result_for_any_partitioning(spark, sf_dir):
    subscribers = tables.gappy_subscribers(spark, sf_dir)
    one = features.engineer_features(subscribers.coalesce(1))
    many = features.engineer_features(subscribers.repartition(8))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()
