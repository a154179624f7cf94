"""Subscriber, raw, planted-label and scored tables derived from ``customer`` and ``orders``.

There is no public subscriber data at hand, so orders stand in for it: every column is a rule
over whole tables and grows with them. The rules are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.schemas import SUBSCRIBER_TYPES

SNAPSHOT = "2000-10-01"
_NO_INTERNET = "No internet service"
_LCG_MODULUS = 2147483648


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_profile(orders: DataFrame) -> DataFrame:
    """One row per customer: order counts and spend before the snapshot, activity after it."""
    before = F.col("o_orderdate") < F.lit(SNAPSHOT).cast("timestamp_ntz")

    def count(condition: Column) -> Column:
        return F.count_if(before & condition)

    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return (
        orders.groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("n"),
            *(count(F.col("o_orderpriority") == p).alias(f"p{i}") for i, p in enumerate(priorities, 1)),
            count(F.col("o_orderstatus") == "P").alias("s_p"),
            count(F.col("o_orderstatus") == "F").alias("s_f"),
            # Decimal sums do not depend on row order.
            F.sum(F.when(before, F.col("o_totalprice").cast("decimal(18,2)"))).alias("tot"),
            F.count_if(~before).alias("n_after"),
        )
        .filter("n > 0")
    )


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def _internet_service(condition: Column) -> Column:
    return F.when(F.col("p2") == 0, _NO_INTERNET).otherwise(_yes_no(condition))


def _keyed_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    profile = _order_profile(table(spark, sf_dir, "orders"))
    joined = customer.join(profile, customer["c_custkey"] == profile["o_custkey"])
    k, p1, p2 = F.col("c_custkey"), F.col("p1"), F.col("p2")
    p3, p4, p5 = F.col("p3"), F.col("p4"), F.col("p5")
    total = F.col("tot").cast("double")
    payment = F.array(
        *map(F.lit, ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"])
    )
    columns = {
        "customerID": F.col("c_name"),
        "gender": F.when(k % 2 == 0, "Female").otherwise("Male"),
        "SeniorCitizen": F.when(F.col("c_acctbal") < 0, 1).otherwise(0),
        "Partner": _yes_no(F.col("s_f") >= 3),
        "Dependents": _yes_no(F.col("s_f") >= 5),
        "tenure": k % 73,
        "PhoneService": _yes_no(p1 >= 1),
        "MultipleLines": F.when(p1 == 0, "No phone service").otherwise(_yes_no(p1 >= 3)),
        "InternetService": F.when(p2 == 0, "No").when(p2 >= 3, "Fiber optic").otherwise("DSL"),
        "OnlineSecurity": _internet_service(p3 >= 2),
        "OnlineBackup": _internet_service(p3 >= 3),
        "DeviceProtection": _internet_service(p4 >= 2),
        "TechSupport": _internet_service(p4 >= 3),
        "StreamingTV": _internet_service(p5 >= 2),
        "StreamingMovies": _internet_service(p5 >= 3),
        "Contract": F.when(F.col("c_mktsegment") == "HOUSEHOLD", "One year")
        .when(F.col("c_mktsegment") == "MACHINERY", "Two year")
        .otherwise("Month-to-month"),
        "PaperlessBilling": _yes_no(F.col("s_p") >= 3),
        "PaymentMethod": payment[F.col("c_nationkey") % 4],
        "MonthlyCharges": total / F.col("n"),
        "TotalCharges": total,
        "Churn": F.when(F.col("n_after") == 0, 1).otherwise(0),
    }
    typed = [columns[name].cast(kind).alias(name) for name, kind in SUBSCRIBER_TYPES.items()]
    return joined.select(*typed, F.col("tot").alias("_total"), k.alias("_k"), "c_mktsegment")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed 21-column table."""
    return _keyed_subscribers(spark, sf_dir).select(*SUBSCRIBER_TYPES)


def raw_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table: TotalCharges as text with blanks and junk, Churn as Yes/No/other."""
    text = F.col("_total").cast("string")
    k = F.col("_k")
    messy = (
        F.when(k % 7 == 0, "")
        .when(k % 7 == 1, " ")
        .when(k % 7 == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(k % 7 == 3, "NaN")
        .when(k % 7 == 4, "abc")
        .otherwise(text)
    )
    churn = F.when(k % 11 == 0, "maybe").when(F.col("Churn") == 1, "Yes").otherwise("No")
    keyed = _keyed_subscribers(spark, sf_dir)
    return keyed.withColumns({"TotalCharges": messy, "Churn": churn}).select(*SUBSCRIBER_TYPES)


def _planted(keyed: DataFrame, k: Column) -> DataFrame:
    month_to_month = ~F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY")
    p = F.when(month_to_month & (k % 73 < 24), 0.55).when(month_to_month, 0.25).otherwise(0.08)

    def uniform(factor: int, increment: int) -> Column:
        draw = (k * F.lit(factor).cast("bigint") + increment) % F.lit(_LCG_MODULUS).cast("bigint")
        return draw.cast("double") / F.lit(float(_LCG_MODULUS))

    u, v = uniform(1103515245, 12345), uniform(22695477, 1)
    return keyed.withColumns(
        {
            "label": F.when(u < p, 1.0).otherwise(0.0),
            "score": (p + v) / 2,
            "score_coarse": F.floor((p + v) * 10).cast("double") / 20,
        }
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: a label, a nearly continuous score and a score with heavy ties."""
    keyed = table(spark, sf_dir, "customer")
    return _planted(keyed, F.col("c_custkey")).select(
        F.col("c_name").alias("customerID"), "label", "score", "score_coarse"
    )


def coarse_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("customerID", "label", F.col("score_coarse").alias("score"))


def planted_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers whose Churn can be learned from contract and tenure."""
    planted = _planted(_keyed_subscribers(spark, sf_dir), F.col("_k"))
    return planted.withColumn("Churn", F.col("label").cast("bigint")).select(*SUBSCRIBER_TYPES)


def gappy_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers with missing and negative values, for the null and range semantics."""
    k, tenure = F.col("_k"), F.col("tenure")
    gaps = {
        "tenure": F.when(k % 17 == 0, None).when(k % 23 == 0, -tenure - 1).otherwise(tenure),
        "MonthlyCharges": F.when(k % 29 == 0, -F.col("MonthlyCharges")).otherwise(F.col("MonthlyCharges")),
        "TechSupport": F.when(k % 19 != 0, F.col("TechSupport")),
        "Contract": F.when(k % 13 != 0, F.col("Contract")),
        "Churn": F.when(k % 31 != 0, F.col("Churn")),
    }
    return _keyed_subscribers(spark, sf_dir).withColumns(gaps).select(*SUBSCRIBER_TYPES)


def stacked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, label, prediction, score) for three stand-in models, two of which tie."""
    base = scored(spark, sf_dir)

    def output(model: str, score: str) -> Column:
        return F.struct(
            F.lit(model).alias("model"),
            F.when(F.col(score) >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
            F.col(score).alias("score"),
        )

    models = F.array(output("LR", "score_coarse"), output("RF", "score"), output("GBT", "score"))
    return base.select("customerID", "label", F.inline(models))
