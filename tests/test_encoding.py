import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayrate.operators import dictionary, encoding, vectors
from stayrate.operators.features import add_tenure_bucket, engineer_features
from stayrate.operators.importance import feature_names
from stayrate.schemas import CATEGORICAL_COLUMNS, METADATA_COLUMNS
from stayrate.testbed import tables


def test_same_labels_as_spark(spark, sf_dir):
    df = tables.gappy_subscribers(spark, sf_dir).transform(add_tenure_bucket)
    expected = StringIndexer(inputCols=CATEGORICAL_COLUMNS, outputCols=[f"{c}_x" for c in CATEGORICAL_COLUMNS], handleInvalid="keep").fit(df)
    assert [list(m.labels) for m in encoding.fit_indexers(df)] == [list(labels) for labels in expected.labelsArray]


def test_same_vectors_as_spark(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    indexed = StringIndexer(inputCol="v", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    expected = OneHotEncoder(inputCol="i", outputCol="o").fit(indexed).transform(indexed)
    found = encoding.fit_encoder(df, ["v"]).transform(df)
    assert [r["v_ohe"] for r in found.collect()] == [r["o"] for r in expected.collect()]


def test_unseen_and_null_categories_are_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    rows = encoding.fit_encoder(train, ["v"]).transform(new).select(vector_to_array("v_ohe")).collect()
    assert [r[0] for r in rows] == [[1, 0], [0, 1], [0, 0], [0, 0]]


def test_identifier_as_category_is_refused(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="identifier"):
        encoding.fit_indexers(df, ["v"], max_categories=20)


def test_many_categories_in_one_column(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("v"), F.lit("x").alias("w"))
    indices = encoding.category_indices(df, ["v", "w"])
    row = indices.filter("column = 'v'").agg(F.count("*"), F.min("index"), F.max("index"), F.countDistinct("index")).first()
    assert tuple(row) == (20_000, 0.0, 19_999.0, 20_000)
    assert [tuple(r) for r in indices.filter("column = 'w'").collect()] == [("w", "x", 20_000, 0.0)]


def test_bound_is_per_column(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("v"), (F.col("id") % 2).cast("string").alias("w"))
    assert encoding.category_indices(df, ["v", "w"], max_categories=30).count() == 32
    with pytest.raises(ValueError, match=r"v \(30\)"):
        encoding.category_indices(df, ["v", "w"], max_categories=29)


def test_unseen_contract_keeps_its_rows(spark, sf_dir, tmp_path):
    subscribers = tables.subscribers(spark, sf_dir)
    model = encoding.fit_features(subscribers.filter("Contract <> 'Two year'"))
    model.save(str(tmp_path / "model"))
    again = encoding.FeatureModel.load(spark, str(tmp_path / "model"))
    assert model.transform(subscribers).count() == again.transform(subscribers).count() == subscribers.count()
    assert again.overall == model.overall


def test_store_layout_and_names_survive_parquet(spark, sf_dir, tmp_path):
    subscribers = tables.gappy_subscribers(spark, sf_dir)
    encoding.fit_features(subscribers).transform(subscribers).write.parquet(str(tmp_path / "store"))
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.columns == ["features", "label", *METADATA_COLUMNS, "label_status"]
    names = feature_names(stored)
    assert [names[i] for i in range(3)] == ["SeniorCitizen", "tenure", "MonthlyCharges"]
    assert names[9].startswith("gender_ohe_") and "Contract_ohe_Month-to-month" in names.values()
    # Rows without a contract or a tenure are gone, all others are kept.
    assert stored.count() == subscribers.filter("Contract IS NOT NULL AND tenure IS NOT NULL").count()


def test_feature_model_round_trip(spark, sf_dir, tmp_path):
    subscribers = tables.subscribers(spark, sf_dir)
    model = encoding.fit_features(subscribers.filter("tenure < 40"))
    model.save(str(tmp_path / "model"))
    loaded = encoding.FeatureModel.load(spark, str(tmp_path / "model"))
    a, b = (
        m.transform(subscribers).select("label", vector_to_array("features").alias("v"))
        for m in (model, loaded)
    )
    assert a.exceptAll(b).count() == 0 and a.count() == 150


def test_direct_vectors_equal_the_assembled_ones(spark, sf_dir):
    subscribers = tables.gappy_subscribers(spark, sf_dir).withColumn(
        "TotalCharges", F.when(F.crc32("customerID") % 9 == 0, float("nan")).otherwise(F.col("TotalCharges"))
    )
    model = encoding.fit_features(subscribers.filter("tenure > 10"))  # leaves categories unseen
    engineered = engineer_features(subscribers, model.averages).transform(add_tenure_bucket)
    staged = encoding.feature_assembler().transform(model.dictionary.stages(engineered).transform(engineered))
    expected, found = encoding.store_columns(staged), model.transform(subscribers)
    assert feature_names(found) == feature_names(expected)
    a, b = (df.select("customerID", "label", vector_to_array("features").alias("v")) for df in (found, expected))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0


def test_looked_up_vectors_equal_the_direct_ones(spark, sf_dir, monkeypatch, tmp_path):
    subscribers = tables.subscribers(spark, sf_dir)
    train = subscribers.filter("tenure > 10")  # leaves categories unseen
    direct = encoding.fit_features(train).transform(subscribers).select("customerID", "features")
    monkeypatch.setattr(dictionary, "DIRECT_SLOTS", 10)
    model = encoding.fit_features(train)
    assert model.dictionary.labels is None
    model.save(str(tmp_path / "model"))
    for m in (model, encoding.FeatureModel.load(spark, str(tmp_path / "model"))):
        by_table = m.transform(subscribers).select("customerID", "features")
        # the same vectors in the same, compressed form
        assert sorted(map(repr, by_table.collect())) == sorted(map(repr, direct.collect()))
        names = {r["slot"]: r["feature"] for r in m.slot_names().collect()}
        assert names == feature_names(encoding.direct_features(engineer_features(subscribers), _labels(m.dictionary)))


def _labels(found):
    return {c: [r["value"] for r in found.parts[c].orderBy("index").collect()] for c in found.columns}


@pytest.mark.parametrize("slots", [0, 256])
def test_encoding_by_table_equals_the_stages(spark, sf_dir, monkeypatch, slots):
    monkeypatch.setattr(dictionary, "DIRECT_SLOTS", slots)
    df = tables.gappy_subscribers(spark, sf_dir).transform(add_tenure_bucket).withColumn("gender", F.lit(None).cast("string"))
    found = dictionary.fit_dictionary(df.filter("tenure > 20"))
    assert (found.labels is None) == (slots == 0) and found.sizes["gender"] == 0
    names = [f"{c}{kind}" for c in CATEGORICAL_COLUMNS if c != "gender" for kind in ("_idx", "_ohe")]
    by_table = found.encode(df).select("customerID", *names)
    narrowed = dictionary.fit_dictionary(df.filter("tenure > 20"), [c for c in CATEGORICAL_COLUMNS if c != "gender"])
    staged = narrowed.stages(df).transform(df).select("customerID", *names)
    assert sorted(map(repr, by_table.collect())) == sorted(map(repr, staged.collect()))


def test_many_labels_never_reach_the_driver(spark, monkeypatch):
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("string").alias("v"), F.when(F.col("id") % 3 > 0, "hot").alias("w"))
    collected = []
    plain = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(rows := plain(self)) or rows)
    found = dictionary.fit_dictionary(df, ["v", "w"])
    kept = found.look_up(df).agg(F.count_distinct("_index_v"), F.max("_index_v"), F.count("_index_w")).first()
    assert tuple(kept) == (n, n - 1, sum(i % 3 > 0 for i in range(n)))
    slots = encoding.looked_up_features(df, found, []).select(F.unwrap_udt("features").alias("v")).agg(F.max("v.size"), F.max(F.size("v.indices")), F.max(F.element_at("v.indices", -1)))
    assert tuple(slots.first()) == (n + 1, 2, n)
    assert max(map(len, collected)) < 100 and found.labels is None and found.sizes == {"v": n, "w": 1}
    with pytest.raises(ValueError, match="too many"):
        found.indexers()


def test_vectors_take_the_smaller_form(spark):
    def made(slots, size, most):
        pairs = [(F.lit(s), F.lit(v)) for s, v in slots]
        return spark.range(1).select(vectors.vector_of(vectors.entries_of(pairs), size, most)).first()[0]

    assert made([(0, 1.5), (2, -2.0), (3, 0.0)], 4, 3) == Vectors.dense(1.5, 0.0, -2.0, 0.0)
    assert repr(made([(0, 1.5), (9, 1e-300)], 5_000_000, 2)) == repr(Vectors.sparse(5_000_000, {0: 1.5, 9: 1e-300}))
    assert repr(made([(None, 1.0)], 3, 1)) == repr(Vectors.sparse(3, {}))
