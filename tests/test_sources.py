import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.feature import Binarizer
from pyspark.sql import functions as F

from stayrate.operators import quality
from stayrate.schemas import SUBSCRIBER_TYPES
from stayrate.sources import models, readers, storage, writers

HEADER = ",".join(SUBSCRIBER_TYPES)
ROW = "{id},Male,0,No,No,{tenure},Yes,No,DSL,No,No,No,No,No,No,Two year,No,Mailed check,20.5,{total},{churn}"


def write_csv(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_csv_cleaning(spark, tmp_path):
    lines = [
        ROW.format(id="a", tenure=1, total="29.85", churn="Yes"),
        ROW.format(id="b", tenure=0, total=" ", churn="No"),
        ROW.format(id="c", tenure=0, total="", churn="?"),
    ]
    df = readers.clean_raw(readers.read_raw_csv(spark, write_csv(tmp_path / "raw.csv", lines)))
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == SUBSCRIBER_TYPES
    rows = {r["customerID"]: (r["TotalCharges"], r["Churn"]) for r in df.collect()}
    assert rows == {"a": (29.85, 1), "b": (0.0, 0), "c": (0.0, None)}


def test_csv_with_wrong_header_fails(spark, tmp_path):
    path = write_csv(tmp_path / "raw.csv", [ROW.format(id="a", tenure=1, total="1", churn="No")], HEADER.replace("gender", "sex"))
    with pytest.raises(Exception, match="header"):
        readers.read_raw_csv(spark, path).collect()


def test_missing_inputs_fail_early(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        readers.read_parquet(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        readers.read_parquet_parts(spark, str(tmp_path / "empty"))


def test_explicit_part_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 100, 1, 4).write.parquet(path)
    parts = sorted(str(p) for p in (tmp_path / "t").glob("part-*.parquet"))
    assert len(parts) == 4
    assert readers.read_parquet(spark, *parts[:2]).count() == 50
    assert readers.read_parquet_parts(spark, path).count() == 100
    assert readers.read_parquet(spark, f"{path}/part-0000[01]*.parquet").count() == 50


def test_file_count_row_bound_and_codec(spark, tmp_path):
    import pyarrow.parquet as pq

    writers.write_file_count(spark.range(1000), str(tmp_path / "four"), files=4)
    assert len(list((tmp_path / "four").glob("*.parquet"))) == 4
    writers.write_row_bounded(spark.range(0, 1000, 1, 1), str(tmp_path / "bounded"), rows=300)
    (part,) = (tmp_path / "bounded").glob("*.parquet")
    groups = [pq.ParquetFile(part).metadata.row_group(i) for i in range(4)]
    assert [g.num_rows for g in groups] == [300, 300, 300, 100]
    assert {g.column(0).compression for g in groups} == {"SNAPPY"}


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(10), path)
    writers.write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_score_formats(spark, tmp_path):
    scores = spark.createDataFrame([("a", 1.0, 0.75)], "customerID string, prediction double, churn_probability double")
    writers.write_scores(scores.coalesce(1), str(tmp_path / "csv"), output_format="CSV")
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    assert part.read_text().splitlines() == ["customerID,prediction,churn_probability", "a,1.0,0.75"]
    with pytest.raises(ValueError, match="parquet, csv"):
        writers.write_scores(scores, str(tmp_path / "x"), output_format="orc")


def test_checkpoints_go_where_the_session_says(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named in storage.checkpoint_dir(spark)
    assert storage.scratch_path(spark, "x").startswith(storage.checkpoint_dir(spark))


@pytest.mark.parametrize("parts", ["many tiny", "two skewed"])
def test_files_are_sized_by_bytes(spark, tmp_path, parts):
    wide = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit("a").alias("kind"))
    if parts == "many tiny":
        df = wide.repartition(1_000)
    else:
        df = wide.filter("id >= 50").coalesce(1).unionAll(wide.filter("id < 50").coalesce(1))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        # Rows of one value are split by the tasks that they come from, so that takes more than one task.
        for by in ([], ["kind"]) if parts == "many tiny" else ([],):
            path = tmp_path / f"out{len(by)}"
            writers.write_file_count(df, str(path), by=by)
            sizes = [f.stat().st_size for f in path.rglob("*.parquet")]
            total = sum(sizes)
            assert total / 3e6 < len(sizes) < total / 2e5, sizes
            assert max(sizes) < 2.5 * total / len(sizes)
            assert spark.read.parquet(str(path)).count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_broken_save_leaves_the_published_model(spark, tmp_path):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "x double, label double")

    def fitted(threshold):
        return Pipeline(stages=[Binarizer(threshold=threshold, inputCol="x", outputCol="y")]).fit(rows)

    def loaded():
        return models.load_model(spark, str(tmp_path), "LR").stages[0].getThreshold()

    class Breaking:
        def write(self):
            return self

        def save(self, folder):
            fitted(9.0).stages[0].write().save(f"{folder}/stages/half")
            raise OSError("lost")

    assert not models.has_model(spark, str(tmp_path), "LR")
    with pytest.raises(FileNotFoundError, match="LR_best"):
        models.load_model(spark, str(tmp_path), "LR")
    fitted(1.0).write().save(f"{tmp_path}/LR_best")  # as it was saved before there were versions
    assert models.has_model(spark, str(tmp_path), "LR") and loaded() == 1.0
    for threshold in (2.0, 3.0, 4.0):
        models.save_model(fitted(threshold), str(tmp_path), "LR")
        assert loaded() == threshold
        with pytest.raises(OSError, match="lost"):
            models.save_model(Breaking(), str(tmp_path), "LR")
        assert loaded() == threshold
    assert len(list((tmp_path / "LR_best/published").glob("0*"))) == models.KEPT


@pytest.mark.parametrize("shape", ["plain", "all null", "nan", "negative zero", "empty"])
def test_footer_profile_equals_a_scan(spark, tmp_path, shape):
    row = "id, double(id) AS tenure, double(id - 2) / 3 AS MonthlyCharges, IF(id % 3 > 0, id * 1.5D, NULL) AS TotalCharges, IF(id % 2 > 0, 'x', NULL) AS name"
    df = spark.sql(f"SELECT {row} FROM range(100)")
    change = {
        "all null": F.lit(None).cast("double"),
        "nan": F.when(F.col("id") == 7, float("nan")).otherwise(F.col("tenure")),
        "negative zero": F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0),
    }
    df = df.withColumn("tenure", change.get(shape, F.col("tenure"))).filter("id < 0" if shape == "empty" else "true")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    expected, found = (p.first().asDict() for p in (quality.wide_profile(stored), quality.footer_profile(spark, str(tmp_path / "t"))))
    assert {c: repr(v).replace("-0.0", "0.0") for c, v in found.items()} == {c: repr(v).replace("-0.0", "0.0") for c, v in expected.items()}


def test_footers_answer_without_reading_a_column(spark, tmp_path):
    spark.range(100).selectExpr("id AS tenure", "id * 2.0D AS MonthlyCharges").write.parquet(str(tmp_path / "t"))
    plan = quality.footer_aggregate(spark, str(tmp_path / "t"), ["tenure", "MonthlyCharges"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(tenure), COUNT(MonthlyCharges), MIN(tenure), MIN(MonthlyCharges), MAX(tenure), MAX(MonthlyCharges)]" in plan


def test_file_skew_matches_the_disk(spark, tmp_path):
    spark.range(10_000).withColumn("part", F.when(F.col("id") < 9_000, 0).otherwise(F.col("id") % 4)).repartition(4, "part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    sizes = [f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet")]
    skew = quality.file_skew(spark.read.parquet(str(tmp_path / "t"))).first()
    assert (skew["files"], skew["rows"], skew["max_bytes"]) == (len(sizes), 10_000, max(sizes))
    assert skew["bytes_skew"] == pytest.approx(max(sizes) * len(sizes) / sum(sizes)) and skew["rows_skew"] > 3
    profile = quality.file_profile(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r["bytes"] for r in profile.collect()) == sorted(sizes)
    assert "ReadSchema: struct<>" in profile._jdf.queryExecution().executedPlan().toString()
