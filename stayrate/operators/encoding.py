"""Categorical encoding and vector assembly.

Everything here is map-only once the category labels are known and few. Labels come from one aggregation
over all categorical columns and stay in a table (see ``dictionary``), so their number is not
bounded unless the caller asks for it.

The same vector can be built in three ways, which cannot be told apart from a feature store:
``direct_features`` compares with every label in generated code, for narrow vectors;
``looked_up_features`` looks each value up in the dictionary and sets its slot, for any width;
``fit_encoder`` and ``feature_assembler`` are the ``pyspark.ml`` stages. Slot names are part of the
vector column where the labels are few, and a table (``FeatureModel.slot_names``) always.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.columns import label_status, numeric_label, strict_label
from stayrate.operators.bounded import fixed
from stayrate.operators.cleaning import numeric_columns
from stayrate.operators.dictionary import Dictionary, fit_dictionary
from stayrate.operators.features import add_tenure_bucket, engineer_features
from stayrate.operators.vectors import entries_of, vector_of
from stayrate.schemas import CATEGORICAL_COLUMNS, METADATA_COLUMNS, NUMERIC_COLUMNS
from stayrate.sources.models import publish, published
from stayrate.sources.readers import read_parquet
from stayrate.sources.writers import write_parquet


def category_indices(
    df: DataFrame, columns: list[str] = CATEGORICAL_COLUMNS, *, max_categories: int | None = None
) -> DataFrame:
    """Index of each value: most frequent first, ties by name; (column, value, count, index)."""
    return fit_dictionary(df, columns, max_categories=max_categories).entries()


def fit_indexers(
    df: DataFrame, columns: list[str] = CATEGORICAL_COLUMNS, *, max_categories: int | None = None
) -> list[StringIndexerModel]:
    """One indexer per column, all learned in one pass; unseen and NULL values get the extra last index."""
    return fit_dictionary(df, columns, max_categories=max_categories).indexers()


def fit_encoder(
    df: DataFrame, columns: list[str] = CATEGORICAL_COLUMNS, *, max_categories: int | None = None
) -> PipelineModel:
    """Indexing and one-hot encoding into ``<column>_idx`` and ``<column>_ohe``, as ``pyspark.ml`` stages.

    Each vector has one slot per category; an unseen or NULL value sets none of them. Beyond the
    bound of such stages ``Dictionary.encode`` gives the same columns.
    """
    return fit_dictionary(df, columns, max_categories=max_categories).stages(df)


def feature_assembler(
    numeric: list[str] = NUMERIC_COLUMNS, categorical: list[str] = CATEGORICAL_COLUMNS
) -> VectorAssembler:
    """Numbers first, then the encoded categories. Rows with a missing number are skipped."""
    return VectorAssembler(
        inputCols=[*numeric, *(f"{c}_ohe" for c in categorical)], outputCol="features", handleInvalid="skip"
    )


def numeric_assembler(df: DataFrame) -> VectorAssembler:
    """All numeric columns but the label, for tables without a ``features`` column."""
    return VectorAssembler(inputCols=numeric_columns(df), outputCol="features", handleInvalid="skip")


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL or NaN in ``columns``; one condition per column, so each reaches the scan."""
    kinds = dict(df.dtypes)
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
        if kinds[c] == "double":
            df = df.filter(~F.isnan(c))
    return df


def direct_features(df: DataFrame, labels: Mapping[str, list[str]], numeric: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Add ``features`` as ``feature_assembler`` would, with the same slot names. Needs complete rows."""
    slots = [F.col(c).cast("double") for c in numeric]
    slots += [F.when(F.col(c) == value, 1.0).otherwise(0.0) for c, values in labels.items() for value in values]
    hot_names = [f"{c}_ohe_{value}" for c, values in labels.items() for value in values]
    attributes = {
        "numeric": [{"idx": i, "name": name} for i, name in enumerate(numeric)],
        "binary": [{"idx": i, "name": name} for i, name in enumerate(hot_names, len(numeric))],
    }
    metadata = {"ml_attr": {"attrs": attributes, "num_attrs": len(slots)}}
    dense = df.withColumn("_dense", array_to_vector(F.array(*slots)))
    # The assembler stores a vector in the smaller of its two forms, as it does for the stages.
    assembled = VectorAssembler(inputCols=["_dense"], outputCol="features").transform(dense)
    return assembled.drop("_dense").withMetadata("features", metadata)


def looked_up_features(df: DataFrame, dictionary: Dictionary, numeric: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Add ``features`` as ``feature_assembler`` would, from the dictionary's table. Needs complete rows."""
    found = dictionary.look_up(df)
    pairs = [(F.lit(i), F.col(c)) for i, c in enumerate(numeric)]
    first = len(numeric)
    for c in dictionary.columns:
        pairs.append((F.col(f"`_index_{c}`") + first, F.lit(1.0)))
        first += dictionary.sizes[c]
    features = vector_of(entries_of(pairs), first, len(pairs))
    metadata = {"ml_attr": {"num_attrs": first}}
    return found.withColumn("features", features).withMetadata("features", metadata).drop(*(f"_index_{c}" for c in dictionary.columns))


def store_columns(vectors: DataFrame, *, label: str = "Churn", extra: Sequence[str] = ()) -> DataFrame:
    """Vector, label and metadata columns only; the wide intermediates go no further.

    ``label`` is 0, 1 or NULL and ``label_status`` says why: used, missing or quarantined. ``extra`` keeps
    further columns, such as ``source_row`` to split by.
    """
    given = F.col(label)
    value = given.cast("double") if isinstance(vectors.schema[label].dataType, T.NumericType) else numeric_label(given)
    labelled = vectors.withColumns({"label_status": label_status(given, value), "label": strict_label(given, value)})
    return labelled.select("features", "label", *METADATA_COLUMNS, *extra, "label_status")


def feature_totals(df: DataFrame) -> DataFrame:
    """What the feature step learns, in one pass: (column, value, count, total, charges) for each label.

    Rows without a contract count in none of it. ``total`` is the sum of the monthly charges, ``charges`` their number.
    """
    charge = F.col("MonthlyCharges")
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in CATEGORICAL_COLUMNS))
    labelled = df.filter("Contract IS NOT NULL").transform(add_tenure_bucket).select(F.inline(pairs), charge)
    return labelled.filter("value IS NOT NULL").groupBy("column", "value").agg(
        F.count("*").alias("count"), F.sum(charge).alias("total"), F.count(charge).alias("charges")
    )


@dataclass(frozen=True)
class FeatureModel:
    """What the feature step learns from data: contract averages and the category dictionary.

    ``averages`` has a row per learned contract; a contract that was not learned gets ``overall``.
    """

    averages: DataFrame
    dictionary: Dictionary
    overall: float | None = None

    def usable(self, subscribers: DataFrame) -> DataFrame:
        """The rows that get a vector: those with all numbers and a contract."""
        # The derived numbers are missing exactly when one of these is.
        return complete_rows(subscribers, ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "Contract"])

    def transform(self, subscribers: DataFrame, *, extra: Sequence[str] = ()) -> DataFrame:
        """The feature store of ``subscribers``. Rows with a missing number or contract drop out."""
        averages = self.averages.select("Contract", "avg_charge_by_contract")
        engineered = engineer_features(self.usable(subscribers), averages, overall=self.overall)
        engineered = complete_rows(engineered, ["avg_charge_by_contract"]) if self.overall is None else engineered
        labels = self.dictionary.labels
        vectors = looked_up_features(engineered, self.dictionary) if labels is None else direct_features(engineered, labels)
        return store_columns(vectors, extra=extra)

    def slot_names(self) -> DataFrame:
        """(slot, feature) of the vectors."""
        return self.dictionary.slot_names(NUMERIC_COLUMNS)

    def save(self, path: str) -> None:
        """Publish a new version (see ``sources.models``)."""

        def write(folder: str) -> None:
            write_parquet(self.averages.withColumn("overall", F.lit(self.overall).cast("double")), f"{folder}/averages")
            self.dictionary.save(f"{folder}/dictionary")

        publish(self.averages.sparkSession, path, write)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        folder = published(spark, path) or path
        averages = read_parquet(spark, f"{folder}/averages")
        first = averages.select("overall").first() if "overall" in averages.columns else None
        return FeatureModel(averages.drop("overall"), Dictionary.load(spark, f"{folder}/dictionary"), first and first["overall"])


def fit_features(subscribers: DataFrame, *, max_categories: int | None = None) -> FeatureModel:
    """Learn the feature step in one pass. Pass training rows only to keep held-out rows out of it."""
    learned = fixed(feature_totals(subscribers))
    contracts = learned.filter(F.col("column") == "Contract")
    mean = F.round(F.sum("total") / F.nullif(F.sum("charges"), F.lit(0)), 2)
    averages = contracts.groupBy(F.col("value").alias("Contract")).agg(mean.alias("avg_charge_by_contract"))
    dictionary = fit_dictionary(subscribers, max_categories=max_categories, counts=learned)
    return FeatureModel(fixed(averages), dictionary, contracts.agg(mean).first()[0])
