"""Category labels and their indices as a table.

Learning is one aggregation over all columns, then one distributed order. The labels stay in storage, one folder a
column, so that the planner knows each column's bytes: looking a column up is a broadcast join where its
labels are few and a shuffled one, whose hot values adaptive execution splits, where they are not.
The driver holds how many labels each column has, and the labels themselves only up to ``DIRECT_SLOTS``
in all columns together.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators.bounded import fixed
from stayrate.operators.ordering import PLACE, block_starts, number_of, place_rows
from stayrate.operators.vectors import entries_of, vector_of
from stayrate.schemas import CATEGORICAL_COLUMNS
from stayrate.sources.writers import write_parquet

# Up to this many labels in all columns together, comparing with each of them in generated code is
# quicker than looking values up (README has the figures), and the driver may hold them.
DIRECT_SLOTS = 256

# The most labels that are handed to pyspark.ml stages, which hold them on the driver.
STAGE_LABELS = 100_000

_PART = "value string, count long, index long"


def category_counts(df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Rows per value of each column, in one pass: (column, value, count)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("column", "value").count()


def label_numbers(counts: DataFrame) -> dict[str, int]:
    """Labels of each column; one row a column reaches the driver."""
    return {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.count("*").alias("n")).collect()}


def check_categories(sizes: Mapping[str, int], max_categories: int | None) -> None:
    """Fail when a column has more than ``max_categories`` values."""
    wide = [f"{c} ({n})" for c, n in sorted(sizes.items()) if max_categories is not None and n > max_categories]
    if wide:
        raise ValueError(f"more than {max_categories} categories in {', '.join(wide)}; is one of them an identifier?")


@dataclass(frozen=True)
class Dictionary:
    """Labels by column, the most frequent one first and ties by name.

    ``parts`` has (value, count, index) of each column, ``sizes`` their numbers of labels. ``labels`` has them
    all in index order if there are at most ``DIRECT_SLOTS``, else None. ``whole`` has all parts as one table, if there is one.
    """

    columns: tuple[str, ...]
    sizes: Mapping[str, int]
    parts: Mapping[str, DataFrame] = field(repr=False)
    labels: Mapping[str, list[str]] | None
    whole: DataFrame | None = field(default=None, repr=False)

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def entries(self) -> DataFrame:
        """(column, value, count, index) of all columns."""
        if self.whole is not None:
            return self.whole.withColumn("index", F.col("index").cast("double"))
        tables = (self.parts[c].select(F.lit(c).alias("column"), "value", "count", F.col("index").cast("double").alias("index")) for c in self.columns)
        return reduce(DataFrame.unionByName, tables)

    def slot_names(self, numeric: Sequence[str] = ()) -> DataFrame:
        """(slot, feature) of the vector in which the columns' slots follow ``numeric``."""
        spark = next(iter(self.parts.values())).sparkSession
        names = spark.createDataFrame(list(enumerate(numeric)), "slot int, feature string")
        first = len(numeric)
        for c in self.columns:
            part = self.parts[c].select((F.col("index") + first).cast("int").alias("slot"), F.concat(F.lit(f"{c}_ohe_"), F.col("value")).alias("feature"))
            names, first = names.unionByName(part), first + self.sizes[c]
        return names

    def look_up(self, df: DataFrame, prefix: str = "_index_") -> DataFrame:
        """``df`` with ``<prefix><column>``: the label's index, NULL for an unseen or missing value."""
        if self.labels is not None:  # few labels are a constant of the plan
            return df.withColumns({f"{prefix}{c}": _position(F.col(f"`{c}`").cast("string"), self.labels[c]) for c in self.columns})
        for i, c in enumerate(self.columns):
            key, index = f"_label_{i}", f"{prefix}{c}"
            part = self.parts[c].select(F.col("value").alias(key), F.col("index").alias(index))
            df = df.join(part, F.col(f"`{c}`").cast("string") == F.col(key), "left").drop(key)
        return df

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>_idx`` and the one-hot vector ``<column>_ohe`` of every column.

        An unseen or NULL value has the extra last index and sets no slot.
        """
        found = self.look_up(df)
        added: dict[str, Column] = {}
        for c in self.columns:
            index = F.col(f"`_index_{c}`")
            added[f"{c}_idx"] = F.coalesce(index, F.lit(self.sizes[c])).cast("double")
            added[f"{c}_ohe"] = vector_of(entries_of([(index, F.lit(1.0))]), self.sizes[c])
        return found.withColumns(added).drop(*(f"_index_{c}" for c in self.columns))

    def indexers(self) -> list[StringIndexerModel]:
        """``pyspark.ml`` indexers with the same labels. These live on the driver, so there is a bound."""
        if self.width > STAGE_LABELS:
            raise ValueError(f"{self.width} labels are too many for pyspark.ml stages ({STAGE_LABELS}); use the dictionary itself")
        labels = self.labels or _collected(self.entries(), self.columns)
        return [StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in self.columns]

    def stages(self, df: DataFrame) -> PipelineModel:
        """Indexing and one-hot encoding as ``pyspark.ml`` stages, into the columns of ``encode``."""
        indexers = PipelineModel(self.indexers())
        encoder = OneHotEncoder(inputCols=[f"{c}_idx" for c in self.columns], outputCols=[f"{c}_ohe" for c in self.columns], dropLast=True)
        # The sizes come from the indexed columns' metadata, so fitting reads no rows.
        return PipelineModel([*indexers.stages, encoder.fit(indexers.transform(df))])

    def save(self, path: str) -> None:
        """One folder a column and a list of them."""
        spark = next(iter(self.parts.values())).sparkSession
        for i, c in enumerate(self.columns):
            write_parquet(self.parts[c], f"{path}/labels/{i}")
        listed = [(i, c, self.sizes[c], json.dumps(self.labels[c]) if self.labels is not None else None) for i, c in enumerate(self.columns)]
        write_parquet(spark.createDataFrame(listed, "place int, column string, size long, labels string").coalesce(1), f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Dictionary:
        rows = sorted(spark.read.parquet(f"{path}/columns").collect())  # one row a column
        parts = {r["column"]: spark.read.schema(_PART).parquet(f"{path}/labels/{r['place']}") for r in rows}
        known = all(r["labels"] is not None for r in rows)
        labels = {r["column"]: json.loads(r["labels"]) for r in rows} if known else None
        return Dictionary(tuple(r["column"] for r in rows), {r["column"]: r["size"] for r in rows}, parts, labels)


def _position(value: Column, labels: list[str]) -> Column:
    if not labels:
        return F.lit(None).cast("long")
    return F.nullif(F.array_position(F.lit(labels), value), F.lit(0).cast("long")) - 1


def _collected(entries: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for r in sorted(entries.collect(), key=lambda r: r["index"]):
        labels[r["column"]].append(r["value"])
    return labels


def _small(counts: DataFrame, columns: Sequence[str], sizes: Mapping[str, int]) -> Dictionary:
    """Few labels: numbered on the driver."""
    rows = sorted(counts.collect(), key=lambda r: (-r["count"], r["value"].encode()))
    ordered = {c: [r for r in rows if r["column"] == c] for c in columns}
    numbered = [(c, r["value"], r["count"], i) for c in columns for i, r in enumerate(ordered[c])]
    kinds = pa.schema([("column", pa.string()), ("value", pa.string()), ("count", pa.int64()), ("index", pa.int64())])
    table = pa.table([list(x) for x in zip(*numbered)] or [[]] * 4, schema=kinds)
    entries = counts.sparkSession.createDataFrame(table)  # from Arrow, so that the planner has a local table
    parts = {c: entries.filter(F.col("column") == c).drop("column") for c in columns}
    return Dictionary(tuple(columns), sizes, parts, {c: [r["value"] for r in ordered[c]] for c in columns}, entries)


def _large(counts: DataFrame, columns: Sequence[str], sizes: Mapping[str, int]) -> Dictionary:
    """Any number of labels: all columns in one distributed order, of which each column is a stretch."""
    spark = counts.sparkSession
    place = F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (c, i)))
    listed = counts.withColumn("_column", F.try_element_at(place, F.col("column"))).select("_column", "value", "count")
    order = [F.col("_column"), F.desc("count"), F.col("value")]
    placed, path = place_rows(listed, order, by=["_column"])
    starts = block_starts(placed)
    parts, first = {}, 0
    for i, c in enumerate(columns):
        if sizes[c]:
            part = spark.read.schema(f"value string, count long, {PLACE} long").parquet(f"{path}/_column={i}")
            parts[c] = part.select("value", "count", (number_of(F.col(PLACE), starts) - first).alias("index"))
        else:
            parts[c] = spark.createDataFrame([], _PART)
        first += sizes[c]
    return Dictionary(tuple(columns), sizes, parts, None)


def fit_dictionary(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS, *, max_categories: int | None = None, counts: DataFrame | None = None
) -> Dictionary:
    """Learn the labels of ``columns``, in one pass over ``df`` or from ``counts`` taken before."""
    counts = fixed(category_counts(df, columns)) if counts is None else counts
    sizes = {c: 0 for c in columns} | label_numbers(counts)
    check_categories(sizes, max_categories)
    return (_small if sum(sizes.values()) <= DIRECT_SLOTS else _large)(counts.select("column", "value", "count"), columns, sizes)
