"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

Quality classifier (rejected documents go), n-gram Jaccard join (one document of each group of
near duplicates stays), substring dedup (repeated passages are cut out of all but their first holder),
benchmark decontamination (documents that hold a benchmark item go), BPE encoding and decoding (adds token
ids and the decoded text). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import bpe, chunks, decontaminate, jaccard, quality
from stayrate.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Documents that Spark hands to a Python worker at once: with the usual 10,000 the batches alone, in the executor
#: and in its workers, take some hundred megabytes, and more where texts are long.
BATCH_ROWS = 1_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of the given folder; readies the workers and keeps their batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return table(spark, sf_dir, name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    model = quality.learned(docs, documents(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=tuple(docs.columns), name="_quality")
    return scored.where(F.col("_quality") >= quality.THRESHOLD).select(*docs.columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of doc_id and text: rows that share a doc_id, or have none, are told apart by their texts."""
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    parts = [part for c in ("doc_id", "text") for part in (F.col(c).isNull(), F.col(c))]
    return docs.withColumn(name, F.xxhash64(*parts)), name


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest doc_id, a null one last.

    Components are those of rows, not of ids: unlike texts that share a doc_id, or have none, all stay. Of
    rows equal in doc_id and text one stays.
    """
    documents(spark, sf_dir)  # readies the workers
    keyed, key = _keyed(docs)
    named = jaccard.similar_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id").distinct()
    ids = keyed.select(F.col(key).alias("_key"), F.col("doc_id").alias("_id")).distinct()
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_key"))
    kept = named.join(ids, "_key").groupBy("component_id").agg(F.min_by("_key", order).alias(key)).select(key)
    return keyed.join(kept, key, "left_semi").dropDuplicates([key, "doc_id"]).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; n_chars follows the text."""
    documents(spark, sf_dir)
    cut = chunks.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Only the rows that hold one go, whatever their doc_id."""
    keyed, key = _keyed(docs)
    leaks = decontaminate.find_leaks(keyed.select(F.col(key).alias("doc_id"), "text"), documents(spark, sf_dir, "benchmark"))
    return keyed.join(leaks.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token_ids, decoded and n_tokens."""
    documents(spark, sf_dir)
    return bpe.decode(bpe.encode(docs)).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("jaccard", keep_one_of_similar),
    ("substrings", cut_repeats),
    ("decontamination", drop_leaks),
    ("bpe", encode_and_decode),
]

#: The learned and iterative stages have no SQL form; tests compare the run with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
