"""Sampling, splitting and scaling a table up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions import columns as C
from stayrate.functions.hashing import hash_bigint, hash_fraction_below, hash_normal
from stayrate.operators.ordering import number_rows
from stayrate.operators.quality import stddev_profile
from stayrate.schemas import CHUNK_ROWS, NOISE_FACTOR, NOISY_COLUMNS


def key_text(key: str, null_keys: Sequence[str]) -> Column:
    """The key as text. Rows with a NULL key are told apart by ``null_keys``; without any, one fails the job.

    Hashing NULL like any other key would put all such rows on one side.
    """
    text = F.col(key).cast("string")
    if not null_keys:
        return F.coalesce(text, F.raise_error(F.lit(f"NULL in the key {key}: name null_keys columns")).cast("string"))
    return F.coalesce(text, F.concat(F.lit("null:"), F.xxhash64(*null_keys).cast("string")))


def hash_sample(df: DataFrame, key: str, fraction: float, *, seed: int = 42, null_keys: Sequence[str] = ()) -> DataFrame:
    """Repeatable sample without replacement."""
    return df.filter(hash_fraction_below("sample", seed, key_text(key, null_keys), fraction))


def bernoulli_sample(df: DataFrame, fraction: float, *, seed: int = 42) -> DataFrame:
    """Spark's own sample; repeatable only for a fixed partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_split(
    df: DataFrame, key: str, *, train_fraction: float = 0.8, seed: int = 42, null_keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``is_train``. Rows with the same key fall on the same side.

    Split scaled-up tables by ``source_row`` so that noisy copies of one row stay together.
    """
    return df.withColumn("is_train", hash_fraction_below("split", seed, key_text(key, null_keys), train_fraction))


def hash_split(
    df: DataFrame, key: str, *, train_fraction: float = 0.8, seed: int = 42, null_keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    split = with_split(df, key, train_fraction=train_fraction, seed=seed, null_keys=null_keys)
    return split.filter("is_train").drop("is_train"), split.filter("NOT is_train").drop("is_train")


def random_split(df: DataFrame, *, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; repeatable only for a fixed partitioning."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


def with_fold(df: DataFrame, key: str, folds: int, *, seed: int = 42, null_keys: Sequence[str] = ()) -> DataFrame:
    """Add the cross-validation ``fold`` of each row's key."""
    return df.withColumn("fold", (hash_bigint("fold", seed, key_text(key, null_keys)) % folds).cast("int"))


def draw_rows(numbered: DataFrame, rows: int, *, seed: int = 42) -> DataFrame:
    """``rows`` draws with replacement from a table numbered by ``source_row``.

    The draws are generated on the executors. ``number_rows`` gives a written table, so the planner
    knows its bytes: it is broadcast below the session's broadcast threshold and shuffled beyond.
    """
    size = numbered.count()
    if size == 0:
        raise ValueError("cannot draw from an empty table")
    draws = numbered.sparkSession.range(rows).select(
        F.col("id").alias("row_id"), (hash_bigint("draw", seed, F.col("id")) % size).alias("source_row")
    )
    drawn = draws.join(numbered, "source_row")
    columns = [c for c in numbered.columns if c != "source_row"]
    renamed = drawn.withColumn("customerID", C.subscriber_id(F.col("row_id"), CHUNK_ROWS))
    return renamed.select(*columns, "row_id", "source_row")


def bootstrap_rows(source: DataFrame, rows: int, *, key: str = "customerID", seed: int = 42) -> DataFrame:
    """Exactly ``rows`` draws with replacement, each with a new id.

    Adds ``row_id`` (0..rows-1) and ``source_row`` (which source row was drawn, in ``key`` order)
    and replaces ``customerID``.
    """
    return draw_rows(number_rows(source, key, name="source_row"), rows, seed=seed)


def column_stddevs(df: DataFrame, columns: list[str] = NOISY_COLUMNS) -> dict[str, float]:
    """Sample standard deviations as numbers: one aggregated row per column reaches the driver."""
    return {r["column"]: r["stddev"] or 0.0 for r in stddev_profile(df, columns).collect()}


def add_noise(
    df: DataFrame, stddevs: dict[str, float], *, key: str = "row_id", factor: float = NOISE_FACTOR, seed: int = 42
) -> DataFrame:
    """Gaussian noise in proportion to each column's spread, clipped at 0; tenure stays in whole months."""
    noisy = {
        c: C.clip_lower(F.col(c) + hash_normal(f"noise-{c}", seed, F.col(key)) * F.lit(factor * stddev))
        for c, stddev in stddevs.items()
    }
    if "tenure" in noisy:
        noisy["tenure"] = C.round_half_even(noisy["tenure"])
    return df.withColumns(noisy)


def scale_up(source: DataFrame, rows: int, *, key: str = "customerID", seed: int = 42) -> DataFrame:
    """Bootstrap plus noise: the scaled-up subscriber table. ``source`` is evaluated once."""
    numbered = number_rows(source, key, name="source_row")
    stddevs = column_stddevs(numbered, [c for c in NOISY_COLUMNS if c in source.columns])
    return draw_rows(numbered, rows, seed=seed).transform(add_noise, stddevs, seed=seed)
