"""Shared pieces: tables, scratch storage, vectorised words and hashes, components of links.

Texts reach Python as Arrow batches. The kernels below work on the UTF-8 bytes of many texts at
once, a bounded slice at a time, so a task's memory follows the slice and not its partition. A
single text longer than a slice is its own slice.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.sources.storage import checkpoint_dir, scratch_path

SLICE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def shared_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a small file to the shared scratch folder; returns its full path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name.partition(".")[0]) + "/" + name)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(content))
    out.close()
    return files.makeQualified(path).toString()


def ship_package(spark: SparkSession) -> None:
    """Let Spark bring this package to Python workers, once in a session.

    Only needed where it is not installed on the executors.
    """
    context = spark.sparkContext
    if any(name.startswith("stayrate-") for name in context._python_includes):
        return
    root = Path(__file__).resolve().parent.parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(shared_file(spark, f"stayrate-{uuid.uuid4().hex[:8]}.zip", held.getvalue()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; readies the workers for the functions of this package."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def lower_ascii() -> np.ndarray:
    bytes_ = np.arange(256, dtype=np.uint8)
    bytes_[65:91] += 32
    return bytes_


LOWER = lower_ascii()

#: Bytes of a word when only ASCII white space separates words.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of a word when all ASCII but digits and letters separates words.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different salts give independent functions."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + _ODD) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64), 7)
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            made = []
            for base in (_BASE, _BASE_INV):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                made.append(np.multiply.accumulate(steps))
        _powers[:] = made
    return _powers


class Words:
    """Words of a slice of texts.

    ``starts`` and ``ends`` are byte places in ``data``; ``bounds[i]:bounds[i+1]`` are the words
    of text i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = member[data]
        n = len(data)
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
            after[-1] = False
            after[:-1] = inside[1:]
        before &= ~cut[:-1]
        after &= ~cut[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def prefix_sums(self) -> np.ndarray:
        powers, _ = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.data] * powers[: len(self.data)], out=sums[1:])
        return sums

    def hashes(self, sums: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """One 64-bit value for each word (up to ``ends`` if given), the same wherever it stands."""
        sums = self.prefix_sums() if sums is None else sums
        ends = self.ends if ends is None else ends
        _, inverse = _power_tables(len(self.data) + 1)
        return mix((sums[ends] - sums[self.starts]) * inverse[self.starts])

    def texts(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.bounds))


def word_hash(word: str) -> int:
    """The hash that ``Words.hashes`` gives ``word``."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(Words(raw, np.array([0, len(raw)]), np.ones(256, dtype=bool)).hashes()[0])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n, first = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[first : first + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (first, last) of at most ``limit`` bytes, or one row, with their bytes and offsets."""
    data, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i+1]]``; an empty segment gives 0."""
    filled = np.diff(bounds) > 0
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=values.dtype)
    if filled.any():
        out[filled] = np.add.reduceat(values, bounds[:-1][filled], axis=0)
    return out


def segment_min(values: np.ndarray, bounds: np.ndarray, empty: int) -> np.ndarray:
    filled = np.diff(bounds) > 0
    out = np.full(len(bounds) - 1, empty, dtype=values.dtype)
    if filled.any():
        out[filled] = np.minimum.reduceat(values, bounds[:-1][filled])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start..start+count-1, one after the other."""
    total = int(counts.sum())
    out = np.ones(total, dtype=np.int64)
    if total == 0:
        return out
    full = counts > 0
    starts, counts = starts[full], counts[full]
    out[0] = starts[0]
    ends = np.cumsum(counts)[:-1]
    out[ends] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)


def columns(batch: pa.RecordBatch, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(values)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id for each id of ``edges`` (a, b), as (id, component).

    Alternating large-star and small-star steps: every step is a grouped minimum and a join, and
    each round is written out, so lineage stays short. An id with many neighbours is only a group
    in a minimum with map-side combine and a join that Spark can split.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )

    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select("a", "b")
        if large:
            both = both.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        joined = both.join(least, "a")
        if large:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(current)
    for _ in range(rounds):
        current = stored(star(star(current, True), False), "edges")
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents outside the held-out fold.

    The rows are those with the smallest hash of doc_id, so the sample is the same in every run. Only
    their ids are broadcast: ``limit`` bounds it. Copies of a text with the same label count once.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold("doc_id", folds) != held_out)
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(limit)
    )
    taught = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return taught.select("text", "label").dropDuplicates(["text", "label"])


def logistic_fit(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights (the last one constant) of a logistic regression by Newton steps."""
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    if len(x) == 0:
        return mean, scale, w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) / len(y) + ridge * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def logistic_score(model: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))


NUMBERS = "block int, numbers binary"
_BLOCK = 8192


def number_blocks(values: np.ndarray) -> pa.RecordBatch:
    """A task's table of numbers (fixed size) in blocks that can be added up apart from each other."""
    flat = np.ascontiguousarray(values, dtype=np.float64).ravel()
    parts = [flat[i : i + _BLOCK].tobytes() for i in range(0, len(flat), _BLOCK)]
    return pa.RecordBatch.from_pydict({"block": pa.array(range(len(parts)), pa.int32()), "numbers": pa.array(parts, pa.binary())})


def summed_blocks(blocks: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' tables, ``size`` numbers; only the sum comes to the driver.

    Blocks are added in two rounds, first within salted groups, so that no task meets all of them.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(raw.as_buffer(), dtype=np.float64)
                sums[block] = sums[block] + values if block in sums else values.copy()
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "numbers": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    salted = blocks.withColumn("_salt", F.spark_partition_id() % 64).repartition("block", "_salt").drop("_salt")
    rows = salted.mapInArrow(add, NUMBERS).repartition("block").mapInArrow(add, NUMBERS).toArrow()
    total = np.zeros(size)
    for block, raw in zip(rows.column("block").to_pylist(), rows.column("numbers")):
        values = np.frombuffer(raw.as_buffer(), dtype=np.float64)
        total[block * _BLOCK : block * _BLOCK + len(values)] += values
    return total
