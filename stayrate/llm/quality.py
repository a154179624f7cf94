"""Quality classifier on random-indexing word vectors.

Every word bucket has a fixed sparse index vector of +1 and -1; a bucket's context vector is the sum of
the index vectors of the words around it, over all texts. Beside its spelling a word also counts
under its shape (case, trailing signs, length, whether it repeats the word before), which shares
context vectors among rare words. A document is the mean vector of its words and the mean vector of
its shapes; a two-layer network in numpy turns that into a probability, and a temperature fitted on
learning rows set aside calibrates it.

Context vectors cover all texts: each task sums its own table of fixed size and the tables are added
up in two rounds, so no task meets them all. The network learns from at most ``SAMPLE`` labelled
documents (documented bound). Scoring is narrow; the broadcast has a fixed size.

Null and empty texts have a zero vector and a score like any other. Equal texts get equal scores; very
long texts are read whole. Without labels of both kinds the score is the share of label 1, or 0.5.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stayrate.llm.common import (
    LOWER,
    NOT_SPACE,
    NUMBERS,
    Words,
    fold,
    labelled_sample,
    mix,
    number_blocks,
    segment_sums,
    slices,
    summed_blocks,
    table,
)

SAMPLE = 20_000
THRESHOLD = 0.3
SPELLINGS = 8192
SHAPES = 256
DIMENSIONS = 32
MARKS = 2  # non-zero places of an index vector
WINDOW = 2
HIDDEN = 32
EPOCHS = 60

_ROWS = SPELLINGS + SHAPES


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each row."""
    raw = mix(np.arange(_ROWS * MARKS, dtype=np.uint64), 11).reshape(_ROWS, MARKS)
    return (raw % np.uint64(DIMENSIONS)).astype(np.int64), np.where((raw >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[65:91] = 1
_SIGN = np.zeros(256, dtype=np.int32)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_SENTENCE = np.zeros(256, dtype=np.int32)
_SENTENCE[[44, 46]] = 1  # comma and full stop


def rows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a slice with the table row of each spelling and of each shape."""
    found = Words(data, offsets, NOT_SPACE)
    plain = Words.__new__(Words)
    plain.__dict__ = found.__dict__ | {"data": LOWER[data]}
    h = plain.hashes()
    bounds = np.concatenate([found.starts, [len(data)]]) if len(found) else np.zeros(1, np.int64)
    length = found.ends - found.starts
    if not len(found):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64)
    upper = np.add.reduceat(_UPPER[data], bounds[:-1])
    signs = np.add.reduceat(_SIGN[data], bounds[:-1])
    ends_plain = _SENTENCE[data[found.ends - 1]]
    same = np.zeros(len(found), dtype=np.int64)
    same[1:] = h[1:] == h[:-1]
    same[found.bounds[:-1][np.diff(found.bounds) > 0]] = 0
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(2 * upper >= length, 2, 3)))
    sign = np.where(signs == 0, 0, np.where((signs == 1) & (ends_plain == 1), 1, np.where(signs == length, 2, 3)))
    size = np.minimum(length // 4, 7)
    shape = ((same * 4 + case) * 4 + sign) * 8 + size
    return found, (h % np.uint64(SPELLINGS)).astype(np.int64), SPELLINGS + shape.astype(np.int64)


def _contexts(found: Words, rows: np.ndarray, seen: np.ndarray, places: np.ndarray, signs: np.ndarray, total: np.ndarray) -> None:
    """Add to the context vectors of ``rows`` the index vectors of the words ``seen`` around them."""
    texts = found.texts()
    for step in range(1, WINDOW + 1):
        if len(rows) <= step:
            return
        near = texts[step:] == texts[:-step]
        left, right = np.flatnonzero(near), np.flatnonzero(near) + step
        for word, other in ((left, right), (right, left)):
            for k in range(MARKS):
                at = rows[word] * DIMENSIONS + places[seen[other], k]
                total += np.bincount(at, weights=signs[seen[other], k], minlength=len(total))


def context_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A unit vector for each spelling and shape bucket (a table of fixed size)."""
    size = _ROWS * DIMENSIONS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors()
        total = np.zeros(size)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                found, spelling, shape = rows_of(data, offsets)
                _contexts(found, spelling, spelling, places, signs, total)
                _contexts(found, shape, shape, places, signs, total)
        yield number_blocks(total)

    table_ = summed_blocks(docs.select(text).mapInArrow(count, NUMBERS), size).reshape(_ROWS, DIMENSIONS)
    table_ = table_ / np.maximum(np.linalg.norm(table_, axis=1, keepdims=True), 1e-9)
    return table_.astype(np.float32)


def document_vectors(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean spelling vector, mean shape vector and the logarithm of the number of words."""
    found, spelling, shape = rows_of(data, offsets)
    n = np.maximum(np.diff(found.bounds), 1)[:, None]
    parts = [segment_sums(vectors[rows], found.bounds) / n for rows in (spelling, shape)]
    return np.hstack([*parts, np.log1p(np.diff(found.bounds))[:, None] / 10])


class Network:
    """Input, one hidden layer of rectified units, one logit; temperature divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 5):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.default_rng(seed)
        order = np.lexsort([*x.T, y])  # independent of the order in which rows arrive
        x, y = x[order], y[order]
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        aside = np.arange(len(y)) % 5 == 0
        xt, yt, xv, yv = x[~aside], y[~aside], x[aside], y[aside]
        p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), 0.0]
        first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
        step = 0
        for _ in range(epochs):
            shuffled = rng.permutation(len(yt))
            for i in range(0, len(yt), 256):
                rows = shuffled[i : i + 256]
                a = xt[rows] @ p[0] + p[1]
                r = np.maximum(a, 0)
                d = (1 / (1 + np.exp(-np.clip(r @ p[2] + p[3], -30, 30))) - yt[rows]) / len(rows)
                back = np.outer(d, p[2]) * (a > 0)
                grads = [xt[rows].T @ back + 1e-5 * p[0], back.sum(0), r.T @ d + 1e-5 * p[2], d.sum()]
                step += 1
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p[k] = p[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.weights, self.temperature = p, 1.0
        if len(yv):
            z = self._logit(xv)
            grid = np.geomspace(0.25, 8, 60)
            losses = [np.mean(np.logaddexp(0, -np.where(yv > 0, z, -z) / t)) for t in grid]
            self.temperature = float(grid[int(np.argmin(losses))])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -30, 30)))


def fit(docs: DataFrame, taught: DataFrame, text: str = "text") -> tuple[np.ndarray, Network]:
    """Context vectors from all of ``docs`` and a network from ``taught`` (text, label; bounded)."""
    vectors = context_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(0)):
                x = document_vectors(data, offsets, shared.value)
                yield pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64())), "label": batch.column(1).slice(i, j - i)})

    rows = taught.select("text", "label").mapInArrow(points, "x array<double>, label int").toArrow()
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(-1, 2 * DIMENSIONS + 1)
    return vectors, Network(x, rows.column("label").to_numpy().astype(float))


def score(
    docs: DataFrame, model: tuple[np.ndarray, Network], text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """``keep`` columns with the score as ``name``, which takes the place of a kept column so called."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in keep if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(len(kept))):
                value = network.score(document_vectors(data, offsets, vectors))
                out = {c: batch.column(k).slice(i, j - i) for k, c in enumerate(kept)}
                yield pa.RecordBatch.from_pydict(out | {name: pa.array(value)})

    schema = docs.select(*kept).schema.add(name, DoubleType())
    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)


def learned(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    return fit(docs, labelled_sample(docs, labels, "quality", 5, 0, SAMPLE))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    scored = score(held, learned(docs, table(spark, sf_dir, "labels")), keep=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
