"""Toxicity scores of deobfuscated text.

A character trigram model is counted over all texts. Spans that look disguised (digits or signs
among letters, letters set apart one by one, a letter three or more times in a row) become character
lattices: each sign may stand for itself or for the letters that it imitates, separators may be
dropped, repetitions may be shortened. A Viterbi pass picks the most probable reading under the
character model and the channel's costs, and the readings are put back. Any other text has exactly
one path through its lattice, so it is left as it is.

The restored text is scored by its words and their beginnings: learned log odds of toxic against
other documents, pooled for each document, then a logistic regression. Learning uses at most
``SAMPLE`` labelled documents (documented bound; the smallest hashes of doc_id). The language model
and the scores cover every row. Character counts are summed within tasks before a shuffle of at most
one row for each trigram and task; everything else is narrow.

Null and empty texts, and all texts when no label is known, get the score of a text without words.
Equal texts get equal scores. Very long texts are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from stayrate.llm.common import (
    ALNUM,
    LOWER,
    NOT_SPACE,
    Words,
    fold,
    labelled_sample,
    logistic_fit,
    logistic_score,
    slices,
    table,
)

SAMPLE = 20_000
THRESHOLD = 0.3
FEATURES = 1 << 19
STEMS = (4, 5, 6)
PRIOR = 4.0
STRONG = 1.5

#: What a sign may stand for, besides itself.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
COST_SIGN = -np.log(0.3)
COST_KEEP = -np.log(0.05)
COST_DROP = -np.log(0.5)
SEPARATORS = " .-_*"

_SIGNS = "".join(re.escape(c) for c in LEET)
_LETTER = r"[^\W\d_]"
#: Disguised spans: signs among letters; single letters set apart; a letter repeated.
_SPAN = re.compile(
    rf"(?:(?<![\w])[\w{_SIGNS}]*{_LETTER}[\d{_SIGNS}]+[\w{_SIGNS}]*{_LETTER}[\w{_SIGNS}]*)"
    rf"|(?:(?<![\w])[{_SIGNS}]+{_LETTER}[\w{_SIGNS}]*{_LETTER})"
    rf"|(?:(?<!\w){_LETTER}(?:[ .\-_*]{{1,2}}{_LETTER}(?!\w)){{2,}})"
    rf"|(?:\w*({_LETTER})\1\1+\w*)"
)
SYMBOLS = 28  # other, a-z, and anything beyond ASCII
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27


def symbol(char: str) -> int:
    return int(_SYMBOL[ord(char)]) if ord(char) < 128 else 27


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): trigrams of symbols over all texts, each text between two blanks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                first = np.ones(len(data), dtype=bool)
                if len(data):
                    first[1:] = (data[1:] & 0xC0) != 0x80  # one symbol a character
                place = np.cumsum(first) - first
                at = np.concatenate([place, [first.sum()]])[offsets]
                chars = _SYMBOL[data[first]]
                # two blanks before each text and one after keep texts apart
                shift = np.repeat(np.arange(len(offsets) - 1), np.diff(at)) * 3 + 2
                line = np.zeros(len(chars) + 3 * (len(offsets) - 1) + 2, dtype=np.int32)
                line[np.arange(len(chars)) + shift] = chars
                total += np.bincount((line[:-2] * SYMBOLS + line[1:-1]) * SYMBOLS + line[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    return docs.select(text).mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a symbol after two others; at most SYMBOLS^3 numbers come to the driver."""
    counts = np.zeros(SYMBOLS**3)
    rows = character_counts(docs, text).toArrow()
    counts[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    cube = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    lower = (cube.sum(0) + 1) / (cube.sum(0).sum(-1, keepdims=True) + SYMBOLS)
    return np.log((cube + 5 * lower[None]) / (cube.sum(-1, keepdims=True) + 5))


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each place of a span, with their channel costs; an empty reading drops it."""
    places: list[list[tuple[str, float]]] = []
    spaced = re.fullmatch(rf"{_LETTER}(?:[ .\-_*]{{1,2}}{_LETTER})+", span) is not None
    i = 0
    while i < len(span):
        char, run = span[i], 1
        while i + run < len(span) and span[i + run] == char:
            run += 1
        if char.isalpha() and run >= 3:
            places.append([(char, COST_SIGN), (char * 2, COST_SIGN)])
        elif char in LEET:
            for _ in range(run):
                places.append([(char, COST_KEEP), *((c, COST_SIGN) for c in LEET[char])])
        elif spaced and char in SEPARATORS:
            places.append([("", COST_DROP), (" ", COST_DROP)])
        else:
            places += [[(char, 0.0)]] * run
        i += run
    return places


def viterbi(span: str, model: np.ndarray) -> str:
    """The reading of least cost: minus log probability of its symbols plus channel costs."""
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for readings in [*lattice(span), [(" ", 0.0)]]:
        step: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for reading, price in readings:
                x, y, total = a, b, cost + price
                for char in reading:
                    s = symbol(char)
                    total -= model[x, y, s]
                    x, y = y, s
                now = (total, text + reading)
                if (x, y) not in step or now < step[x, y]:
                    step[x, y] = now
        best = step
    return min(best.values())[1][:-1]


_LETTER_BYTE = np.zeros(256, dtype=bool)
_LETTER_BYTE[65:91] = _LETTER_BYTE[97:123] = _LETTER_BYTE[128:] = True
_SIGN_BYTE = np.zeros(256, dtype=bool)
_SIGN_BYTE[48:58] = True
_SIGN_BYTE[[ord(c) for c in LEET if ord(c) < 128]] = True
_SIGN_BYTE["€".encode()[-1]] = True


def suspect_zones(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges, in order and apart, outside of which no disguised span can lie.

    A zone is one word between white space that has a sign before a letter or a letter three times in
    a row, or a row of three or more one-letter words.
    """
    n = len(data)
    if n < 3:
        return []
    low = LOWER[data]
    letter = _LETTER_BYTE[data]
    flags = np.flatnonzero(_SIGN_BYTE[data][:-1] & letter[1:])
    same = low[1:] == low[:-1]
    triple = np.flatnonzero(same[1:] & same[:-1] & letter[2:] & (data[2:] < 128))
    pair = data[2:] == data[:-2]
    wide = np.flatnonzero(pair[:-3] & pair[1:-2] & pair[2:-1] & pair[3:] & (data[:-5] >= 0xC0)) if n >= 6 else triple[:0]
    tokens = Words(data, offsets, NOT_SPACE)
    at = np.searchsorted(tokens.starts, np.concatenate([flags, triple, wide]), side="right") - 1
    at = np.unique(at[at >= 0])
    found = Words(data, offsets, ALNUM)
    length = found.ends - found.starts
    single = ((length == 1) & letter[found.starts]) | ((length == 2) & (data[found.starts] >= 0xC0)) if len(found) else np.zeros(0, bool)
    texts = found.texts()
    linked = single[1:] & single[:-1] & (found.starts[1:] - found.ends[:-1] <= 2) & (texts[1:] == texts[:-1])
    runs = np.flatnonzero(linked[1:] & linked[:-1]) if len(linked) > 1 else np.zeros(0, np.int64)
    left = np.searchsorted(tokens.starts, found.starts[runs], side="right") - 1 if len(runs) else runs
    right = np.searchsorted(tokens.starts, found.starts[runs + 2], side="right") - 1 if len(runs) else runs
    spans = sorted([*zip(at.tolist(), at.tolist()), *zip(left.tolist(), right.tolist())])
    zones: list[tuple[int, int]] = []
    for first, last in spans:
        start, end = int(tokens.starts[first]), int(tokens.ends[last])
        if zones and start < zones[-1][1]:
            zones[-1] = (zones[-1][0], max(end, zones[-1][1]))
        else:
            zones.append((start, end))
    return zones


def restore_slice(data: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with their disguised spans read."""
    out, last = [], 0
    growth = np.zeros(len(offsets), dtype=np.int64)
    for start, end in suspect_zones(data, offsets):
        old = data[start:end].tobytes().decode("utf-8", "replace")
        new = _SPAN.sub(lambda m: viterbi(m[0].lower(), model), old)
        if new != old:
            raw = new.encode()
            out += [data[last:start], np.frombuffer(raw, dtype=np.uint8)]
            growth[np.searchsorted(offsets, start, side="right")] += len(raw) - (end - start)
            last = end
    if not out:
        return data, offsets
    return np.concatenate([*out, data[last:]]), offsets + np.cumsum(growth)


def restore(text: str, model: np.ndarray) -> str:
    """The text with its disguised spans read."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return restore_slice(raw, np.array([0, len(raw)]), model)[0].tobytes().decode()


def _features(found: Words) -> np.ndarray:
    """Feature buckets of each word: the word and its first bytes (words x features)."""
    sums = found.prefix_sums()
    length = found.ends - found.starts
    columns = [found.hashes(sums)]
    for n in STEMS:
        ends = np.minimum(found.starts + n, found.ends)
        columns.append(np.where(length > n, found.hashes(sums, ends) ^ np.uint64(0x5DEECE66D), columns[0]))
    return (np.stack(columns, axis=1) % np.uint64(FEATURES)).astype(np.int64)


def feature_counts(taught: DataFrame, model: np.ndarray) -> DataFrame:
    """(label, bucket, n): learning documents that hold each feature; bucket -1 counts documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {y: np.zeros(FEATURES + 1, dtype=np.int64) for y in (0, 1)}
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist())
            for i, j, data, offsets in slices(batch.column(0)):
                data, offsets = restore_slice(data, offsets, model)
                found = Words(LOWER[data], offsets, ALNUM)
                pairs = np.unique(found.texts()[:, None] * FEATURES + _features(found))
                owner = labels[i:j][pairs // FEATURES]
                for y in (0, 1):
                    totals[y][:-1] += np.bincount(pairs[owner == y] % FEATURES, minlength=FEATURES)
                    totals[y][-1] += (labels[i:j] == y).sum()
        for y, counts in totals.items():
            seen = np.flatnonzero(counts)
            buckets = np.where(seen == FEATURES, -1, seen).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"label": pa.array(np.full(len(seen), y, np.int32)), "bucket": pa.array(buckets), "n": pa.array(counts[seen])})

    rows = taught.select("text", "label").mapInArrow(count, "label int, bucket int, n long")
    return rows.groupBy("label", "bucket").agg(F.sum("n").alias("n"))


class FeatureTable:
    """Learning documents of each label that hold each feature, and the weights that follow."""

    def __init__(self, counts: pa.Table):
        self.n = np.zeros((2, FEATURES), dtype=np.float32)
        self.documents = np.zeros(2)
        label, bucket, value = (counts.column(c).to_numpy() for c in ("label", "bucket", "n"))
        own = bucket < 0
        self.n[label[~own], bucket[~own]] = value[~own]
        self.documents[label[own]] = value[own]
        self.flat = self.weights(self.n[1], self.n[0], self.documents)

    def weights(self, toxic: np.ndarray, clean: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Log odds, 0 for a feature that says nothing, smoothed towards the share of toxic documents."""
        if not (documents > 0).all():
            return np.zeros(toxic.shape, dtype=np.float32)
        prior = PRIOR * documents / documents.sum()
        rate = [(n + p) / (d + p) for n, p, d in zip((clean, toxic), prior, documents)]
        return np.log(rate[1] / rate[0]).astype(np.float32)

    def strengths(self, grid: np.ndarray) -> np.ndarray:
        return self.flat[grid]

    def strengths_without(self, grid: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Weights of learning words as if their own document had not been counted."""
        out = np.zeros(grid.shape, dtype=np.float32)
        for y in (0, 1):
            rows = labels == y
            less = [self.n[k][grid[rows]] - (k == y) for k in (0, 1)]
            out[rows] = self.weights(less[1], less[0], self.documents - np.array([y == 0, y == 1]))
        return out


def pooled(found: Words, features: FeatureTable, labels: np.ndarray | None = None) -> np.ndarray:
    """What the classifier sees of each text: its strongest word, and how many and how much is strong.

    ``labels`` are given for learning texts, whose own counts are then taken out.
    """
    n = len(found.offsets) - 1
    texts = found.texts()
    strength = np.zeros(0, np.float32)
    if len(found):
        grid = _features(found)
        strength = (features.strengths(grid) if labels is None else features.strengths_without(grid, labels[texts])).max(axis=1)
    out = np.zeros((n, 4))
    strong = strength > STRONG
    np.maximum.at(out[:, 0], texts[strong], strength[strong])
    out[:, 1] = np.log1p(np.bincount(texts[strong], weights=strength[strong], minlength=n))
    out[:, 2] = np.log1p(np.bincount(texts[strong], minlength=n))
    out[:, 3] = out[:, 2] - np.log1p(np.diff(found.bounds))
    out[np.diff(found.bounds) == 0, 3] = -1
    return out


class ToxicityModel:
    def __init__(self, characters: np.ndarray, features: FeatureTable, classifier: tuple):
        self.characters, self.features, self.classifier = characters, features, classifier


def fit(docs: DataFrame, taught: DataFrame, text: str = "text") -> ToxicityModel:
    """``taught``: (text, label), a bounded sample."""
    characters = character_model(docs, text)
    features = FeatureTable(feature_counts(taught, characters).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast((characters, features))

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held = shared.value
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist())
            for i, j, data, offsets in slices(batch.column(0)):
                data, offsets = restore_slice(data, offsets, model)
                x = pooled(Words(LOWER[data], offsets, ALNUM), held, labels[i:j])
                yield pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64())), "label": batch.column(1).slice(i, j - i)})

    rows = taught.select("text", "label").mapInArrow(points, "x array<double>, label int").toArrow()
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(-1, 4)
    y = rows.column("label").to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the fit does not depend on the order in which rows arrive
    features.n = None
    return ToxicityModel(characters, features, logistic_fit(x[order], y[order]))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with restored text and score, which replace kept columns so called."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in keep if c not in ("restored", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(len(kept))):
                data, offsets = restore_slice(data, offsets, m.characters)
                value = logistic_score(m.classifier, pooled(Words(LOWER[data], offsets, ALNUM), m.features))
                buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                restored = pa.LargeStringArray.from_buffers(j - i, buffers[1], buffers[2])
                out = {c: batch.column(k).slice(i, j - i) for k, c in enumerate(kept)}
                yield pa.RecordBatch.from_pydict(out | {"restored": restored.cast(pa.string()), "score": pa.array(value)})

    schema = docs.select(*kept).schema.add("restored", StringType()).add("score", DoubleType())
    return docs.select(*kept, text).mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    taught = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", 4, 2, SAMPLE)
    held = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    scored = score(held, fit(docs, taught), keep=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
