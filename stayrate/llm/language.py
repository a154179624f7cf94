"""Language identification by mixture inference.

Byte-trigram counts of every learning text give each language a smoothed trigram model. A text is
then a mixture: each word is drawn from one language, and expectation-maximisation estimates the
proportions from the words' trigram likelihoods. The language set is the one with the best penalised
likelihood (half the logarithm of the word count for each language): the most probable language
alone, the top two, and so on up to ``MAX_SET``. The prediction is the largest proportion in it.

Counting sums trigram counts within tasks before they are shuffled; the model has one row for each
language and bucket and is broadcast: its size is languages x ``BUCKETS``, whatever the corpus. The
column ``lang`` is taken to hold a set of codes, not free text. Inference is narrow.

Null text or text without a letter: ``und`` with score 0, as is every text when nothing was learned.
Very long texts are read whole. Ties go to the language that sorts first. Repeated rows are
predicted each on their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from stayrate.llm.common import ALNUM, LOWER, Words, fold, segment_sums, slices, table

BUCKETS = 1 << 15
SMOOTHING = 0.1
#: Neighbouring trigrams share characters; their summed log likelihood counts for a third.
TEMPER = 1 / 3
MAX_SET = 3
STEPS = 8
UNKNOWN = "und"


class _Trigrams:
    """Trigram buckets at every byte of every word of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, ALNUM)
        inside = ALNUM[data]
        plain = np.where(inside, LOWER[data], 32).astype(np.uint32)
        before, after = np.empty_like(plain), np.empty_like(plain)
        before[1:], after[:-1] = plain[:-1], plain[1:]
        starts, ends = self.words.starts, self.words.ends
        before[starts] = 32
        after[ends - 1] = 32
        code = ((before << 16) | (plain << 8) | after)[inside]
        self.buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)
        self.bounds = np.concatenate([[0], np.cumsum(ends - starts)])


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all texts with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for i, j, data, offsets in slices(batch.column(1)):
                grams = _Trigrams(data, offsets)
                at = grams.bounds[grams.words.bounds]
                for name in set(langs[i:j]):
                    rows = np.flatnonzero(langs[i:j] == name)
                    part = np.concatenate([grams.buckets[at[r] : at[r + 1]] for r in rows])
                    counts = np.bincount(part, minlength=BUCKETS)
                    totals[name] = totals[name] + counts if name in totals else counts
        for name, counts in totals.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * len(seen)), "bucket": pa.array(seen.astype(np.int32)), "n": pa.array(counts[seen].astype(np.int64))}
            )

    learned = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    return learned.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in sorted order and the log probability of each bucket in each of them."""
    rows = trigram_counts(docs, text, lang).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    column = np.searchsorted(np.array(names, dtype=object), np.array(rows.column("lang").to_pylist(), dtype=object)) if names else []
    counts[rows.column("bucket").to_numpy(), column] = rows.column("n").to_numpy()
    return names, np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32)


def _em(ratio: np.ndarray, bounds: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    """Proportions of each text after ``steps`` rounds of expectation and maximisation."""
    share, n = start, np.diff(bounds)
    for _ in range(steps):
        weighted = ratio * np.repeat(share, n, axis=0)
        weighted /= np.maximum(weighted.sum(1, keepdims=True), 1e-30)
        share = (segment_sums(weighted, bounds) / np.maximum(n, 1)[:, None]).astype(np.float32)
    return share


def mixtures(like: np.ndarray, bounds: np.ndarray, max_set: int = MAX_SET, steps: int = STEPS) -> np.ndarray:
    """Language proportions of each text (rows) under its best set, from word log likelihoods."""
    docs, n_lang = len(bounds) - 1, like.shape[1]
    n = np.diff(bounds)
    peak = like.max(1, keepdims=True)
    ratio = np.exp(like - peak)
    base = segment_sums(peak[:, 0].astype(np.float64), bounds)
    full = _em(ratio, bounds, np.full((docs, n_lang), 1 / n_lang, np.float32), steps)
    single = segment_sums(like.astype(np.float64), bounds)
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = 0.5 * np.log(np.maximum(n, 2))
    top = single.argmax(1)
    best = np.zeros((docs, n_lang))
    best[np.arange(docs), top] = 1
    value = single[np.arange(docs), top] - penalty
    for size in range(2, min(max_set, n_lang) + 1):
        allowed = np.zeros((docs, n_lang), np.float32)
        np.put_along_axis(allowed, order[:, :size], 1 / size, axis=1)
        share = _em(ratio, bounds, allowed, steps)
        mixed = (ratio * np.repeat(share, n, axis=0)).sum(1)
        now = base + segment_sums(np.log(np.maximum(mixed, 1e-30)).astype(np.float64), bounds) - size * penalty
        better = now > value
        best[better], value[better] = share[better], now[better]
    return best


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score and languages (the set with its proportions), which replace kept
    columns so called."""
    names, table_ = model
    shared = docs.sparkSession.sparkContext.broadcast(table_)
    kept = [c for c in keep if c not in ("lang_pred", "score", "languages")]
    set_type = pa.map_(pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            lettered = np.array(batch.column(len(kept) + 1).to_pylist(), dtype=bool)
            for i, j, data, offsets in slices(batch.column(len(kept))):
                n = j - i
                share = np.zeros((n, max(len(names), 1)))
                if names:
                    grams = _Trigrams(data, offsets)
                    like = segment_sums(weights[grams.buckets], grams.bounds) * np.float32(TEMPER)
                    share = mixtures(like, grams.words.bounds)
                ok = lettered[i:j] & bool(names)
                pick = share.argmax(1)
                langs = [names[p] if good else UNKNOWN for p, good in zip(pick, ok)]
                score = np.where(ok, share[np.arange(n), pick], 0.0)
                sets = [[(names[c], float(row[c])) for c in np.flatnonzero(row > 0)] if good else [] for row, good in zip(share, ok)]
                out = {c: batch.column(k).slice(i, n) for k, c in enumerate(kept)}
                yield pa.RecordBatch.from_pydict(out | {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(score), "languages": pa.array(sets, set_type)})

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    schema = docs.select(*kept).schema
    schema = schema.add("lang_pred", StringType()).add("score", DoubleType()).add("languages", MapType(StringType(), DoubleType()))
    return docs.select(*kept, text, has_letter.alias("_lettered")).mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 4) != 2))
    held = docs.withColumn("held_out", fold("doc_id", 4) == 2)
    return predict(held, model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score", "languages")
