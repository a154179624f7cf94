"""Benchmark decontamination by latent semantic retrieval.

1. Passages of ``PASSAGE`` words from all texts form a TF-IDF matrix over hashed words; IDF counts
   passages of the whole corpus.
2. A randomised SVD finds its leading right singular vectors, from the passages of all texts and of the
   benchmark, so that no item lies outside of them: one pass multiplies a random matrix by
   the passages and back (task by task, summed as tables of fixed size), and from that product alone the
   driver has the eigenvectors (Nystroem's approximation of the passages' products).
3. Benchmark items and overlapping windows of every text are projected; a window whose cosine with
   an item is at least ``COSINE`` is a candidate. So is every window that holds as many of the item's
   rarest words as a copy must: if a copy has at least r of an item's n words in order, it has at least
   k of any n - r + k of them. Items are a stated query set and are compared in blocks of
   ``ITEM_BLOCK``, each block one narrow pass over the texts.
4. A candidate's region is checked word by word: the longest common subsequence with the item must
   reach ``EXACT`` of its words, or ``LOOSE`` of them while the answer stands there too, in a window of
   such a cosine or in as many words as the item has (chance reaches ``LOOSE`` in longer ones). The answer is
   the last quarter of the item's words; ``ANSWER`` of it must be in the region.

Every text is read whole and every candidate is checked. Results are pairs of texts and items.
Null or empty texts and items match nothing; items of fewer than ``LEAST`` words must match exactly.
Repeated rows give repeated results. Equal best regions: the first one is reported. Extra columns are
ignored. Words are runs of letters, digits and non-ASCII characters, lower-cased in ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.blocks import bucket_count
from stayrate.llm.common import ALNUM, LOWER, NUMBERS, Words, number_blocks, ranges, segment_sums, slices, summed_blocks, table, text_bytes

BUCKETS = 1 << 14
RANK = 48
EXTRA = 8
STEP = 12  # words between window starts
PASSAGE = 48
COSINE = 0.4
EXACT = 0.75
LOOSE = 0.5
ANSWER = 0.6
LEAST = 8
ITEM_BLOCK = 20_000
TOGETHER = 5  # candidate regions in a row that are first checked as one
PROBE_ITEMS = 256  # items whose rare words are looked up at a time


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a slice and where each text's begin."""
    found = Words(LOWER[data], offsets, ALNUM)
    return found.hashes(), found.bounds


def _units(bounds: np.ndarray, size: int) -> np.ndarray:
    """Starts of pieces of ``size`` words (the last one of a text may be shorter), and the end."""
    n = np.diff(bounds)
    pieces = -(-n // size)
    owner = np.repeat(np.arange(len(n)), pieces)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.append(bounds[:-1][owner] + rank * size, bounds[-1])


def passage_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, float]:
    """Passages that hold each word bucket, and the number of passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                h, bounds = _words(data, offsets)
                cuts = _units(bounds, PASSAGE)
                passage = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
                pairs = np.unique(passage * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
                total[:-1] += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
                total[-1] += len(cuts) - 1
        yield number_blocks(total)

    total = summed_blocks(docs.select(text).mapInArrow(count, NUMBERS), BUCKETS + 1)
    return total[:-1], total[-1]


def _passages(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray, basis: np.ndarray):
    """Buckets, TF-IDF weights (passages have length 1) and projected passages of a slice."""
    h, bounds = _words(data, offsets)
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    cuts = _units(bounds, PASSAGE)
    passage = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    key, inverse, times = np.unique(passage * BUCKETS + bucket, return_inverse=True, return_counts=True)
    weight = (times * idf[key % BUCKETS]).astype(np.float32)
    owner = key // BUCKETS
    ends = np.searchsorted(owner, np.arange(len(cuts)))
    norm = np.sqrt(segment_sums(weight**2, ends))
    weight /= np.maximum(norm[owner], 1e-12)
    projected = segment_sums(basis[key % BUCKETS] * weight[:, None], ends)
    return key % BUCKETS, owner, weight, projected


def latent_basis(docs: DataFrame, idf: np.ndarray, text: str = "text", rank: int = RANK, extra: int = EXTRA, seed: int = 23) -> np.ndarray:
    """Word bucket by dimension: the passages' leading right singular vectors over singular values.

    Dividing by the singular values gives every dimension the same spread over the corpus; without
    it the words that all passages share decide the cosine.
    """
    width = rank + extra
    context = docs.sparkSession.sparkContext
    start = np.random.default_rng(seed).normal(size=(BUCKETS, width)).astype(np.float32)
    shared = context.broadcast((idf.astype(np.float32), start))

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, basis = shared.value
        total = np.zeros((BUCKETS, width))
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                bucket, owner, weight, y = _passages(data, offsets, weights, basis)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
                total += segment_sums(y[owner[order]] * weight[order, None], ends)
        yield number_blocks(total)

    image = summed_blocks(docs.select(text).mapInArrow(there_and_back, NUMBERS), BUCKETS * width).reshape(BUCKETS, width)
    return leading_vectors(image, start.astype(np.float64), rank)


def leading_vectors(image: np.ndarray, start: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors over the roots of their eigenvalues, of a matrix that turned ``start`` into ``image``."""
    met = start.T @ image
    values, vectors = np.linalg.eigh((met + met.T) / 2)
    keep = values > 1e-6 * max(values.max(), 1e-30)  # what single-precision sums leave of a smaller one is noise
    left, spread, _ = np.linalg.svd(image @ vectors[:, keep] / np.sqrt(values[keep]), full_matrices=False)
    found = np.zeros((len(image), rank), np.float32)
    found[:, : min(rank, len(spread))] = (left / np.maximum(spread, 1e-15))[:, :rank]
    return found


def common_subsequence(rows: list[int], length: int) -> int:
    """Length of the longest common subsequence of an item and a region.

    ``rows``: for each region word that the item has, the item's places of it as bits.
    """
    everything = (1 << length) - 1
    state = everything
    for places in rows:
        both = state & places
        state = ((state + both) | (state - both)) & everything
    return length - state.bit_count()


@dataclass
class Item:
    item_id: int | None
    words: list[int]
    masks: dict[int, int]
    answer: frozenset[int]


def make_item(item_id: int | None, words: list[int]) -> Item:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return Item(item_id, words, masks, frozenset(words[-max(1, len(words) // 4) :]))


def check_region(item: Item, region: list[int]) -> tuple[float, float]:
    """Share of the item in the region's common subsequence, share of the answer in the region.

    A region that has too few of the item's words for any decision is not aligned: (0, 0).
    """
    rows = [*filter(None, map(item.masks.get, region))]
    length = len(item.words)
    covered = 0
    for places in rows:
        covered |= places
    if len(rows) < LOOSE * length or covered.bit_count() < LOOSE * length:
        return 0.0, 0.0
    return common_subsequence(rows, length) / length, len(item.answer.intersection(region)) / len(item.answer)


def is_leak(item: Item, lcs: float, answer: float) -> bool:
    if len(item.words) < LEAST:
        return lcs == 1.0
    return lcs >= EXACT or (lcs >= LOOSE and answer >= ANSWER)


def holds_close_together(item: Item, region: list[int]) -> bool:
    """Whether some part of a region, as long as the item, holds it."""
    size = len(item.words)
    starts = range(max(1, len(region) - size + 1))
    return any(is_leak(item, *check_region(item, region[i : i + size])) for i in starts)


def leak_regions(item: Item, words: list[int], regions: list[tuple[int, int, bool]]) -> Iterator[tuple[float, float, int, int]]:
    """Those of some regions in a row (first word, last word, near by cosine) that hold the item.

    No region has more of it than all together.
    """
    if len(regions) > 1 and not is_leak(item, *check_region(item, words[regions[0][0] : regions[-1][1]])):
        return
    for begin, end, near in regions:
        lcs, answer = check_region(item, words[begin:end])
        if is_leak(item, lcs, answer) and (near or lcs >= EXACT or holds_close_together(item, words[begin:end])):
            yield lcs, answer, begin, end


def _window_units(length: int) -> int:
    """Steps that a window for an item of so many words spans; any place of the item lies in one."""
    return max(2, -(-length // STEP) + 1)


class Probes:
    """Rare words of some items, by word: what holds ``share`` of an item has ``least`` of its rare words.

    They are looked for in whole regions, or ``tight``: in as many words as the item has.
    """

    def __init__(self, items: list[Item], first: int, idf: np.ndarray, share: float, tight: bool):
        words, owner, least = [], [], []
        for i, item in enumerate(items):
            need = int(np.ceil(len(item.words) * (1.0 if len(item.words) < LEAST else share)))
            few = -(-need // 3)
            rarest = sorted(item.words, key=lambda w: (-idf[w % BUCKETS], w))[: len(item.words) - need + few]
            own = set(rarest)
            words += own
            owner += [i] * len(own)
            least.append(few)
        held, at = np.array(words, np.uint64), np.array(owner, np.int64)
        order = np.lexsort((at, held))
        self.first, self.least, self.tight = first, np.array(least, np.int64), tight
        self.words, starts = np.unique(held[order], return_index=True)
        self.starts, self.items = np.append(starts, len(held)), at[order]
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.length = np.array([len(i.words) for i in items], np.int64)
        self.units = np.array([_window_units(len(i.words)) for i in items], np.int64)

    def windows(self, h: np.ndarray, cuts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items of all places with enough rare words."""
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        word = np.searchsorted(self.words, h[at])
        same = self.words[np.minimum(word, len(self.words) - 1)] == h[at]
        at, word = at[same], word[same]
        times = self.starts[word + 1] - self.starts[word]
        item = self.items[ranges(self.starts[word], times)]
        hits = np.sort(item * len(h) + np.repeat(at, times))
        item, place = hits // len(h), hits % len(h)
        last = np.arange(len(hits)) + self.least[item] - 1
        fits = last < len(hits)
        item, start, last = item[fits], place[fits], last[fits]
        stop, same = place[last], hits[last] // len(h) == item
        # a region takes in the piece before its window and the one after it
        same &= stop - start < (self.length[item] if self.tight else (self.units[item] + 2) * STEP)
        item, start, stop = item[same], start[same], stop[same]
        text_of = np.repeat(owner, np.diff(cuts))
        same = text_of[start] == text_of[stop]
        item, start, stop = item[same], start[same], stop[same]
        piece = np.repeat(np.arange(len(owner)), np.diff(cuts))
        text = text_of[start]
        if self.tight:
            low, high = piece[np.maximum(stop - self.length[item] + 1, 0)], piece[start]
        else:
            low, high = piece[stop] - self.units[item], piece[start] + 1
        low = np.maximum(low, np.searchsorted(owner, text))
        high = np.minimum(high, np.searchsorted(owner, text, side="right") - 1)
        some = low <= high
        keys = np.unique(np.repeat(item[some], (high - low + 1)[some]) * len(owner) + ranges(low[some], (high - low + 1)[some]))
        return keys % len(owner), keys // len(owner) + self.first


#: Items, and cells of windows by items, that are compared at once: a tile of the cosines stays in the cache.
TILE_ITEMS = 1024
TILE_CELLS = 1 << 18


class Queries:
    """A block of items: projected unit vectors by window size."""

    def __init__(self, items: list[Item], idf: np.ndarray, basis: np.ndarray):
        self.items = items
        self.idf, self.basis = idf, basis
        weighted = basis * idf[:, None]
        vectors = np.array([weighted[np.array(i.words, dtype=np.uint64) % np.uint64(BUCKETS)].sum(0) for i in items]).reshape(len(items), basis.shape[1])
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        units = np.array([_window_units(len(i.words)) for i in items], np.int64)
        self.groups = [(int(u), np.flatnonzero(units == u), vectors[units == u].astype(np.float32)) for u in np.unique(units)]
        self.weighted = weighted.astype(np.float32)
        self.units = units
        parts = [(items[i : i + PROBE_ITEMS], i) for i in range(0, len(items), PROBE_ITEMS)]
        self.probes = [Probes(*part, idf, *kind) for part in parts for kind in ((EXACT, False), (LOOSE, True))]


def _search(h: np.ndarray, bounds: np.ndarray, queries: Queries, cosine: float) -> Iterator[tuple[int, int, list[tuple[int, int, bool]]]]:
    """(text, item, candidate regions in a row) of a slice."""
    cuts = _units(bounds, STEP)
    if len(cuts) < 2:
        return
    pieces = segment_sums(queries.weighted[h % np.uint64(BUCKETS)], cuts)
    owner = np.searchsorted(bounds, cuts[:-1], side="right") - 1
    n = len(pieces)
    sums = np.concatenate([np.zeros((1, pieces.shape[1]), np.float64), np.cumsum(pieces, axis=0, dtype=np.float64)])
    last_of = np.searchsorted(owner, owner, side="right")  # one past each text's last piece
    close, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for units, at, vectors in queries.groups:
        stop = np.minimum(np.arange(n) + units, last_of)
        window = (sums[stop] - sums[np.arange(n)]).astype(np.float32)
        window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-12)
        for first in range(0, len(vectors), TILE_ITEMS):
            some = vectors[first : first + TILE_ITEMS].T
            rows = max(1, TILE_CELLS // some.shape[1])
            for a in range(0, n, rows):
                place, which = np.nonzero(window[a : a + rows] @ some >= cosine)
                close.append(at[first + which] * n + a + place)
    for probes in queries.probes:
        place, which = probes.windows(h, cuts, owner)
        held.append(which * n + place)
    near = np.sort(np.concatenate(close))
    keys = np.unique(np.concatenate([near, *held]))
    by_cosine = np.zeros(len(keys), dtype=bool)
    by_cosine[np.searchsorted(keys, near)] = True
    place, which = keys % n, keys // n
    text = owner[place]
    begin = np.maximum(bounds[text], cuts[place] - STEP)
    end = np.minimum(bounds[text + 1], cuts[np.minimum(place + queries.units[which], last_of[place])] + STEP)
    apart = np.ones(len(keys), dtype=bool)
    apart[1:] = (keys[1:] != keys[:-1] + 1) | (text[1:] != text[:-1]) | (which[1:] != which[:-1])
    row = np.flatnonzero(apart)
    rank = np.arange(len(keys)) - np.repeat(row, np.diff(np.append(row, len(keys))))
    first = np.flatnonzero(rank % TOGETHER == 0)
    regions = list(zip(begin.tolist(), end.tolist(), by_cosine.tolist()))
    for f, l, t, w in zip(first.tolist(), np.append(first[1:], len(keys)).tolist(), text[first].tolist(), which[first].tolist()):
        yield t, w, regions[f:l]


LEAK_SCHEMA = "doc_id long, item_id long, lcs double, answer double, first_word long, last_word long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", cosine: float = COSINE) -> DataFrame:
    """One row for each text and item that it holds: doc_id, item_id, lcs, answer, place in words."""
    frequency, passages = passage_frequencies(docs, text)
    idf = np.log((2 + passages) / (1 + frequency))
    basis = latent_basis(docs.select(text).union(benchmark.select("text")), idf, text)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").alias("text")).where("text is not null").distinct()
    blocks = bucket_count(items.count(), ITEM_BLOCK)
    found = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").toArrow()
        data, offsets = text_bytes(rows.column("text"))
        h, bounds = _words(data, offsets)
        made = [make_item(i, h[a:b].tolist()) for i, a, b in zip(rows.column("item_id").to_pylist(), bounds[:-1], bounds[1:]) if b > a]
        part = _find_block(docs, Queries(made, idf, basis), text, cosine)
        found = part if found is None else found.union(part)
    return found


def _find_block(docs: DataFrame, queries: Queries, text: str, cosine: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            ids = batch.column(0)
            out: list[tuple] = []
            for i, _, data, offsets in slices(batch.column(1)):
                h, bounds = _words(data, offsets)
                words = h.tolist()
                best: dict[tuple[int, int], tuple] = {}
                for doc, which, regions in _search(h, bounds, held, cosine):
                    for lcs, answer, begin, end in leak_regions(held.items[which], words, regions):
                        now = (lcs, answer, -begin, end)
                        if now > best.get((doc, which), (-1.0,)):
                            best[doc, which] = now
                for (doc, which), (lcs, answer, begin, end) in sorted(best.items()):
                    out.append((ids[i + doc].as_py(), held.items[which].item_id, lcs, answer, -begin - int(bounds[doc]), end - int(bounds[doc])))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            names = ["doc_id", "item_id", "lcs", "answer", "first_word", "last_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, LEAK_SCHEMA)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
