"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text; a chunk ends where the hash is the least within
``REACH`` bytes on either side, or half of it among words so short that ``CROWD`` begin within reach.
In a periodic stretch, where the least comes again and again, the chunks are whole periods, at least
``REACH`` bytes of them, so they are alike in every such stretch. Cuts depend only on the bytes around them, so an insertion moves the
cuts near it and no others, and a passage is cut alike wherever it stands. Chunks are deduplicated by
a 64-bit digest: the first text that holds a chunk (by doc_id) keeps it, all others repeat it.
Consecutive chunks that other texts hold make a span; spans of at least ``MIN_BYTES`` or ``MIN_WORDS``
count. A passage loses at most the two chunks that its ends cut, so with the defaults a repeated passage
of more than 50 words is found (chunks have no greatest length, so this is measured, not certain: see
the tests for short words, numbers and periods), and a repeated line is not.

Each task first collapses the digests that repeat within it, so a digest that a third of all texts
hold reaches its bucket once a task. Only digests with places are shuffled, in blocks, there and back;
texts are not. Removing spans joins the few numbers of each text back to it.

Null and empty texts have no chunk. Rows equal in doc_id and text count as one row (they get the same
spans and do not repeat each other); a null doc_id sorts first. Extra columns pass through
``remove_repeats`` untouched. What a text repeats only within itself is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stayrate.llm.blocks import BLOCK_SCHEMA, bucket_count, corpus_bytes, pack, runs, unpack
from stayrate.llm.common import NOT_SPACE, Words, mix, slices, stored, table

REACH = 12
MIN_BYTES = 90
MIN_WORDS = 16
CROWD = 8
BUCKET_BYTES = 24 << 20  # bytes of text whose chunks share a bucket
TASK_CHUNKS = 500_000  # chunks that a task collapses and packs at a time

_GEAR = (mix(np.arange(256, dtype=np.uint64), 3) >> np.uint64(32)).astype(np.uint32)
_NULL_ID = -(1 << 63)

HEAD = np.dtype([("doc", "<i8"), ("text", "<u8"), ("home", "<i4"), ("n", "<u4")])
BODY = np.dtype([("digest", "<u8"), ("start", "<u4"), ("length", "<u4"), ("words", "<u4"), ("local", "u1")])
FLAG = np.dtype([("start", "<u4"), ("length", "<u4"), ("words", "<u4"), ("first", "u1")])


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes up to each byte: every step shifts by one and adds a byte's value."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i+width]`` for each i that has so many after it."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _minima(h: np.ndarray, reach: int, inside, ties: bool) -> np.ndarray:
    """Places ``inside`` whose hash is the least within reach; with ``ties``, of equal ones a period apart every so many."""
    least = _least(h, reach)  # least[i]: i .. i+reach-1
    middle = np.arange(reach, len(h) - reach)
    left = least[middle - reach]
    low = (h[middle] <= left) & (h[middle] <= least[middle + 1])
    again = low & (h[middle] == left)
    strict, again = inside(middle[low & ~again]), inside(middle[again])
    if not ties or not len(again):
        return strict
    gap = np.diff(again, prepend=again[0] - reach - 1)
    new = gap > reach
    new[2:] |= (gap[2:] != gap[1:-1]) & ~new[1:-1]
    row = np.flatnonzero(new)
    size = np.diff(np.append(row, len(again)))
    period = np.where(size > 1, np.append(again, 0)[np.minimum(row + 1, len(again))] - again[row], reach)
    every = np.repeat(-(-reach // period), size)
    return np.union1d(strict, again[(np.arange(len(again)) - np.repeat(row, size)) % every == 0])


def cut_ends(data: np.ndarray, offsets: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Sorted ends of the chunks of a slice; every text's end is one."""
    n = len(data)
    ends = offsets[1:][np.diff(offsets) > 0]
    if n > 2 * reach:
        h = gear(data)

        def inside(cut: np.ndarray) -> np.ndarray:
            # a cut must see only its own text: 15 bytes more to the left for the hash
            begin = np.searchsorted(offsets, cut, side="right") - 1
            return cut[(cut - offsets[begin] >= reach + 15) & (offsets[begin + 1] - cut > reach)]

        cut = _minima(h, reach, inside, ties=True)
        near = _minima(h, reach // 2, inside, ties=False)
        plain = NOT_SPACE[data]
        begun = np.cumsum(plain[1:] & ~plain[:-1])  # words that begin at 1 .. i+1
        cut = np.union1d(cut, near[begun[near + reach - 1] - begun[near - reach] >= CROWD])
        ends = np.union1d(ends, cut + 1)
    return ends


def chunk(data: np.ndarray, offsets: np.ndarray, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start within the text, length and digest of every chunk of a slice."""
    ends = cut_ends(data, offsets, reach)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends.astype(np.int64)
    found = Words.__new__(Words)
    found.data, found.offsets, found.starts, found.ends = data, offsets, starts, ends.astype(np.int64)
    length = ends - starts
    digest = mix(found.hashes() ^ length.astype(np.uint64), 21)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return doc, starts - offsets[doc], length, digest


def chunk_words(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words that begin in each chunk (places in the slice)."""
    starts = Words(data, offsets, NOT_SPACE).starts
    return np.searchsorted(starts, begin + length) - np.searchsorted(starts, begin)


def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = Words.__new__(Words)
    found.data, found.offsets, found.starts, found.ends = data, offsets, offsets[:-1], offsets[1:]
    return found.hashes()


def _flag_rows(heads: np.ndarray, owner: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    """Flags of chunks packed for the task that their texts came from."""
    return pack(heads["home"][owner], flags, owner, heads)


def chunk_blocks(docs: DataFrame, buckets: int, text: str = "text", reach: int = REACH) -> DataFrame:
    """Blocks by digest; bucket -1-home holds flags of chunks that were repeats within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = docs_seen = 0
        heads: list[np.ndarray] = []
        home = -1

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, docs_seen
            if not size:
                parts.clear(), heads.clear()
                docs_seen = 0
                return
            owner, start, length, digest, words = (np.concatenate(x) for x in zip(*parts))
            head = np.concatenate(heads)
            parts.clear(), heads.clear()
            size = docs_seen = 0
            order = np.lexsort((start, head["text"][owner], head["doc"][owner], digest))
            owner, start, length, digest, words = owner[order], start[order], length[order], digest[order], words[order]
            new = runs(digest)
            first = np.repeat(new, np.diff(np.append(new, len(digest))))
            # texts after the first one that holds a digest repeat it, whoever else does
            doc, txt = head["doc"][owner], head["text"][owner]
            again = (doc != doc[first]) | (txt != txt[first])
            flags = np.zeros(int(again.sum()), FLAG)
            flags["start"], flags["length"], flags["words"] = start[again], length[again], words[again]
            if len(flags):
                told = _flag_rows(head, owner[again], flags)
                yield told.set_column(0, "bucket", pa.array([-1 - b for b in told.column(0).to_pylist()], pa.int32()))
            body = np.zeros(len(digest), BODY)
            body["digest"], body["start"], body["length"], body["words"] = digest, start, length, words
            body["local"][first[again]] = 1
            kept = ~again
            yield pack((digest[kept] % np.uint64(buckets)).astype(np.int32), body[kept], owner[kept], head)

        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False), dtype=np.int64)
            if batch.num_rows:
                home = batch.column(2)[0].as_py()
            for i, j, data, offsets in slices(batch.column(1)):
                doc, start, length, digest = chunk(data, offsets, reach)
                head = np.zeros(j - i, HEAD)
                head["doc"], head["text"], head["home"] = ids[i:j], _whole(data, offsets), home
                parts.append((doc + docs_seen, start, length, digest, chunk_words(data, offsets, offsets[doc] + start, length)))
                heads.append(head)
                docs_seen += j - i
                size += len(doc)
                if size > TASK_CHUNKS:
                    yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long"), text, F.spark_partition_id().alias("_home")).mapInArrow(run, BLOCK_SCHEMA)


def _judge(rows: pa.Table) -> pa.Table:
    """Flags of the chunks of one bucket that several texts hold, packed by home."""
    if rows.num_rows and rows.column("bucket")[0].as_py() < 0:
        home = -1 - rows.column("bucket")[0].as_py()
        return rows.set_column(0, "bucket", pa.array([home] * rows.num_rows, pa.int32()))
    heads, body, owner = unpack(rows.column("head"), rows.column("body"), HEAD, BODY)
    order = np.lexsort((body["start"], heads["text"][owner], heads["doc"][owner], body["digest"]))
    body, owner = body[order], owner[order]
    doc, txt = heads["doc"][owner], heads["text"][owner]
    new = runs(body["digest"])
    count = np.diff(np.append(new, len(body)))
    first = np.repeat(new, count)
    own = (doc == doc[first]) & (txt == txt[first])
    shared = np.zeros(len(body), bool)
    if len(new):
        shared = np.repeat(~np.logical_and.reduceat(own, new) | (np.maximum.reduceat(body["local"], new) > 0), count)
    marked = np.flatnonzero(shared)
    flags = np.zeros(len(marked), FLAG)
    for name in ("start", "length", "words"):
        flags[name] = body[name][marked]
    flags["first"] = own[marked]
    return pa.Table.from_batches([_flag_rows(heads, owner[marked], flags)])


SPAN_SCHEMA = "doc_id long, text_hash long, spans array<struct<start:int,length:int,repeat:boolean>>"


def _spans(min_bytes: int, min_words: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("repeat", pa.bool_())]))
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", span)])

    def run(rows: pa.Table) -> pa.Table:
        heads, flags, owner = unpack(rows.column("head"), rows.column("body"), HEAD, FLAG)
        doc, txt = heads["doc"][owner], heads["text"][owner]
        order = np.lexsort((flags["first"], flags["start"], txt, doc))
        flags, doc, txt = flags[order], doc[order], txt[order]
        keep = runs(doc, txt, flags["start"])  # a row given twice brings its flags twice
        # a chunk flagged within a task and over all: over all it may still be the first, never within
        flags, doc, txt = flags[keep], doc[keep], txt[keep]
        n = len(flags)
        start, end = flags["start"].astype(np.int64), flags["start"].astype(np.int64) + flags["length"]
        joined = np.zeros(n, dtype=bool)
        joined[1:] = (doc[1:] == doc[:-1]) & (txt[1:] == txt[:-1]) & (start[1:] == end[:-1])
        begin = np.flatnonzero(~joined)
        last = np.append(begin[1:], n) - 1 if n else begin
        words = np.append(0, np.cumsum(flags["words"], dtype=np.int64))
        long_enough = (end[last] - start[begin] >= min_bytes) | (words[last + 1] - words[begin] >= min_words) if n else np.zeros(0, bool)
        out: dict[tuple[int, int], list[dict]] = {}
        for a, b in zip(begin[long_enough], last[long_enough]):
            spans = out.setdefault((int(doc[a]), int(txt[a].view(np.int64))), [])
            # within a span, chunks that this text holds first stay
            kinds = flags["first"][a : b + 1]
            cuts = runs(kinds)
            for c, d in zip(cuts, np.append(cuts[1:], b - a + 1)):
                spans.append({"start": int(start[a + c]), "length": int(end[a + d - 1] - start[a + c]), "repeat": bool(kinds[c] == 0)})
        ids = [None if k[0] == _NULL_ID else k[0] for k in out]
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array([k[1] for k in out], pa.int64()), pa.array(list(out.values()), span)], schema=schema)

    return run


def repeated_spans(docs: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES, reach: int = REACH, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each text with repeated passages: their byte spans, and whether this text repeats
    a passage or is its first holder."""
    buckets = bucket_count(corpus_bytes(docs, text), BUCKET_BYTES)
    blocks = chunk_blocks(docs, buckets, text, reach)
    flags = blocks.groupBy("bucket").applyInArrow(_judge, BLOCK_SCHEMA)
    # Rows equal in doc_id and text bring the same spans, in one home or in several.
    return flags.groupBy("bucket").applyInArrow(_spans(min_bytes, min_words), SPAN_SCHEMA).dropDuplicates(["doc_id", "text_hash"])


def remove_repeats(docs: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES, reach: int = REACH, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated span but its first holder's taken out of the texts.

    A cut within a character is moved inwards to the character's border.
    """
    names = docs.columns
    spans = stored(repeated_spans(docs, text, min_bytes, reach, min_words), "spans")
    cuts = spans.select(
        F.col("doc_id").alias("_repeat_id"), "text_hash", F.filter("spans", lambda s: s["repeat"]).alias("_repeat_cuts")
    ).where(F.size("_repeat_cuts") > 0)
    joined = docs.join(cuts.groupBy("_repeat_id").agg(F.collect_list(F.struct("text_hash", "_repeat_cuts")).alias("_repeat_cuts")), F.col("doc_id").cast("long").eqNullSafe(F.col("_repeat_id")), "left").drop("_repeat_id")
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, cut in enumerate(batch.column(len(names)).to_pylist()):
                if not cut or texts[i] is None:
                    continue
                raw = texts[i].encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                own = int(_whole(data, np.array([0, len(raw)])).view(np.int64)[0])
                for entry in cut:
                    if entry["text_hash"] == own:
                        keep = np.ones(len(raw), dtype=bool)
                        for s in entry["_repeat_cuts"]:
                            a, b = s["start"], s["start"] + s["length"]
                            while a < b and data[a] & 0xC0 == 0x80:
                                a += 1
                            while b > a and b < len(raw) and data[b] & 0xC0 == 0x80:
                                b -= 1
                            keep[a:b] = False
                        texts[i] = data[keep].tobytes().decode("utf-8", "replace")
            columns = [c for k, c in enumerate(batch.columns[:-1])]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = docs.schema
    schema[at].dataType = StringType()
    return joined.select(*names, "_repeat_cuts").mapInArrow(run, schema)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    repeats = F.filter("spans", lambda s: s["repeat"])
    size = lambda of: F.aggregate(of, F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return spans.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        size(F.col("spans")).alias("shared_bytes"),
        size(repeats).alias("repeated_bytes"),
    )
