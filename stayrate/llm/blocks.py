"""Blocks of numbers that travel together.

A shuffle of billions of single (key, document, place) rows costs far more than the numbers in them.
Here a task packs its entries by bucket of the key: a block holds a ``head`` (one record for each
document that has entries in the bucket, with their count ``n``) and a ``body`` (one record for each
entry). Spark shuffles the blocks by bucket; the number of buckets follows the bytes of the corpus, so
a bucket stays about the same size whatever the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_SCHEMA = "bucket int, head binary, body binary"


def corpus_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def bucket_count(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


def pack(bucket: np.ndarray, body: np.ndarray, owner: np.ndarray, heads: np.ndarray) -> pa.RecordBatch:
    """Blocks of the entries ``body``; ``owner`` is each entry's place in ``heads`` (with a field n)."""
    order = np.lexsort((owner, bucket))
    bucket, body, owner = bucket[order], body[order], owner[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))
    rows: tuple[list, list, list] = ([], [], [])
    for a, b in zip(cuts, ends):
        part = owner[a:b]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        head = heads[part[first]].copy()
        head["n"] = np.diff(np.append(first, b - a))
        rows[0].append(int(bucket[a]))
        rows[1].append(head.tobytes())
        rows[2].append(body[a:b].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["bucket", "head", "body"]
    )


def unpack(heads: pa.Array, bodies: pa.Array, head: np.dtype, body: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All heads, all entries, and each entry's place among the heads."""
    all_heads = np.concatenate([np.frombuffer(x.as_buffer(), dtype=head) for x in heads] or [np.zeros(0, head)])
    all_bodies = np.concatenate([np.frombuffer(x.as_buffer(), dtype=body) for x in bodies] or [np.zeros(0, body)])
    return all_heads, all_bodies, np.repeat(np.arange(len(all_heads)), all_heads["n"])


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted ``keys`` starts."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)

