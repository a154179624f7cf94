"""Licence scan with a positional rare-token index.

Document frequencies of all template words come from one pass over every text. Each template is
indexed by its rarest words (highest IDF) with their positions. In a text, every occurrence of an
indexed word proposes the place where its template would start; only starts on which all of the
template's indexed words agree go on (the postings are intersected by relative position). There the
mandatory key phrases must stand word by word, and the share of template words found in place is
the match's score. Both passes are narrow; the only thing shuffled is a count for each template word.

Null and empty texts have no words, no places and no label. Ties of rarity go to the smaller word.
Rows are scanned each on their own, so repeated rows give repeated results; other columns than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.common import ALNUM, LOWER, Words, slices, table, word_hash

INDEXED_WORDS = 2

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: phrases that must stand at their place; the whole text if empty
    required: tuple[str, ...] = ()
    base: bool = False


#: The contract's phrases, then notices with the phrases that make them what they are.
TEMPLATES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
)


def template_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def document_frequencies(docs: DataFrame, words: list[str], text: str = "text") -> dict[str, int]:
    """How many texts hold each of ``words`` (a template vocabulary, so the result is small)."""
    hashes = np.array([word_hash(w) for w in words], dtype=np.uint64)
    order = np.argsort(hashes)
    ranked = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                found = Words(LOWER[data], offsets, ALNUM)
                h = found.hashes()
                at = np.minimum(np.searchsorted(ranked, h), len(ranked) - 1)
                hit = np.flatnonzero(ranked[at] == h)
                pairs = np.unique(found.texts()[hit] * len(words) + at[hit])
                total += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.RecordBatch.from_pydict({"word": pa.array([words[i] for i in order]), "n": pa.array(total)})

    rows = docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in words} | {r["word"]: r["n"] for r in rows}


@dataclass
class _Compiled:
    template: Template
    hashes: np.ndarray
    indexed: list[int]  # positions of the rarest words
    required: np.ndarray  # positions that must match


def compile_templates(templates: tuple[Template, ...], frequency: dict[str, int], indexed_words: int = INDEXED_WORDS) -> list[_Compiled]:
    out = []
    for t in templates:
        words = template_words(t.text)
        first: dict[str, int] = {}
        for i, w in enumerate(words):
            first.setdefault(w, i)
        need: set[int] = set() if t.required else set(range(len(words)))
        for phrase in t.required:
            part = template_words(phrase)
            starts = [i for i in range(len(words)) if words[i : i + len(part)] == part]
            if not starts:
                raise ValueError(f"{phrase!r} does not stand in the template {t.label}")
            need.update(range(starts[0], starts[0] + len(part)))
        # only required words are indexed, so that an edit elsewhere does not hide a match
        rare = sorted((w for w in first if any(words[i] == w for i in need)), key=lambda w: (frequency.get(w, 0), w))[:indexed_words]
        place = [min(i for i in need if words[i] == w) for w in rare]
        out.append(_Compiled(t, np.array([word_hash(w) for w in words], dtype=np.uint64), place, np.array(sorted(need))))
    return out


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text", indexed_words: int = INDEXED_WORDS) -> DataFrame:
    """One row a text: doc_id, n_words, matches (array of label, base, start, score)."""
    vocabulary = sorted({w for t in templates for w in template_words(t.text)})
    compiled = compile_templates(templates, document_frequencies(docs, vocabulary, text), indexed_words)
    postings: dict[int, list[tuple[int, int]]] = defaultdict(list)  # word hash -> (template, position)
    for k, c in enumerate(compiled):
        for position in c.indexed:
            postings[int(c.hashes[position])].append((k, position))
    keys = np.array(sorted(postings), dtype=np.uint64)
    lists = [postings[int(k)] for k in keys]
    match_type = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                found = Words(LOWER[data], offsets, ALNUM)
                h, bounds = found.hashes(), found.bounds
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hits = np.flatnonzero(keys[at] == h)
                matches: list[list[dict]] = [[] for _ in range(j - i)]
                proposed: dict[int, list[np.ndarray]] = defaultdict(list)
                for word in np.unique(at[hits]):
                    where = hits[at[hits] == word]
                    for k, position in lists[word]:
                        proposed[k].append(where - position)
                for k, starts in proposed.items():
                    c = compiled[k]
                    if len(starts) < len(c.indexed):
                        continue
                    agreed = starts[0]
                    for other in starts[1:]:
                        agreed = np.intersect1d(agreed, other, assume_unique=True)
                    # required words must lie in one text; other template words may fall outside it
                    lead, tail = agreed + c.required[0], agreed + c.required[-1]
                    doc = np.searchsorted(bounds, lead, side="right") - 1
                    fits = (lead >= 0) & (tail < len(h))
                    agreed, doc = agreed[fits], doc[fits]
                    inside = (agreed + c.required[0] >= bounds[doc]) & (agreed + c.required[-1] < bounds[doc + 1])
                    agreed, doc = agreed[inside], doc[inside]
                    for start, d in zip(agreed.tolist(), doc.tolist()):
                        if (h[start + c.required] != c.hashes[c.required]).any():
                            continue
                        span = np.arange(len(c.hashes)) + start
                        ok = (span >= bounds[d]) & (span < bounds[d + 1])
                        score = float((h[span[ok]] == c.hashes[ok]).sum() / len(c.hashes))
                        first = max(start, int(bounds[d])) - int(bounds[d])
                        matches[d].append({"label": c.template.label, "base": c.template.base, "start": first, "score": score})
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(i, j - i),
                        "n_words": pa.array(np.diff(bounds).astype(np.int64)),
                        "matches": pa.array(matches, match_type),
                    }
                )

    return docs.select("doc_id", text).mapInArrow(
        run, "doc_id long, n_words long, matches array<struct<label:string,base:boolean,start:long,score:double>>"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )
