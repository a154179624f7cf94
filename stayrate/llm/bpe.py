"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Spark counts the words of all texts; the most frequent ones are encoded on the executors and
compiled into one automaton that shares prefixes and suffixes. Its arcs carry outputs that add up to
the word's number, which leads to the word's token ids. The compiled file lies in the shared
scratch folder, Spark ships it to every executor, and tasks map it into memory, so all workers of an
executor share one copy. Words that the automaton does not accept are merged exactly, pair by pair
in rank order. Encoding is one narrow pass: nothing is shuffled.

Bounds: the lexicon holds ``lexicon_words`` words (65,536); a task's memo of looked-up words is
emptied when it holds ``MEMO_WORDS``. Both change speed only, never a token id.

Null text: no ids, decoded as empty text. Empty text: likewise. The special token's string inside a
text becomes the special token, as the tokenizers library does by default. Repeated rows are encoded
each on their own. Extra columns of the input are kept unless they carry an output's name.
"""

from __future__ import annotations

import functools
import json
import mmap
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stayrate.llm.common import ranges, shared_file, table

VOCABULARY = "byte_bpe_50k.json"
LEXICON_WORDS = 65_536
MEMO_WORDS = 400_000
COUNT_WORDS = 200_000
#: Tokens that are decoded at once.
DECODE_TOKENS = 1 << 17

_NEVER = 1 << 62

#: Fixed value: the byte-level pretokenisation pattern, white space spelled out by its Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and special tokens of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols, ids = byte_symbols(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces: dict[int, bytes] = {i: bytes(symbols[c] for c in s) for s, i in ids.items() if s not in self.special}
        self.pieces |= {i: s.encode() for s, i in self.special.items()}
        self.byte_ids = [0] * 256
        for symbol, byte in symbols.items():
            self.byte_ids[byte] = ids[symbol]
        self.merges: dict[tuple[int, int], int] = {}  # rank and joined id in one number
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left], ids[right]] = rank << 32 | ids[left + right]
        self.words = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word: the pair of least rank is joined until none is left."""
        parts = [self.byte_ids[b] for b in word]
        rank = self.merges.get
        while len(parts) > 1:
            ranks = [rank(pair, _NEVER) for pair in zip(parts, parts[1:])]
            least = min(ranks)
            if least == _NEVER:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [least & 0xFFFFFFFF]
        return parts

    def pretokens(self, text: str) -> list[str]:
        """Words of a text; a special token's string is a word of its own."""
        find = _QUICK_WORDS.findall if _QUICK_TEXT.fullmatch(text) else self.words.findall
        if self.split is None or not any(s in text for s in self.special):
            return find(text)
        out: list[str] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(part)
            else:
                out += find(part)
        return out

    def decode_tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat bytes of all tokens, and where each token starts and how long it is."""
        size = max(self.pieces) + 1
        parts = [self.pieces.get(i, b"") for i in range(size)]
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


#: Letters of the quick pattern: ASCII, Latin-1 and Latin Extended; every other text takes the full one.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SPACE = r"\t-\r "
_QUICK_TEXT = re.compile(rf"[\x00-\x7f{_LATIN}]*")
_QUICK_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_SPACE}{_LATIN}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- the automaton -------------------------------------------------------------------------------


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic automaton of the words, with ids by word number, as one flat file.

    Words are added in sorted order; once a branch is complete its states are replaced by an equal
    registered state, so every suffix is stored once. ``count`` words can be completed from a state;
    the output of an arc is how many words sort before the ones that pass through it, so the outputs
    along a word (plus one for each accepting state passed) sum to its number.
    """
    entries = sorted(entries)
    arcs: list[list[list[int]]] = [[]]  # state -> [label, target] in label order
    final = [False]
    register: dict[tuple, int] = {}

    def close(path: list[int], keep: int) -> None:
        for depth in range(len(path) - 1, keep, -1):
            state = path[depth]
            key = (final[state], tuple(map(tuple, arcs[state])))
            same = register.setdefault(key, state)
            arcs[path[depth - 1]][-1][1] = same

    path, last = [0], b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(path, common)
        del path[common + 1 :]
        for byte in word[common:]:
            arcs.append([])
            final.append(False)
            arcs[path[-1]].append([byte, len(arcs) - 1])
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    close(path, 0)

    order, seen = [], {0}
    stack = [0]
    while stack:
        state = stack.pop()
        order.append(state)
        for _, target in arcs[state]:
            if target not in seen:
                seen.add(target)
                stack.append(target)
    number = {s: i for i, s in enumerate(order)}
    counts: dict[int, int] = {}

    def count(root: int) -> None:
        todo = [root]
        while todo:
            state = todo[-1]
            open_ = [t for _, t in arcs[state] if t not in counts]
            if open_:
                todo += open_
                continue
            counts[state] = final[state] + sum(counts[t] for _, t in arcs[state])
            todo.pop()

    count(0)
    first, labels, targets, outputs = [], bytearray(), [], []
    for state in order:
        first.append(len(targets))
        before = int(final[state])
        for label, target in arcs[state]:
            labels.append(label)
            targets.append(number[target])
            outputs.append(before)
            before += counts[target]
    first.append(len(targets))
    flags = bytes(final[s] for s in order)
    ids = [i for _, word_ids in entries for i in word_ids]
    at = np.cumsum([0, *(len(w) for _, w in entries)])
    head = struct.pack("<4q", len(order), len(targets), len(entries), len(ids))
    numbers = [np.asarray(x, dtype="<i4").tobytes() for x in (first, targets, outputs, at, ids)]
    return head + b"".join(numbers) + bytes(labels) + flags


_BYTES = [bytes([b]) for b in range(256)]


class Lexicon:
    """A compiled lexicon over a memory-mapped file (or bytes)."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        states, arcs, words, ids = struct.unpack("<4q", view[:32])
        place = 32
        parts = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            parts.append(view[place : place + 4 * n].cast("i"))
            place += 4 * n
        self.first, self.targets, self.outputs, self.at, self.ids = parts
        self.buffer, self.labels, self.flags = buffer, place, place + arcs
        self.states, self.words = states, words

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> bytes | None:
        """The packed 32-bit ids of a word, None when the automaton does not accept it."""
        state, number = 0, 0
        find, first, labels = self.buffer.find, self.first, self.labels
        for byte in word:
            arc = find(_BYTES[byte], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            number += self.outputs[arc]
            state = self.targets[arc]
        if not self.buffer[self.flags + state]:
            return None
        return self.ids[self.at[number] : self.at[number + 1]].tobytes()


@functools.lru_cache(maxsize=2)
def shipped_lexicon(name: str) -> Lexicon:
    return Lexicon.open(SparkFiles.get(name))


@functools.lru_cache(maxsize=1)
def shared_memo(vocab: str, lexicon: str) -> _Memo:
    """One memo for all tasks that a worker runs."""
    return _Memo(vocabulary(vocab), shipped_lexicon(lexicon))


class _Memo(dict):
    """Packed ids by word: from the automaton, else by exact merging."""

    def __init__(self, words: Vocabulary, lexicon: Lexicon | None):
        super().__init__()
        self.vocabulary, self.lexicon = words, lexicon

    def __missing__(self, word: str) -> bytes:
        if word in self.vocabulary.special:
            found = struct.pack("<i", self.vocabulary.special[word])
        else:
            raw = word.encode()
            found = self.lexicon.get(raw) if self.lexicon else None
            if found is None:
                found = np.asarray(self.vocabulary.merge(raw), dtype="<i4").tobytes()
        self[word] = found
        return found


# --- the operators -------------------------------------------------------------------------------


def word_counts(docs: DataFrame, vocab: str, text: str = "text") -> DataFrame:
    """(word, n) over all texts, for choosing the lexicon.

    Texts are cut at white space and counted within a task; each distinct piece, with a space before
    it, is then cut into the tokenizer's words once. (A piece at the start of a line counts under its
    spaced form; that moves a word's rank in the lexicon and nothing else.)
    """

    def rows(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update((value.as_py() or "").split())
                if len(found) > COUNT_WORDS:
                    yield rows(found)
                    found.clear()
        yield rows(found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocab)
        for batch in batches:
            found: Counter = Counter()
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in words.pretokens(" " + word):
                    found[part] += n
            yield rows(found)

    schema = "word string, n long"
    spaced = docs.select(text).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return spaced.mapInArrow(cut, schema).groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocab: str, text: str = "text", lexicon_words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all texts and ship the file; returns its name.

    Ties of the count go to the smaller word. Only the lexicon itself comes to the driver.
    """
    spark = docs.sparkSession
    special = list(vocabulary(vocab).special)
    frequent = (
        word_counts(docs, vocab, text).where(~F.col("word").isin(special)).orderBy(F.desc("n"), "word").limit(lexicon_words)
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocab)
        for batch in batches:
            raw = [w.encode() for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"raw": pa.array(raw, pa.binary()), "ids": pa.array(map(words.merge, raw), pa.list_(pa.int32()))})

    rows = frequent.select("word").mapInArrow(encoded, "raw binary, ids array<int>").toArrow()
    entries = list(zip(rows.column("raw").to_pylist(), rows.column("ids").to_pylist()))
    return ship(spark, compile_lexicon(entries))


def ship(spark: SparkSession, content: bytes) -> str:
    """Write the lexicon to the shared folder and have Spark copy it to every executor."""
    name = f"lexicon-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(shared_file(spark, name, content))
    return name


def encode(docs: DataFrame, vocab: str | None = None, text: str = "text", lexicon: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` (array of int)."""
    vocab = vocab or default_vocabulary()
    lexicon = lexicon or build_lexicon(docs, vocab, text)
    kept = [c for c in docs.columns if c != "token_ids"]
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, memo = vocabulary(vocab), shared_memo(vocab, lexicon)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                packed = []
                for value in part.column(at):
                    value = value.as_py()
                    packed.append(b"".join(map(memo.__getitem__, words.pretokens(value))) if value else b"")
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                ids = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*kept, "token_ids"])

    schema = docs.select(*kept).schema.add("token_ids", ArrayType(IntegerType()))
    return docs.select(*kept).mapInArrow(run, schema)


def decoded_texts(lists: pa.Array, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    """Texts of many id lists at once; null stays null."""
    flat, starts, lengths = tables
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    tokens = np.asarray(pc.fill_null(pc.list_flatten(lists), -1).to_numpy(zero_copy_only=False), dtype=np.int64)
    known = (tokens >= 0) & (tokens < len(lengths))
    if not known.all():
        tokens = np.where(known, tokens, 0)
    width = np.where(known, lengths[tokens], 0)
    raw = flat[ranges(starts[tokens], width)]
    bytes_before = np.append(0, np.cumsum(width, dtype=np.int64))
    offsets = bytes_before[np.append(0, np.cumsum(sizes, dtype=np.int64))]
    mask = pa.py_buffer(np.packbits(np.asarray(lists.is_valid().to_numpy(zero_copy_only=False)), bitorder="little").tobytes())
    texts = pa.Array.from_buffers(pa.large_string(), len(lists), [mask, pa.py_buffer(offsets), pa.py_buffer(raw)])
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # some text is no UTF-8
        whole = raw.tobytes()
        rows = (whole[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist()))
        texts = pa.array(list(rows), pa.large_string())
    return texts.cast(pa.string())


def decode(encoded: DataFrame, vocab: str | None = None, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded`` text; bytes that are no UTF-8 become replacement characters.

    Null ids decode to null; an unknown id adds nothing.
    """
    vocab = vocab or default_vocabulary()
    kept = [c for c in encoded.columns if c != "decoded"]
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = vocabulary(vocab).decode_tables()
        for batch in batches:
            first = 0
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            while first < batch.num_rows:  # rows of so many tokens, or one longer row
                last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + DECODE_TOKENS, side="right"))
                part = batch.slice(first, max(1, last - first))
                yield pa.RecordBatch.from_arrays([*part.columns, decoded_texts(part.column(at), tables)], names=[*kept, "decoded"])
                first += part.num_rows

    schema = encoded.select(*kept).schema.add("decoded", "string")
    return encoded.select(*kept).mapInArrow(run, schema)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs).drop("text"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
