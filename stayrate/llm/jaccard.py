"""Exact Jaccard join of word shingles over a token-group matrix.

Texts become sets of hashed 5-word shingles. Equal sets are one set from here on. A sketch (four
minimum hashes) puts similar sets into the same group. The matrix has a row for each shingle and a
column for each group: a cell is set when some member of the group has the shingle. For a set Q and a
group G the matrix gives |Q ∩ union(G)|, which bounds the overlap of Q with every member of G; only
groups that reach what a similarity of 3/4 needs are opened, and their members are compared exactly.

What keeps this exact and small:

* **Half matrix.** Sets of more than ``WHOLE`` shingles enter with the shingles whose hash is below
  ``LOW`` (3/8 of them); a bound counts all other shingles as shared. Two sets with similarity 3/4
  share a shingle among the quarter of either that comes first in any fixed order, so with shingles
  of frequent passages ordered last and the others by hash, the stored part holds that quarter.
* **Frequent shingles.** A shingle in more than ``FREQUENT`` groups is not expanded; the bound counts
  it as shared. A set whose stored part has too few other shingles to be found without them is
  "covered": covered sets are compared among themselves by their rarest frequent shingles too.
* **Families.** Members are first compared with their group's leader, and leaders with each other.
  So are sets that meet by hash in parties of about ``PARTY``: of those in the same group, and of those
  whose least frequent shingle by some hash is the same. Many near copies of which none is like
  most others become one component by such chance meetings. Afterwards all pairs from different components are opened,
  so thousands of near copies cost thousands of comparisons, not millions. Only components are wanted, so no link between
  components is lost.

* **Sketches.** A pair is looked at by its sets' bit sketches first (half a byte to a byte a shingle): each bit
  that one sketch has and the other lacks is a shingle that is not shared. Only pairs that may still
  reach the similarity after that are compared shingle by shingle.

Comparisons are made on the shingles of whole texts. Equality of shingles is equality of 64-bit hashes. What can
grow with the square of a group's size is the comparison of many *unlike* covered sets that share the
same frequent passages over six sevenths of their text and still differ in the rest.

Null and empty texts, and texts without words, have the empty set and link with nothing. With fewer
than five words the whole sequence is the only shingle. Repeated rows and ties are equal sets; a null
doc_id takes part but is never a component's name unless nothing else is in it. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayrate.llm.blocks import BLOCK_SCHEMA, bucket_count, corpus_bytes, pack, runs, unpack
from stayrate.llm.common import LOWER, NOT_SPACE, Words, components, mix, ranges, segment_min, segment_sums, slices, stored, table

SHINGLE = 5
WHOLE = 400  # sets up to this size are stored whole
PART = 300  # from this size on, bounds use the shingles below LOW only; WHOLE * 3/4
LOW = np.uint64(3 << 61)
FREQUENT = 64
BUCKET_BYTES = 14 << 20
TASK_TOKENS = 1_000_000
SKETCH = 4  # minimum hashes that members of a group share; fewer would group texts by a shared passage
EXPAND = 2_000_000
SKETCH_BITS = 64  # the shortest sketch
PARTY = 16  # sets that meet by chance before all pairs that are left are opened
MEETINGS = 2  # hashes by which covered sets meet
CELL = 1024  # sets on either side whose sketches are held against each other at once

HEAD = np.dtype([("sid", "<i8"), ("gid", "<i8"), ("size", "<u4"), ("n", "<u4")])
BODY = np.dtype([("low", "<u4"), ("high", "u1")])

_STEP = [np.uint64(int(x) | 1) for x in mix(np.arange(SHINGLE, dtype=np.uint64), 31)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin."""
    found = Words(LOWER[data], offsets, NOT_SPACE)
    h, bounds = found.hashes(), found.bounds
    words = np.diff(bounds)
    count = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    values = np.zeros(first[-1], dtype=np.uint64)
    full = np.flatnonzero(words >= SHINGLE)
    if len(full):
        n = len(h) - SHINGLE + 1
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(SHINGLE):
            rolled += h[k : k + n] * _STEP[k]
        values[ranges(first[full], count[full])] = rolled[ranges(bounds[full], count[full])]
    for r in np.flatnonzero((words > 0) & (words < SHINGLE)):
        part = h[bounds[r] : bounds[r + 1]]
        values[first[r]] = (part * np.array(_STEP[: len(part)])).sum(dtype=np.uint64) + np.uint64(len(part))
    values = mix(values, 32)
    for a, b in zip(first[:-1], first[1:]):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][count > 0]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[first]


def describe(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Size, identity, group and number of low shingles of each set."""
    size = np.diff(bounds)
    sid = mix(segment_sums(mix(values, 33), bounds) + size.astype(np.uint64), 34).view(np.int64)
    sketch = np.zeros(len(size), dtype=np.uint64)
    for k in range(SKETCH):
        sketch = mix(sketch + segment_min(mix(values, 40 + k), bounds, 0), 37)
    gid = (sketch >> np.uint64(1)).view(np.int64)
    return size, sid, gid, segment_sums((values < LOW).astype(np.int64), bounds)


def sketches(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A bit set of 4 to 8 bits a shingle for each set; the lowest bits of a hash are its place."""
    size = np.diff(bounds)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(4 * size, SKETCH_BITS))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    held = np.zeros(first[-1], dtype=bool)
    owner = np.repeat(np.arange(len(size)), size)
    held[first[owner] + (values & (bits[owner] - 1).view(np.uint64)).view(np.int64)] = True
    offsets = pa.py_buffer((first // 8).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(size), [None, offsets, pa.py_buffer(np.packbits(held).tobytes())])


def most_shared(x: np.ndarray, y: np.ndarray, n: int, m: int) -> int:
    """An upper bound of what two sets of n and m shingles share, from their sketches."""
    while len(x) != len(y):  # the longer one is folded
        if len(x) > len(y):
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def shingle_info(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, size, sid, gid, low, sketch of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                values, bounds = shingle_sets(data, offsets)
                size, sid, gid, low = describe(values, bounds)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).slice(i, j - i), "size": pa.array(size), "sid": pa.array(sid), "gid": pa.array(gid), "low": pa.array(low), "sketch": sketches(values, bounds)}
                )

    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, "doc_id long, size long, sid long, gid long, low long, sketch binary")


def matrix_blocks(docs: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """Stored shingles of every set, once a task, in blocks by shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        heads: list[np.ndarray] = []
        held = n_heads = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n_heads
            if held:
                token = np.concatenate(tokens)
                body = np.zeros(len(token), BODY)
                body["low"], body["high"] = token & np.uint64(0xFFFFFFFF), token >> np.uint64(32)
                yield pack((token % np.uint64(buckets)).astype(np.int32), body, np.concatenate(owners), np.concatenate(heads))
            tokens.clear(), owners.clear(), heads.clear()
            held = n_heads = 0

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                values, bounds = shingle_sets(data, offsets)
                size, sid, gid, _ = describe(values, bounds)
                fresh = np.zeros(len(size), dtype=bool)
                for k, s in enumerate(sid.tolist()):
                    if size[k] and s not in seen:
                        seen.add(s)
                        fresh[k] = True
                owner = np.repeat(np.arange(len(size)), size)
                low = values < LOW
                use = fresh[owner] & (low | (size[owner] <= WHOLE))
                token = (values[use] & np.uint64((1 << 39) - 1)) | (low[use].astype(np.uint64) << np.uint64(39))
                head = np.zeros(len(size), HEAD)
                head["sid"], head["gid"], head["size"] = sid, gid, size
                tokens.append(token), owners.append(owner[use] + n_heads), heads.append(head)
                held += len(token)
                n_heads += len(size)
                if held > TASK_TOKENS:
                    yield from flush()
        yield from flush()

    return docs.select(text).mapInArrow(run, BLOCK_SCHEMA)


OVERLAP, COVER, STAR, POST = 0, 1, 2, 3
MATCH_SCHEMA = "kind int, a long, b long, n long"


def _rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"kind": pa.array(np.full(len(a), kind, np.int32)), "a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


def _summed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = runs(a, b)
    return a[new], b[new], np.add.reduceat(n, new) if len(new) else n


_MEMBER = np.uint64(24)  # beside the 40 bits of a stored shingle


def _sorted_entries(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct sets of a bucket by group, and its entries by shingle, group and set, each once.

    An entry is sorted as one number, so that a bucket needs little more than its own size.
    """
    heads, body, owner = unpack(rows.column("head"), rows.column("body"), HEAD, BODY)
    order = np.lexsort((heads["sid"], heads["gid"]))
    heads = heads[order]
    kept = runs(heads["gid"], heads["sid"])
    rank = np.zeros(len(heads), dtype=np.int64)
    rank[order] = np.searchsorted(kept, np.arange(len(heads)), side="right") - 1
    member = rank[owner]
    del owner
    token = body["low"].astype(np.uint64) | (body["high"].astype(np.uint64) << np.uint64(32))
    del body
    if len(kept) < 1 << int(_MEMBER):
        token <<= _MEMBER
        token |= member.view(np.uint64)
        del member
        token.sort()
        token = token[runs(token)]
        return heads[kept], token >> _MEMBER, (token & np.uint64((1 << int(_MEMBER)) - 1)).astype(np.int32)
    order = np.lexsort((member, token))
    token, member = token[order], member[order]
    once = runs(token, member)
    return heads[kept], token[once], member[once]


def _match(rows: pa.Table, frequent: int) -> pa.Table:
    """One bucket of the matrix: how much of each set every other group's union holds."""
    heads, token, member = _sorted_entries(rows)
    # A shingle of one group says nothing about others, and most are: what follows holds the rest only.
    group = np.cumsum(np.append(0, heads["gid"][1:] != heads["gid"][:-1])).astype(np.int32)[member] if len(heads) else member
    new = runs(token)
    entries = np.diff(np.append(new, len(token)))
    columns = np.diff(np.append(np.searchsorted(runs(token, group), new), len(runs(token, group))))  # groups that have the shingle
    shared = columns > 1
    use = ranges(new[shared], entries[shared])
    token, member, entries, columns = token[use], member[use], entries[shared], columns[shared]
    new = np.cumsum(entries) - entries
    sid, gid, size = heads["sid"][member], heads["gid"][member], heads["size"][member].astype(np.int64)
    del group, use, member
    counted = ((size < PART) | (token >= np.uint64(1 << 39))).astype(np.int64)
    cells = runs(token, gid)  # one for each set cell of the matrix
    out = []

    hot = columns > frequent
    at = ranges(new[hot], entries[hot])
    if len(at):
        a, _, n = _summed(sid[at], sid[at], counted[at])
        out.append(_rows(COVER, a, a, n))
        center = np.repeat(gid[new[hot]], entries[hot])
        first = np.zeros(len(token), dtype=bool)
        first[cells] = True
        far = first[at] & (gid[at] != center)
        out.append(_rows(STAR, *_summed(gid[at][far], center[far], np.ones(int(far.sum()), np.int64))))
        cell = first[at]
        out.append(_rows(POST, gid[at][cell], token[at][cell].view(np.int64), np.repeat(columns[hot], entries[hot])[cell]))

    least, most = (f.reduceat(size, cells) if len(cells) else size for f in (np.minimum, np.maximum))
    cell_start = np.searchsorted(cells, new)
    usual = np.flatnonzero((columns > 1) & ~hot)
    work = np.cumsum(entries[usual] * columns[usual])
    done, parts = 0, []
    while done < len(usual):
        stop = max(done + 1, int(np.searchsorted(work, (work[done - 1] if done else 0) + EXPAND, side="right")))
        t = usual[done:stop]
        done = stop
        q = ranges(new[t], entries[t])
        each = np.repeat(columns[t], entries[t])
        c = ranges(np.repeat(cell_start[t], entries[t]), each)
        q = np.repeat(q, each)
        ok = (gid[cells[c]] != gid[q]) & (4 * size[q] >= 3 * least[c]) & (4 * most[c] >= 3 * size[q])
        parts.append(_summed(sid[q[ok]], gid[cells[c[ok]]], counted[q[ok]]))
    if parts:
        out.append(_rows(OVERLAP, *_summed(*(np.concatenate(x) for x in zip(*parts)))))
    return pa.concat_tables(out) if out else _rows(0, *(np.zeros(0, np.int64),) * 3)


def _similar(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= 75 * (n + m - shared)


def _sides(pairs: DataFrame) -> DataFrame:
    """The sets that ``pairs`` ask for. Written, so the planner knows the size and moves what is joined only where it must."""
    return stored(pairs.selectExpr("explode(array(a, b)) as sid").distinct(), "asked")


def _beside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the columns of ``sets`` (sid, ...) for either side, in order."""
    rest = [c for c in sets.columns if c != "sid"]
    once = sets.dropDuplicates(["sid"])
    sides = [once.select(F.col("sid").alias(side), *(F.col(c).alias(c + "_" + side) for c in rest)) for side in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", *(c + "_" + side for side in "ab" for c in rest))


def promising(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches do not rule the similarity out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, m, y = (batch.column(k) for k in range(2, 6))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, (i, j) in enumerate(zip(n.to_pylist(), m.to_pylist())):
                one, two = (np.frombuffer(c[k].as_buffer(), dtype=np.uint8) for c in (x, y))
                keep[k] = _similar(most_shared(one, two, i, j), i, j)
            yield batch.select([0, 1]).filter(pa.array(keep))

    asked = info.where("size > 0").select("sid", "size", "sketch").join(_sides(pairs), "sid", "left_semi")
    return _beside(pairs, asked).mapInArrow(run, "a long, b long")


def shingles_of(docs: DataFrame, reps: DataFrame, text: str = "text") -> DataFrame:
    """sid and its shingles, sorted, for each set of ``reps`` (sid, rep: a document that has it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                values, bounds = shingle_sets(data, offsets)
                sid = describe(values, bounds)[1]
                # texts that share a doc_id with the one asked for are told apart by their sets
                right = np.flatnonzero(sid == batch.column(0).slice(i, j - i).to_numpy())
                parts = [values[bounds[r] : bounds[r + 1]].tobytes() for r in right]
                yield pa.RecordBatch.from_pydict({"sid": pa.array(sid[right]), "shingles": pa.array(parts, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).where("text is not null")
    return rows.join(reps, F.col("doc_id").eqNullSafe(F.col("rep"))).select("sid", "text").mapInArrow(run, "sid long, shingles binary")


def compare(likely: DataFrame, reps: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The pairs (a, b) of the written table ``likely`` that reach the similarity. reps: sid, rep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=np.uint64) for c in (2, 3))
                keep[k] = _similar(len(np.intersect1d(one, two, assume_unique=True)), len(one), len(two))
            yield batch.select([0, 1]).filter(pa.array(keep))

    asked = stored(reps.select("sid", "rep").join(_sides(likely), "sid", "left_semi"), "asked")
    return _beside(likely, shingles_of(docs, asked, text)).mapInArrow(run, "a long, b long")


_ALIKE = "4 * {0} >= 3 * {1} and 4 * {1} >= 3 * {0}"  # sizes that allow the similarity


def _pairs(edges: DataFrame) -> DataFrame:
    """Each unordered pair once, if its sizes allow the similarity; edges: a, x, b, y, with x and y the sizes."""
    return edges.where("a <> b and " + _ALIKE.format("x", "y")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _parties(members: DataFrame) -> DataFrame:
    """Edges (a, x, b, y) of sets that share ``key`` and fall into the same party of about ``PARTY``; members: key, sid, size.

    The pairs grow with the number of members, not with its square, and are a start only: what they leave in different
    components is opened in full later.
    """
    counts = members.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = members.join(counts, "key").selectExpr("key", f"pmod(xxhash64(sid, key), ceil(_n / {PARTY})) as _party", "sid", "size")
    one, two = (dealt.withColumnsRenamed({"sid": side, "size": size}) for side, size in ("ax", "by"))
    return one.join(two, ["key", "_party"]).where("a > b and " + _ALIKE.format("x", "y")).select("a", "x", "b", "y")


def _possible(few: pa.Table, many: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``few`` and one of ``many`` that sizes and sketches allow; columns sid, component, size, small, top, sketch.

    One row of ``few`` is held against all of ``many`` with sketches of one length at a time.
    """
    sid, component, size, small, top = (many.column(c).to_numpy() for c in ("sid", "component", "size", "small", "top"))
    length = np.array([len(v.as_buffer()) for v in many.column("sketch")], dtype=np.int64)
    held = []
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        held.append((int(n), at, np.frombuffer(b"".join(many.column("sketch").take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -1)))
    for row in few.select(["sid", "component", "size", "small", "sketch"]).to_pylist():
        for n, at, bits in held:
            fits = (4 * size[at] >= 3 * row["size"]) & (4 * row["size"] >= 3 * size[at]) & (component[at] != row["component"]) & (small[at] | row["small"])
            fits &= top[at] | (sid[at] < row["sid"])  # two of the few meet twice
            at, bits = at[fits], bits[fits]
            one = np.frombuffer(row["sketch"], np.uint64)
            if len(at) == 0:
                continue
            while len(one) * 8 != n:  # the longer one is folded
                if len(one) * 8 > n:
                    one = one[: len(one) // 2] | one[len(one) // 2 :]
                else:
                    half = bits.shape[1] // 2
                    bits, n = bits[:, :half] | bits[:, half:], n // 2
            both = np.bitwise_count(bits & one).sum(1, dtype=np.int64)
            shared = np.minimum(row["size"] - int(np.bitwise_count(one).sum()), size[at] - np.bitwise_count(bits).sum(1, dtype=np.int64)) + both
            at = at[100 * shared >= 75 * (row["size"] + size[at] - shared)]
            yield np.full(len(at), row["sid"]), sid[at]


def _likely(members: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs (a, b) that share ``key``, lie in different components and are not ruled out by sizes and sketches.

    members: key, sid, component, size, small; of a pair one must be ``small``. Sets meet in cells of ``CELL`` by ``CELL``, and
    only pairs that pass leave a cell: neither rows nor memory grow with the number of pairs that are looked at. One side
    leaves out each key's largest component, so a large component costs its size and nothing for itself.
    """
    counts = members.groupBy("key", "component").agg(F.count("*").alias("_n"))
    largest = counts.groupBy("key").agg(F.max(F.struct("_n", "component")).alias("_top"), F.sum("_n").alias("_all"), F.count("*").alias("_several")).where("_several > 1")
    mixed = stored(
        members.join(largest, "key").selectExpr(
            "key", "sid", "component", "size", "small", "component = _top.component as top", f"ceil((_all - _top._n) / {CELL}) as rows", f"ceil(_all / {CELL}) as columns"
        ),
        "meeting",
    )
    asked = stored(mixed.select("sid").distinct(), "asked")
    sketch = info.where("size > 0").select("sid", "sketch").join(asked, "sid", "left_semi").dropDuplicates(["sid"])
    cells = mixed.agg(F.sum(F.expr("rows + if(top, 0, columns)"))).first()[0] or 0
    place = "key", "pmod(xxhash64(sid), {0}) as _{0}", "explode(sequence(0, {1} - 1)) as _{1}", "sid", "component", "size", "small", "top", "sketch"
    met = mixed.join(sketch, "sid")
    few = met.where("not top").selectExpr(*(c.format("rows", "columns") for c in place), "true as few")
    many = met.selectExpr(*(c.format("columns", "rows") for c in place), "false as few")
    dealt = few.unionByName(many).withColumn("_cell", F.xxhash64("key", "_rows", "_columns")).withColumn("_bucket", F.expr(f"pmod(_cell, {1 + cells // (4 * CELL)})"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_cell")
        starts = runs(rows.column("_cell").to_numpy())
        found = [(np.zeros(0, np.int64),) * 2]
        for i, j in zip(starts, np.append(starts[1:], rows.num_rows)):
            cell = rows.slice(i, j - i)
            side = cell.column("few").combine_chunks()
            found += _possible(cell.filter(side), cell.filter(pc.invert(side)))
        a, b = (np.concatenate(x) for x in zip(*found))
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    dealt = dealt.select("_bucket", "_cell", "few", "sid", "component", "size", "small", "top", "sketch")
    return dealt.groupBy("_bucket").applyInArrow(run, "a long, b long").distinct()


def _by_frequent(matches: DataFrame, members: DataFrame) -> DataFrame:
    """Covered sets by the keys under which frequent shingles alone may link them: key, sid, component, size, small.

    members: sid, gid, component, size, part of the covered sets. A pair that shares some other stored
    shingle is opened by its overlap already, so here all shingles of a set that are not frequent count
    as unshared. Two sets of sizes s <= l are similar when they share 3/7 of s + l, so s has at most s/7
    unshared shingles and l at most l/4. In one order of the frequent shingles, rarest first, the pair
    meets in what remains of these numbers on either side, plus one. Sets up to ``WHOLE`` are ordered with
    all of their shingles, pairs with a larger set by the low ones. Lists are made for each family, the
    members of a group that lie in one component. ``small`` marks a set that is listed as the smaller of a pair too.
    """
    kinds = members.selectExpr("*", f"explode(filter(array(if(size <= {WHOLE}, false, null), if(size >= {PART}, true, null)), x -> x is not null)) as low")
    kinds = kinds.withColumn("part", F.expr("if(low, part, size)"))
    family = ["gid", "component", "low"]
    families = kinds.groupBy(*family).agg(
        F.min(F.expr("part - size div 7")).alias("_as_small"),
        F.min(F.expr("part - size div 4")).alias("_as_large"),
    )
    cells = matches.where(f"kind = {POST}").selectExpr("a as gid", "b as token")
    placed = cells.join(families.select(*family), "gid").where(f"not low or token >= {1 << 39}")
    # shingles of one passage stand in the same families: they are one class, with their number as weight
    lists = placed.groupBy("token", "low").agg(F.count("*").alias("width"), F.bit_xor(F.xxhash64("gid", "component")).alias("_x"), F.bit_xor(F.xxhash64("component", F.lit(1), "gid")).alias("_y"))
    lists = lists.select("token", "low", "width", F.xxhash64("low", "width", "_x", "_y").alias("class"))
    weighed = placed.join(lists, ["token", "low"]).groupBy(*family, "class", "width").agg(F.count("*").alias("weight"))
    counts = weighed.groupBy("class", "component").agg(F.count("*").alias("_n"))
    largest = counts.groupBy("class").agg(F.max(F.struct("_n", "component"))["component"].alias("_largest"), F.count("*").alias("_several"))
    mixed = weighed.join(largest.where("_several > 1").drop("_several"), "class")
    inside = Window.partitionBy(*family)
    ranked = mixed.withColumn("place", F.sum("weight").over(inside.orderBy("width", "class"))).withColumn("all", F.sum("weight").over(inside)).join(families, family)
    ranked = ranked.withColumn("_from", F.expr("place - weight"))  # a class is listed if any shingle of it is
    posts = ranked.where("_from < all + 1 - _as_large").selectExpr(*family, "class", "_from < all + 1 - _as_small as small")
    return posts.join(kinds, family).select(F.xxhash64("class", "low").alias("key"), "sid", "component", "size", "small")


def similar_components(docs: DataFrame, text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    buckets = bucket_count(corpus_bytes(docs, text), BUCKET_BYTES)
    info = stored(shingle_info(docs, text), "sets")
    reps = stored(
        info.where("size > 0").groupBy("sid", "gid", "size", "low").agg(F.min("doc_id").alias("rep")).withColumn("part", F.when(F.col("size") < PART, F.col("size")).otherwise(F.col("low"))),
        "distinct-sets",
    )
    matches = stored(matrix_blocks(docs, buckets, text).groupBy("bucket").applyInArrow(lambda rows: _match(rows, frequent), MATCH_SCHEMA), "matrix")

    cover = matches.where(f"kind = {COVER}").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("cover"))
    measured = stored(reps.join(cover, "sid", "left").withColumn("cover", F.coalesce("cover", F.lit(0))), "measured")
    overlap = matches.where(f"kind = {OVERLAP}").groupBy(F.col("a").alias("sid"), F.col("b").alias("other")).agg(F.sum("n").alias("shared"))
    limits = measured.groupBy(F.col("gid").alias("other")).agg(F.min("size").alias("_least"), F.max("cover").alias("_cover"))
    # similar sets share 3/7 of their sizes' sum; shared frequent shingles are at most what either side has
    open_ = stored(
        overlap.join(measured.select("sid", "gid", "size", "part", "cover"), "sid")
        .join(limits, "other")
        .where("28 * (shared + least(cover, _cover) + size - part) >= 12 * size + 3 * greatest(3 * size, 4 * _least)")
        .selectExpr("sid", "gid", "other", "size", "cover", "shared + size - part as rest"),
        "qualifying",
    )
    covered = measured.where("part - cover < floor(size / 4) + 1").select("sid")

    leaders = reps.groupBy("gid").agg(F.min(F.struct("sid", "size", "part")).alias("_l")).selectExpr("gid", "_l.sid as leader", "_l.size as x", "_l.part as part")
    other = leaders.selectExpr("gid as other", "leader as b", "x as y")
    to_leader = reps.select("gid", "sid", "size").join(leaders, "gid").selectExpr("sid as a", "size as x", "leader as b", "x as y")
    between = open_.select("gid", "other").distinct().join(leaders, "gid").join(other, "other").selectExpr("leader as a", "x", "b", "y")
    stars = matches.where(f"kind = {STAR}").groupBy(F.col("a").alias("gid"), F.col("b").alias("other")).agg(F.sum("n").alias("n"))
    between_hot = stars.join(leaders, "gid").where("4 * n >= part").join(other, "other").selectExpr("leader as a", "x", "b", "y")
    in_group = reps.selectExpr("gid as key", "sid", "size")
    hashes = matches.where(f"kind = {POST}").groupBy(F.col("a").alias("gid")).agg(F.array(*(F.min(F.xxhash64("b", F.lit(k))) for k in range(MEETINGS))).alias("keys"))
    meeting = reps.join(covered, "sid", "left_semi").join(hashes, "gid").selectExpr("explode(keys) as key", "sid", "size")
    by_chance = _parties(in_group.union(meeting))
    asked_first = stored(_pairs(to_leader.union(between).union(between_hot).union(by_chance)), "pairs")
    first = stored(compare(stored(promising(asked_first, info), "likely"), reps, docs, text), "links")
    named = reps.join(components(first).withColumnRenamed("id", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    named = stored(named.select("sid", "gid", "component", "size"), "families")

    # what is left: pairs from different components
    opened_pairs = (
        open_.join(named.selectExpr("sid", "component as _ca"), "sid")
        .join(named.join(measured.selectExpr("sid", "cover as _cover"), "sid").selectExpr("gid as other", "sid as b", "component as _cb", "size as _size", "_cover"), "other")
        .where("_ca <> _cb and 7 * (rest + least(cover, _cover)) >= 3 * (size + _size)")
        .selectExpr("sid as a", "size as x", "b", "_size as y")
    )
    opened = stored(_pairs(opened_pairs).join(asked_first, ["a", "b"], "left_anti"), "pairs")
    by_frequent = _by_frequent(matches, named.join(measured.join(covered, "sid", "left_semi").select("sid", "part"), "sid"))
    members = named.selectExpr("gid as key", "sid", "component", "size", "true as small").union(by_frequent)
    likely = promising(opened, info).union(_likely(members, info)).distinct().join(asked_first, ["a", "b"], "left_anti")
    second = stored(compare(stored(likely, "likely"), reps, docs, text), "links")

    linked = components(first.union(second)).withColumnRenamed("id", "sid")
    placed = reps.select("sid", "rep").join(linked, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_sets = placed.join(least, "component").select("sid", "component_id")
    return (
        info.withColumn("_set", F.when(F.col("size") > 0, F.col("sid")))
        .join(named_sets.withColumnRenamed("sid", "_set"), "_set", "left")
        .select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))
