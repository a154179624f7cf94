"""Embedding near-duplicates with an inverted multi-index.

Unit vectors are cut in halves, each half has its own codebook, and a pair of codewords is a cell of
the product grid. Every vector lies in one cell. A vector visits cells in the order of the multi-sequence
traversal (smallest sum of its distances to the two codewords first) and is compared, by exact cosine
in double precision, with the vectors of its label in them. How many cells are visited follows
from the target recall: neighbours at exactly the threshold are drawn around sample vectors that the
codebooks were not fitted on, and the visit count is the rank that holds the wanted share of their cells,
however high it is.

Codebooks are fitted on ``SAMPLE`` distinct vectors and the visit count on ``KEPT_OUT`` others (documented
bounds; of a smaller table a quarter is kept out); every vector is indexed and every vector searches. Equal vectors of a label are one class with a weight. The two
sides of a cell are dealt into tiles of at most about ``TILE`` rows, so a cell that holds a third of
all vectors is many tasks. A tile gives link counts and a spanning forest, never all pairs.

Vectors that are null, empty, all zero, or hold a null or non-finite component, and rows with a null
label, link with nothing; vectors of different length link with nothing. Repeated rows are copies and
count as links of each other. Cosine of exactly the threshold links. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.common import components, stored, table

THRESHOLD = 0.98
TARGET_RECALL = 0.98
SAMPLE = 8192
KEPT_OUT = 2048
PER_CELL = 16  # vectors of a cell that the codebooks aim at
MOST_CODEWORDS = 1024
LEAST_VISITS = 4
TILE = 1024

_CELL = "label int, length int, cell long, role int, cid long, weight long, own long, probes binary, vector binary"


def _halves(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (unit.shape[1] + 1) // 2
    return unit[:, :middle], unit[:, middle:]


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ book.T + (book**2).sum(1)[None], 0)


def fit_codebook(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Codewords of one half: k-means from evenly spread starting rows."""
    if len(points) == 0:
        return np.zeros((1, points.shape[1]))
    book = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(points, book).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(book))
        book[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return book


def multi_sequence(first: np.ndarray, second: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each row in order of first[i] + second[j], the nearest ``visits``.

    With both distance lists sorted, a cell of ranks (i, j) comes after the (i+1)(j+1)-1 cells of
    smaller ranks, so only cells with (i+1)(j+1) <= visits can be among the first ``visits``.
    """
    a, b = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
    ranks = [(i, j) for i in range(min(first.shape[1], visits)) for j in range(min(second.shape[1], visits // (i + 1)))]
    i, j = np.array(ranks).T
    sums = np.take_along_axis(first, a, 1)[:, i] + np.take_along_axis(second, b, 1)[:, j]
    order = np.argsort(sums, axis=1, kind="stable")[:, :visits]
    return np.take_along_axis(a, i[order], 1), np.take_along_axis(b, j[order], 1)


class MultiIndex:
    """Two codebooks and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, codewords: int, threshold: float, target: float):
        self.dimension = sample.shape[1]
        unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
        kept_out = min(KEPT_OUT, len(unit) // 4)
        self.books = tuple(fit_codebook(h, codewords) for h in _halves(unit[kept_out:]))
        self.visits = self._calibrate(unit[:kept_out], threshold, target)

    def _calibrate(self, some: np.ndarray, threshold: float, target: float) -> int:
        """The rank that holds the cells of the wanted share of neighbours; all cells if there is no row to tell."""
        cells = len(self.books[0]) * len(self.books[1])
        if len(some) == 0:
            return cells
        rng = np.random.default_rng(17)
        noise = rng.normal(size=some.shape)
        noise -= (noise * some).sum(1, keepdims=True) * some
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
        near = threshold * some + np.sqrt(1 - threshold**2) * noise
        first, second = self._halves_distances(some)
        i, j = np.divmod(self.cells(near), len(self.books[1]))
        rows = np.arange(len(some))
        reach = (first[rows, i] + second[rows, j]) * (1 + 1e-9)
        second.sort(axis=1)
        rank = np.array([np.searchsorted(second[r], reach[r] - first[r], side="right").sum() for r in rows])
        return int(min(cells, max(LEAST_VISITS, np.quantile(rank, target, method="higher"))))

    def _halves_distances(self, unit: np.ndarray) -> list[np.ndarray]:
        return [_distances(h, b) for h, b in zip(_halves(unit), self.books)]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        one, two = (d.argmin(1) for d in self._halves_distances(unit))
        return one * len(self.books[1]) + two

    def visit(self, unit: np.ndarray, visits: int) -> np.ndarray:
        one, two = multi_sequence(*self._halves_distances(unit), visits)
        return one * len(self.books[1]) + two


def _matrix(vectors: list, dimension: int) -> np.ndarray:
    out = np.zeros((len(vectors), dimension))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _usable(embedding: str, label: str):
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _tile(threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        role = rows.column("role").to_numpy()
        cid, weight, own = (rows.column(c).to_numpy() for c in ("cid", "weight", "own"))
        here = rows.column("cell")[0].as_py()
        stack = lambda at: np.stack([np.frombuffer(rows.column("vector")[int(i)].as_buffer(), dtype=np.float32) for i in at]).astype(np.float64)
        index, probe = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        out: tuple[list, list, list] = ([], [], [])
        if len(index) and len(probe):
            x = stack(index)
            visited = [frozenset(np.frombuffer(rows.column("probes")[int(i)].as_buffer(), dtype=np.int64).tolist()) for i in index]
            norm = np.sqrt((x * x).sum(1))
            total = {}
            parent = {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for start in range(0, len(probe), 256):
                part = probe[start : start + 256]
                q = stack(part)
                close = (q @ x.T) / (np.sqrt((q * q).sum(1))[:, None] * norm[None]) >= threshold
                for r, c in zip(*np.nonzero(close)):
                    a, b = part[r], index[c]
                    # a pair that both sides find counts once, where the larger id is indexed
                    if cid[a] == cid[b] or (cid[a] > cid[b] and (own[a] == here or int(own[a]) in visited[c])):
                        continue
                    i, j = int(cid[a]), int(cid[b])
                    total[i] = total.get(i, 0) + int(weight[b])
                    total[j] = total.get(j, 0) + int(weight[a])
                    if root(i) != root(j):
                        parent[max(root(i), root(j))] = min(root(i), root(j))
                        out[0].append(i), out[1].append(j), out[2].append(0)
            for c, n in total.items():
                out[0].append(c), out[1].append(c), out[2].append(n)
        return pa.Table.from_arrays([pa.array(o, pa.int64()) for o in out], schema=schema)

    return run


def build_index(classes: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> MultiIndex:
    """Fit on the classes with the smallest hash; the codebooks grow with the table."""
    n, longest = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE + KEPT_OUT).select("embedding").toArrow().column("embedding").to_pylist()
    codewords = int(min(MOST_CODEWORDS, max(4, np.ceil(np.sqrt((n or 0) / PER_CELL)))))
    return MultiIndex(_matrix(sample, longest or 2), codewords, threshold, target)


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, label, embedding)."""
    rows = vectors.select("vec_id", "label", "embedding").withColumn("_ok", _usable("embedding", "label"))
    rows = rows.withColumn("cid", F.when(F.col("_ok"), F.xxhash64("label", "embedding")))
    classes = stored(
        rows.where("_ok").groupBy("label", "embedding", "cid").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors"
    )
    index = build_index(classes, threshold, target)
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            step = max(1, min(1000, 1_000_000 // held.visits))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                raw = part.column(1).to_pylist()
                plain = _matrix(raw, held.dimension)
                unit = plain / np.linalg.norm(plain, axis=1, keepdims=True)
                own, visited = held.cells(unit), held.visit(unit, held.visits)
                probes = [np.union1d(v, [o]).astype(np.int64) for v, o in zip(visited, own)]
                blobs = [np.asarray(v, dtype=np.float32).tobytes() for v in raw]
                at = np.concatenate([np.arange(len(raw)), np.repeat(np.arange(len(raw)), [len(p) for p in probes])])
                role = np.concatenate([np.zeros(len(raw), np.int32), np.ones(len(at) - len(raw), np.int32)])
                cell = np.concatenate([own, *probes])
                take = lambda c: part.column(c).take(pa.array(at))
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": take(0), "length": pa.array(np.array([len(v) for v in raw], np.int32)[at]), "cell": pa.array(cell.astype(np.int64)),
                        "role": pa.array(role), "cid": take(2), "weight": take(3), "own": pa.array(own[at].astype(np.int64)),
                        "probes": pa.array([probes[i].tobytes() if r == 0 else b"" for i, r in zip(at, role)], pa.binary()),
                        "vector": pa.array([blobs[i] for i in at], pa.binary()),
                    }
                )

    where = ["label", "length", "cell"]
    placed = classes.select(F.col("label").cast("int"), "embedding", "cid", "weight").mapInArrow(place, _CELL)
    sizes = placed.groupBy(*where).agg(
        F.ceil(F.count_if(F.col("role") == 0) / TILE).cast("int").alias("_is"), F.ceil(F.count_if(F.col("role") == 1) / TILE).cast("int").alias("_ps")
    )
    dealt = placed.join(sizes.where("_is > 0 and _ps > 0"), where)
    spread = F.sequence(F.lit(0), F.when(F.col("role") == 0, F.col("_ps")).otherwise(F.col("_is")) - 1)
    mine = F.pmod(F.xxhash64("cid"), F.when(F.col("role") == 0, F.col("_is")).otherwise(F.col("_ps")))
    tiles = dealt.select(*placed.columns, mine.alias("_mine"), F.explode(spread).alias("_other")).selectExpr(
        *placed.columns, "if(role = 0, _mine, _other) as it", "if(role = 0, _other, _mine) as pt"
    )
    found = stored(tiles.groupBy(*where, "it", "pt").applyInArrow(_tile(threshold), "a long, b long, n long"), "vector-links")

    counts = found.where("a = b").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("far"))
    named = components(found.where("a <> b").select("a", "b")).withColumnRenamed("id", "cid")
    joined = classes.select("cid", "rep", "weight").join(counts, "cid", "left").join(named, "cid", "left")
    joined = joined.withColumn("component", F.coalesce("component", "cid"))
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = joined.join(least, "component").select(
        "cid", (F.col("weight") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "cid").join(by_class, "cid", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
