import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm import multiindex as M

SCHEMA = "vec_id long, label int, embedding array<float>, extra string"


def brute_force(rows, threshold=M.THRESHOLD):
    ok = []
    for i, label, v, _ in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.asarray(v, np.float32).astype(float) if good else None)
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is None or y is None or rows[a][1] != rows[b][1] or len(x) != len(y):
                continue
            if np.array_equal(x, y) or x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                n[a] += 1
                n[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        least[root(k)] = min(r[0], least.get(root(k), r[0]))
    return {r[0]: (n[k], least[root(k)], least[root(k)] == r[0]) for k, r in enumerate(rows)}


def found(spark, rows):
    from stayrate.llm.common import ship_package

    ship_package(spark)
    out = M.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}


def planted(draw, count, dimension=64):
    rows, rng = [], np.random.default_rng(draw.randint(0, 99))
    for _ in range(count):
        base = rng.normal(size=dimension)
        for _ in range(draw.choice((1, 1, 3, 6))):
            v = base + rng.normal(size=dimension) * draw.choice((0, 0.05, 0.12, 0.2))
            rows.append((len(rows), draw.randint(0, 1), [float(x) for x in v.astype(np.float32)], "x"))
    return rows


def test_recall_and_no_false_link(spark):
    rows = planted(random.Random(2), 250)
    got, true = found(spark, rows), brute_force(rows)
    links, known = sum(v[0] for v in got.values()), sum(v[0] for v in true.values())
    assert all(got[i][0] <= true[i][0] for i in true)
    assert links >= 0.9 * known > 0


def test_many_copies_and_a_dense_cell(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    rows = [(k, 1, [float(x) for x in base.astype(np.float32)], "x") for k in range(300)]
    for k in range(300, 1600):
        v = base + rng.normal(size=64) * 0.02
        rows.append((k, 1, [float(x) for x in v.astype(np.float32)], "x"))
    got = found(spark, rows)
    assert all(v[1] == 0 for v in got.values())
    assert sum(v[0] for v in got.values()) >= 0.99 * 1600 * 1599


def test_odd_rows(spark):
    one = [1.0, 0.5] * 4
    rows = [
        (1, None, one, "a"), (2, 1, None, "a"), (3, 1, [], "a"), (4, 1, [0.0] * 8, "a"), (5, 1, [None, 1.0], "a"), (6, 1, [float("nan")] * 8, "a"),
        (7, 1, [float("inf")] * 8, "a"), (8, 1, one, "a"), (9, 1, one, "b"), (10, 2, one, "a"), (11, 1, [2 * x for x in one], "a"), (12, 1, one[:4], "a"), (13, 1, [1.0], "a"),
    ]
    assert found(spark, rows) == brute_force(rows)
    assert M.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random((5, 12)), rng.random((5, 9))
    i, j = M.multi_sequence(a, b, 20)
    for r in range(5):
        every = np.sort((a[r][:, None] + b[r][None]).ravel())
        assert np.allclose(a[r][i[r]] + b[r][j[r]], every[:20])


def test_query_recall_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.label, r.embedding, "") for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in M.op8_embedding_near_dedup(spark, sf_dir).withColumn("x", F.lit(1)).collect()}
    true = brute_force(rows)
    assert set(got) == set(true) and sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in true.values())


@pytest.mark.parametrize("codewords", [354, 1024])
def test_recall_of_large_codebooks_on_rows_outside_the_sample(codewords):
    rng = np.random.default_rng(6)
    turn = rng.normal(size=(64, 64))
    index = M.MultiIndex(rng.normal(size=(M.SAMPLE + 2048, 64)) @ turn, codewords, M.THRESHOLD, M.TARGET_RECALL)
    one = rng.normal(size=(3000, 64)) @ turn
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    away = rng.normal(size=one.shape)
    away -= (away * one).sum(1, keepdims=True) * one
    two = M.THRESHOLD * one + np.sqrt(1 - M.THRESHOLD**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    there = (index.visit(one, index.visits) == index.cells(two)[:, None]).any(1)
    back = (index.visit(two, index.visits) == index.cells(one)[:, None]).any(1)
    assert (there | back).mean() >= M.TARGET_RECALL
    assert there.mean() >= M.TARGET_RECALL - 0.01
