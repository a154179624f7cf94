import math

import numpy as np
import pytest

from stayrate.llm import whitening
from stayrate.llm.common import ship_package

SCHEMA = "vec_id long, embedding array<float>, label int"


def _matrix(kind, d, draw):
    q = np.linalg.qr(draw.standard_normal((d, d)))[0]
    values = {
        "spread": draw.random(d) + 0.1,
        "steep": 10.0 ** -np.arange(d),
        "twins": np.repeat(draw.random(d), 2)[:d] + 0.5,
        "equal": np.ones(d),
        "close": 1 + np.arange(d) * 1e-9,
        "low rank": np.where(np.arange(d) < d // 2, 1.0 + np.arange(d), 0),
    }[kind]
    return (q * values) @ q.T * 1e5


@pytest.mark.parametrize("kind", ["spread", "steep", "twins", "equal", "close", "low rank"])
@pytest.mark.parametrize("d", [1, 2, 9, 64])
def test_pairs_against_a_full_solver(kind, d):
    v = _matrix(kind, d, np.random.default_rng(d))
    v = (v + v.T) / 2
    full = np.linalg.eigvalsh(v)[::-1]
    values, vectors = whitening.leading_pairs(v, 8)
    floor = d * 2.0**-52 * np.trace(v)
    assert min(8, int((full > 4 * floor).sum())) <= len(values) <= min(8, d)
    assert np.allclose(values, full[: len(values)], rtol=0, atol=1e-12 * np.trace(v))
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.linalg.norm(v @ vectors.T - vectors.T * values) <= 1e-12 * np.trace(v) * len(values)


def test_counts_against_a_full_solver():
    draw = np.random.default_rng(3)
    for d in (1, 2, 3, 17, 40):
        for _ in range(20):
            a = draw.standard_normal((d, d))
            a = (a + a.T) * (draw.random((d, d)) < 0.7 if d > 3 else 1)
            a = np.tril(a) + np.tril(a, -1).T
            for shift in (0.0, 0.3, -1.0):
                assert whitening.count_above(a, shift) == int((np.linalg.eigvalsh(a) > shift + 1e-12).sum())


def _usable(rows):
    kept = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    sizes = [len(r[1]) for r in kept]
    d = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    return [r for r in kept if len(r[1]) == d]


def _check(rows, got, k=8, tolerance=1e-9):
    """``got`` against exact sums and numpy's own solver."""
    kept = _usable(rows)
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in r[1]] for r in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    m = np.array(x, dtype=float) - np.array(sums) / n
    v = m.T @ m / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = min(k, int((values > 1e-9 * max(np.trace(v), 1e-300)).sum()))
    assert len(got) == n * found
    by = {}
    for g in got:
        by.setdefault(g.vec_id, []).append(g)
    ids = [r[0] for r in kept]
    for i, row in enumerate(x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        for g in by.get(ids[i], []):
            assert g.n == n and int(g.deviation_exact) in {sum((n * c - s) ** 2 for c, s in zip(x[j], sums)) for j in range(n) if ids[j] == ids[i]}
            if ids.count(ids[i]) == 1:
                assert g.deviation == (deviation if deviation < 2**63 else None)
                e = values[g.component - 1]
                assert g.explained == pytest.approx(e / np.trace(v), rel=1e-6) and 0 <= g.identity_error <= 1e-4
                apart = min((abs(e - o) for j, o in enumerate(values) if j != g.component - 1), default=e)
                if apart > 1e-6 * values[0]:
                    assert abs(g.whitened) == pytest.approx(abs(m[i] @ vectors[:, g.component - 1]) / math.sqrt(e), rel=tolerance, abs=1e-8)
    if found and len(set(ids)) == n:
        # one sign for all rows, and a covariance of one
        order = sorted(((g.component, g.vec_id is not None, g.vec_id or 0, g.whitened) for g in got))
        white = np.array([w for *_, w in order]).reshape(found, n)
        assert np.abs(np.cov(white, bias=True).reshape(found, found) - np.eye(found)).max() < 1e-4


def _run(spark, rows, schema=SCHEMA):
    ship_package(spark)
    return whitening.whiten(spark.createDataFrame(rows, schema).repartition(4)).collect()


def test_random_vectors(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.standard_normal(12) * np.arange(1, 13) / 10 + 3).tolist(), 0) for i in range(500)]
    _check(rows, _run(spark, rows))


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(3).tolist(), None) for i in range(40)]
    rows += [(None, [0.5, 0.25, -1.0], 1), (7, [1.0, 2.0, 3.0], 1), (7, [1.0, 2.0, 3.0], 1)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0, None, 2.0], 1), (103, [float("nan"), 0.0, 0.0], 1), (104, [float("inf"), 0.0, 0.0], 1), (105, [0.0, 0.0], 1), (106, [1.0] * 4, 1)]
    got = _run(spark, rows)
    _check(rows, got)
    assert {g.vec_id for g in got} == {None, *range(40)}
    assert sum(g.vec_id == 7 for g in got) == 9


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(i, [0.5, -0.5], 0) for i in range(9)]])
def test_nothing_to_whiten(spark, rows):
    assert _run(spark, rows) == []


def test_fewer_directions_than_components(spark):
    draw = np.random.default_rng(5)
    flat = [(i, [t, 2 * t, float(j)], 0) for i, (t, j) in enumerate(zip(draw.integers(-50, 50, 90).tolist(), draw.integers(0, 9, 90).tolist()))]
    rows = [(i, [float(c) for c in v], label) for i, v, label in flat]
    got = _run(spark, rows)
    assert {g.component for g in got} == {1, 2}
    _check(rows, got)


def test_huge_entries_stay_exact(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.standard_normal(3) * 10.0**9).tolist(), 0) for i in range(60)]
    got = _run(spark, rows, "vec_id long, embedding array<float>, label int")
    _check(rows, got, tolerance=1e-6)
    assert any(g.deviation is None for g in got)
    assert _run(spark, [*rows, (99, [1e30, -1e38, 1.0], 0)])  # held, not refused


def test_partitions_do_not_matter(spark):
    ship_package(spark)
    draw = np.random.default_rng(8)
    rows = spark.createDataFrame([(i, draw.standard_normal(6).tolist(), 0) for i in range(300)], SCHEMA)
    one, many = (whitening.fit_whitening(rows.repartition(p).select("embedding")) for p in (1, 7))
    assert one.totals == many.totals and (one.values == many.values).all() and (one.components == many.components).all()


def test_clashing_columns(spark):
    ship_package(spark)
    draw = np.random.default_rng(9)
    rows = spark.createDataFrame([(i, draw.standard_normal(3).tolist(), 0) for i in range(30)], SCHEMA)
    clash = rows.selectExpr("label AS component", "vec_id", "1 AS n", "2 AS i", "embedding", "'x' AS total", "3 AS length")
    assert sorted(whitening.whiten(clash).collect()) == sorted(whitening.whiten(rows).collect())


def test_query_equals_a_plain_computation(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None, 0) for r in table.collect()]
    _check(rows, whitening.op12_whitening(spark, sf_dir).collect())
