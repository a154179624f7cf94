import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stayrate.llm import jaccard

_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(rows):
    """(doc_id, size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k), i)) for k, (i, s) in enumerate(sets)), key=str)


def found(docs, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(docs, **options).collect()), key=str)


def planted(seed, count=60):
    """Families of edited copies, a passage that many texts share, and strangers."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [draw.choice(words) for _ in range(60)]
    rows = []
    for _ in range(count):
        base = [draw.choice(words) for _ in range(draw.choice((3, 6, 40, 120, 500)))]
        if draw.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(draw.choice((1, 1, 2, 5))):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(copy) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            if draw.random() < 0.3:
                copy = copy[: int(len(copy) * draw.uniform(0.75, 1))] or copy
            rows.append((len(rows) + 10, " ".join(copy)))
    return rows


@pytest.mark.parametrize("frequent", [64, 2])
def test_equals_comparing_all_pairs(documents, odd_rows, frequent):
    rows = [*odd_rows, *planted(frequent)]
    assert found(documents(rows), frequent=frequent) == brute_force(rows)


def test_a_large_family_beside_strangers_with_its_passage(documents):
    draw = random.Random(9)
    words = [f"w{k}" for k in range(300)]
    base = [draw.choice(words) for _ in range(80)]
    rows = []
    for k in range(90):
        copy = list(base)
        copy[draw.randrange(len(copy))] = f"own{k}"
        rows.append((k, " ".join(copy)))
    for k in range(40):
        rows.append((1000 + k, " ".join(base[:50] + [draw.choice(words) for _ in range(draw.randint(5, 40))])))
    assert found(documents(rows), frequent=8) == brute_force(rows)


@pytest.mark.parametrize("length", [30, 290, 330, 400, 440])
def test_texts_that_are_almost_all_shared_passages(documents, length):
    """Around the sizes from which shingles are stored in part; unlike texts share most of their words."""
    draw = random.Random(length)
    passages = [[f"p{k}w{j}" for j in range(length // 5)] for k in range(6)]
    rows = []
    for k in range(70):
        text = [w for p in draw.sample(passages, 5) for w in p]
        if draw.random() < 0.5:
            text = [w for p in passages[:5] for w in p]
        own = [f"own{k}x{j}" for j in range(draw.choice((0, 0, length // 12, length // 8, length // 5, length // 3)))]
        cut = draw.randint(0, length // 6)
        rows.append((k, " ".join((text + own)[cut:])))
    assert found(documents(rows), frequent=4) == brute_force(rows)


def test_empty_table(documents):
    assert found(documents([])) == []


def test_query_equals_comparing_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op3_ngram_jaccard(spark, sf_dir).collect()), key=str) == brute_force(rows)


def test_a_bound_from_sketches_never_lies_below_what_is_shared():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 900, dtype=np.uint64)
    made = [np.unique(np.concatenate([base[: draw.integers(0, 900)], draw.integers(0, 1 << 63, draw.integers(0, 300), dtype=np.uint64)])) for _ in range(60)]
    made += [base[:0], base[:1], np.unique(base)]
    held = jaccard.sketches(np.concatenate(made), np.concatenate([[0], np.cumsum([len(x) for x in made])]))
    bits = [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in held]
    for one, x in zip(made, bits):
        for two, y in zip(made, bits):
            shared = len(np.intersect1d(one, two))
            most = jaccard.most_shared(x, y, len(one), len(two))
            assert shared <= most <= min(len(one), len(two))
            if len(one) > 100 and shared < len(one) / 2 <= len(two) / 2 and 3 * len(two) <= 4 * len(one):  # of sizes that are compared
                assert most < 0.75 * len(one)  # unlike sets are told apart


def test_pairs_are_compared_once_with_repeated_ids(documents):
    """One doc_id on equal rows, on unlike texts and on none: every text is compared under its own set."""
    words = [f"w{k}" for k in range(60)]
    near = " ".join(words[:55])
    rows = [(1, " ".join(words)), (1, " ".join(words)), (1, "x y z"), (2, near), (None, near + " end"), (None, "x y q r s t")]
    assert found(documents(rows)) == brute_force(rows)


def test_near_copies_unlike_most_others_make_no_rows_by_the_square(documents, monkeypatch):
    """Near copies of one text, each with its own words in four places: few pairs link, and no table holds all pairs."""
    draw = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(240):
        text = list(base)
        for place in draw.sample(range(150), draw.choice([1, 2, 3, 4, 4, 4])):
            text[place] = f"own{k}x{place}"
        rows.append((k, " ".join(text)))
    made = []
    monkeypatch.setattr(jaccard, "stored", lambda df, name, write=jaccard.stored: made.append((name, (out := write(df, name)).count())) or out)
    assert found(documents(rows), frequent=4) == brute_force(rows)
    assert max(n for name, n in made if name in ("pairs", "likely", "links")) < 240 * 30  # of 28,680 pairs


def test_cells_rule_out_what_sketches_rule_out():
    """Sketches of unlike lengths, sets of one component and of none marked small."""
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 63, 140, dtype=np.uint64)
    made = [np.unique(np.concatenate([base[: draw.integers(20, 140)], draw.integers(0, 1 << 63, draw.integers(1, 30), dtype=np.uint64)])) for _ in range(70)]
    held = jaccard.sketches(np.concatenate(made), np.concatenate([[0], np.cumsum([len(x) for x in made])]))
    rows = [{"sid": k, "component": k // 3, "size": len(x), "small": k % 4 > 0, "top": k >= 40, "sketch": held[k].as_py()} for k, x in enumerate(made)]
    kept = {(int(i), int(j)) for a, b in jaccard._possible(pa.Table.from_pylist(rows[:40]), pa.Table.from_pylist(rows)) for i, j in zip(a, b)}
    bits = [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in held]
    expected = set()
    for one in rows[:40]:
        for two in rows:
            i, j, n, m = one["sid"], two["sid"], one["size"], two["size"]
            if (two["top"] or j < i) and one["component"] != two["component"] and (one["small"] or two["small"]) and 4 * n >= 3 * m and 4 * m >= 3 * n:
                expected |= {(i, j)} if jaccard._similar(jaccard.most_shared(bits[i], bits[j], n, m), n, m) else set()
    assert kept == expected and len(kept) > 20
    assert {len(x) for x in bits if len(x)} >= {32, 64} and len({len(bits[i]) != len(bits[j]) for i, j in kept}) == 2
