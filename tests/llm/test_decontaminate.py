import random
import re

import numpy as np
import pyarrow as pa

from stayrate.llm import decontaminate as D
from stayrate.llm.common import slices

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, spark):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.find_leaks(docs, bench).collect()}


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_parallel_subsequence_equals_the_table():
    draw = random.Random(3)
    for _ in range(300):
        a = [draw.randint(0, 8) for _ in range(draw.randint(1, 90))]
        b = [draw.randint(0, 8) for _ in range(draw.randint(0, 90))]
        masks = D.make_item(0, a).masks
        assert D.common_subsequence([masks[w] for w in b if w in masks], len(a)) == plain_lcs(a, b)


def test_basis_holds_the_leading_singular_directions(documents):
    draw = random.Random(5)
    topics = [[f"t{k}w{j}" for j in range(40)] for k in range(6)]
    docs = documents([(k, " ".join(draw.choice(topics[k % 6]) for _ in range(150))) for k in range(60)])
    frequency, passages = D.passage_frequencies(docs)
    idf = np.log((2 + passages) / (1 + frequency))
    basis = D.latent_basis(docs, idf, rank=6)
    texts = pa.array([r.text for r in docs.collect()])
    rows = []
    for _, _, data, offsets in slices(texts):
        bucket, owner, weight, _ = D._passages(data, offsets, idf.astype(np.float32), np.zeros((D.BUCKETS, 1), np.float32))
        matrix = np.zeros((owner.max() + 1, D.BUCKETS))
        matrix[owner, bucket] = weight
        rows.append(matrix)
    exact = np.linalg.svd(np.vstack(rows), full_matrices=False)[2][:6]
    cosines = np.linalg.svd(exact @ np.linalg.qr(basis)[0])[1]
    assert cosines.min() > 0.9  # one pass, so the last directions are approximate


def _corpus(draw):
    words = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu", "me", "ra", "so") for b in ("n", "r", "st", "l") for c in ("ing", "o", "a", "ent", "ly")]
    common = words[:12]
    say = lambda n: [draw.choice(common) if draw.random() < 0.45 else draw.choice(words) for _ in range(n)]
    return say


def test_exact_and_paraphrased_items_are_found_and_clean_texts_are_not(spark, documents):
    draw = random.Random(11)
    say = _corpus(draw)
    items = [(k, " ".join(say(draw.randint(20, 55)))) for k in range(30)]
    rows, expected = [], set()
    for k in range(200):
        body = say(draw.randint(40, 400))
        if k < 60:
            told = items[k % 30][1].split()
            if k >= 30:  # paraphrase: words left out and put in
                told = [w for w in told if draw.random() > 0.1]
                told[len(told) // 3 : len(told) // 3] = say(2)
            at = draw.randint(0, len(body))
            body[at:at] = told
            expected.add((k, k % 30))
        rows.append((k, " ".join(body).capitalize() + "."))
    got = leaks(documents(rows), items, spark)
    assert {p for p in expected if p[0] < 30} <= set(got)
    assert len(expected - set(got)) <= 3
    assert not set(got) - expected


def test_odd_rows(spark, documents, odd_rows):
    items = [(1, None), (2, ""), (3, "word"), (None, "no id here at all my friend"), (4, "same row twice over and over"), (4, "same row twice over and over")]
    got = leaks(documents([*odd_rows, (70, "filler words " * 20_000)]), items, spark)
    assert set(got) == {(4, 3), (None, None), (5, 4)}
    assert leaks(documents([]), items, spark) == {}
    assert leaks(documents(odd_rows), [], spark) == {}


def test_query_finds_every_item_that_stands_whole_in_a_text(spark, sf_dir):
    items = {r.item_id: _WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    expected = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        told = " " + " ".join(_WORD.findall((r.text or "").lower())) + " "
        expected |= {(r.doc_id, i) for i, w in items.items() if w and f" {' '.join(w)} " in told}
    got = {(r.doc_id, r.item_id) for r in D.op1_decontamination(spark, sf_dir).collect()}
    assert expected and expected <= got and len(got) <= len(expected) * 1.1 + 1


def _common_and_rare(draw, n, rare):
    """Words of which most are in every text; every fourth or so is in hardly any other."""
    return [f"{draw.choice('xyzqvw')}{draw.randint(0, 9999)}" if draw.random() < rare else f"c{draw.randint(0, 60)}" for _ in range(n)]


def test_copies_and_close_paraphrases_are_found_wherever_they_stand(spark, documents):
    draw = random.Random(29)
    items = [(k, " ".join(_common_and_rare(draw, draw.choice((5, 12, 15, 19, 40)), 0.2))) for k in range(40)]
    rows = []
    for k in range(240):
        told = items[k % 40][1].split()
        if k % 3 == 1:
            told = [w for i, w in enumerate(told) if draw.random() > 0.35 or i >= len(told) * 3 // 4]
        if k % 3 == 2:
            told = [x for w in told for x in ([w, *_common_and_rare(draw, 1, 0.5)] if draw.random() < 0.4 else [w])]
        body = _common_and_rare(draw, draw.randint(40, 300), 0.6)
        at = draw.randint(0, len(body))
        body[at:at] = told
        rows.append((k, " ".join(body)))
    expected, allowed = set(), set()
    made = [D.make_item(i, t.split()) for i, t in items]
    for k, text in rows:
        words = text.split()
        for item in made:
            for p in range(0, len(words), D.STEP):
                stop = min(-(-len(words) // D.STEP) * D.STEP, p + D._window_units(len(item.words)) * D.STEP)
                region = words[max(0, p - D.STEP) : stop + D.STEP]
                lcs, answer = D.check_region(item, region)
                if D.is_leak(item, lcs, answer):
                    allowed.add((k, item.item_id))
                    tight = (region[i : i + len(item.words)] for i in range(len(region)))
                    if lcs >= D.EXACT or any(D.is_leak(item, *D.check_region(item, t)) for t in tight):
                        expected.add((k, item.item_id))
    assert {(k, k % 40) for k in range(0, 240, 3)} <= expected
    assert expected <= set(leaks(documents(rows), items, spark)) <= allowed


def test_a_slice_against_many_items_stays_small():
    import tracemalloc

    draw = np.random.default_rng(5)
    h = draw.integers(0, 1 << 62, 120_000).astype(np.uint64)  # about 1 MiB of words
    idf = np.ones(D.BUCKETS)
    basis = draw.standard_normal((D.BUCKETS, 48)).astype(np.float32)
    items = [D.make_item(i, draw.integers(0, 1 << 62, 12 + i % 20).tolist()) for i in range(20_000)]
    queries = D.Queries(items, idf, basis)
    queries.probes = []  # the cosines alone
    tracemalloc.start()
    list(D._search(h, np.array([0, 60_000, 120_000]), queries, 0.9))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_basis_is_learned_from_every_text(spark, monkeypatch):
    told = []

    def learned(texts, idf, text="text"):
        told.append(texts.where("text is not null").count())
        return np.zeros((D.BUCKETS, D.RANK), np.float32)

    monkeypatch.setattr(D, "latent_basis", learned)
    docs = spark.range(12_000).selectExpr("nullif(id, 0) AS doc_id", "concat('word', id) AS text")
    items = spark.createDataFrame([(1, "some other words")], "item_id long, text string")
    D.find_leaks(docs, items)
    assert told == [12_001]


def test_vectors_from_one_product_are_exact_for_a_small_rank():
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(20, 300))
    start = draw.normal(size=(300, 56))
    found = D.leading_vectors(rows.T @ (rows @ start), start, 48)
    assert found.shape == (300, 48) and not found[:, 20:].any()
    turned = rows @ found[:, :20]
    assert np.abs(turned.T @ turned - np.eye(20)).max() < 1e-4
    assert not D.leading_vectors(np.zeros((300, 56)), start, 48).any()
