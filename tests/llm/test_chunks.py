import random

import numpy as np
from pyspark.sql import functions as F

from stayrate.llm import chunks


def text_of(draw, n):
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(n))


def cut(text):
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    _, start, length, _ = chunks.chunk(raw, np.array([0, len(raw)]))
    return [text.encode()[a : a + n] for a, n in zip(start, length)]


def test_chunks_cover_a_text_and_resist_a_shift():
    draw = random.Random(4)
    text = text_of(draw, 300)
    parts = cut(text)
    assert b"".join(parts) == text.encode()
    moved = cut("inserted words here " + text[:700] + "x" + text[700:])
    assert len(set(parts) & set(moved)) >= len(parts) - 6


def test_rolling_hash_is_the_gear_recurrence():
    data = np.frombuffer(text_of(random.Random(2), 20).encode(), dtype=np.uint8)
    fast = chunks.gear(data)
    for i in range(16, len(data)):
        h = 0
        for b in data[i - 15 : i + 1]:
            h = ((h << 1) + int(chunks._GEAR[b])) & 0xFFFFFFFF
        # the recurrence over the window: what is older than 16 bytes is left out
        assert int(fast[i]) == h


def planted(seed=1):
    draw = random.Random(seed)
    passages = [text_of(draw, 55) for _ in range(4)]
    rows, holders = [], {}
    for k in range(80):
        body = text_of(draw, draw.randint(30, 400))
        if k % 4 == 0:
            p = passages[(k // 4) % 4]
            at = body.index(" ", draw.randint(0, len(body) // 2))
            body = body[:at] + " " + p + body[at:]
            holders.setdefault((k // 4) % 4, []).append(k)
        elif k % 9 == 0:
            body += " Released under the MIT License."  # a line, not a passage
        rows.append((k, body))
    rows.append((500, rows[1][1]))  # an exact copy
    rows.append((501, "ab cd " * 3000))  # repeats itself only
    return rows, holders, passages


def test_finds_every_repeated_passage_and_nothing_else(documents):
    rows, holders, _ = planted()
    spans = {r.doc_id: r.spans for r in chunks.repeated_spans(documents(rows)).collect()}
    assert set(spans) == {i for ids in holders.values() for i in ids} | {1, 500}
    for ids in holders.values():
        assert not any(s.repeat for s in spans[min(ids)])
        assert all(any(s.repeat for s in spans[i]) for i in ids if i != min(ids))
    assert sum(s.length for s in spans[500] if s.repeat) == len(rows[1][1])


def test_result_does_not_depend_on_partitions(spark, documents):
    rows, _, _ = planted(3)
    one = documents(rows).coalesce(1)
    many = documents(rows).repartition(13)
    assert sorted(map(str, chunks.repeated_spans(one).collect())) == sorted(map(str, chunks.repeated_spans(many).collect()))


def test_removal_keeps_the_first_holder(documents):
    rows, holders, passages = planted(5)
    out = {r.doc_id: r.text for r in chunks.remove_repeats(documents(rows).withColumn("spans", F.lit(7)).withColumn("_id2", F.lit(1))).collect()}
    before = dict(rows)
    assert set(out) == set(before) and out[500] == "" and out[501] == before[501]
    for p, ids in holders.items():
        assert out[min(ids)] == before[min(ids)]
        for i in ids:
            if i != min(ids):
                assert len(before[i]) - len(out[i]) > len(passages[p]) / 2
                assert out[i][:20] == before[i][:20]


def test_odd_rows(documents, odd_rows):
    long_ = "é" * 3000 + " tail of it"
    rows = [*odd_rows, (90, long_), (91, long_)]
    out = sorted(((r.doc_id, r.text) for r in chunks.remove_repeats(documents(rows)).collect()), key=str)
    assert out == sorted([*odd_rows, (90, long_), (91, "")], key=str)
    assert chunks.repeated_spans(documents([])).count() == 0


def test_query_finds_every_shared_run_of_51_words(spark, sf_dir):
    rows = [(r.doc_id, (r.text or "").split()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    seen = {}
    for i, w in rows:
        for k in range(len(w) - 50):
            seen.setdefault(tuple(w[k : k + 51]), set()).add(i)
    expected = {i for ids in seen.values() if len(ids) > 1 for i in ids}
    got = chunks.op4_substring_dedup(spark, sf_dir).collect()
    assert expected <= {r.doc_id for r in got}
    text = {i: " ".join(w) for i, w in rows}
    for r in got:  # whatever is reported is really elsewhere
        assert 0 <= r.repeated_bytes <= r.shared_bytes <= len(text[r.doc_id].encode()) + 100


def test_periodic_passages_and_short_words_are_found(documents):
    draw = random.Random(12)
    short = lambda n, most, of: " ".join("".join(draw.choice(of) for _ in range(draw.randint(1, most))) for _ in range(n))
    passages = ["la " * 60, "ha ha! " * 60, "no no no " * 60]
    passages += [short(51, most, of) for most, of in ((2, "abcdefghijklmnop"), (2, "0123456789"), (3, "abcdefghijklmnop")) for _ in range(40)]
    rows = [(2 * k + i, f"{text_of(draw, 40)} {p} {text_of(draw, 40)}") for k, p in enumerate(passages) for i in (0, 1)]
    rows.append((1000, text_of(draw, 40) + " " + "la " * 180 + text_of(draw, 40)))
    got = {r.doc_id for r in chunks.repeated_spans(documents(rows)).collect()}
    assert got == {i for i, _ in rows}


def test_repeated_rows_give_one_result_row_in_any_layout(documents):
    draw = random.Random(21)
    words = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(n))
    shared = words(120)
    rows = [(1, f"{words(40)} {shared}"), (2, f"{shared} {words(40)}")]
    rows += [rows[1]] * 3
    results = []
    for parts in (1, 5):
        found = chunks.repeated_spans(documents(rows).repartition(parts)).collect()
        results.append(sorted((r.doc_id, r.text_hash, tuple(map(tuple, r.spans))) for r in found))
    assert results[0] == results[1] and [r[0] for r in results[0]] == [1, 2]
