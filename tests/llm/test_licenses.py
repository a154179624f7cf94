import re

from stayrate.llm import licenses

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: The contract's phrases.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def expected(text):
    w = _WORD.findall((text or "").translate(_LOWER))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1


def test_query_equals_a_plain_scan(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(licenses.op9_license_scan(spark, sf_dir).collect(), texts)


def test_places_labels_and_odd_rows(spark, documents, odd_rows, tmp_path):
    rows = [
        *odd_rows, (20, "MIT License, mit license; the MIT.License!"), (21, "GNU general public license " * 3 + "gnu general public"), (22, "apache"), (23, "license mit"),
        (24, "cc by cc by-nc 4.0 ÀPACHE apache license"), (25, "filler " * 50_000 + "Apache License"), (26, "Permission is hereby granted, free of charge, to any person obtaining a copy of THAT software"),
    ]
    rows = [r for r in rows if r[0] not in (None, 5)]  # the query is held against a dictionary by id
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = licenses.op9_license_scan(spark, str(tmp_path)).collect()
    check(got, dict(rows))
    by = {r.doc_id: r for r in got}
    assert by[24].base_labels == "apache,cc-by" and by[26].labels == "mit-grant" and 0.9 < by[26].score < 1
    assert by[25].first_word == 50_000 and by[1].score == 0


def test_every_row_is_scanned(documents, odd_rows):
    assert licenses.scan(documents(odd_rows)).count() == len(odd_rows)
    assert licenses.scan(documents([])).count() == 0


def test_rarest_words_are_indexed():
    compiled = licenses.compile_templates(licenses.TEMPLATES, {"license": 50, "mit": 3, "apache": 2})
    by = {c.template.label: c for c in compiled}
    assert by["mit"].indexed == [0, 1] and by["gpl"].indexed[0] in (0, 1, 2)
    assert all(p in c.required for c in compiled for p in c.indexed)
