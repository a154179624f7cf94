import hashlib
import random
import re

import pytest
from compare import compare, duckdb_connection

from stayrate.llm import pii
from stayrate.llm.oracle import ORACLE

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if _holds(k, m.group())]


def _check(rows, got):
    assert len(got) == len(rows)
    expected = sorted((str(i), t or "") for i, t in rows)
    texts = dict(expected)
    for r in got:
        want = plain_spans(texts[str(r.doc_id)])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[str(r.doc_id)], want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PLAIN]
        told = r.spans.split(",") if r.spans else []
        assert [s for s in told if s.split(":")[0] in PLAIN] == want
        assert len(told) == len(r.scores.split(",") if r.scores else []) and 0 <= r.score <= 1


def _run(documents, rows):
    return pii.span_digests(pii.find_personal_data(documents(rows))).collect()


def test_odd_rows(documents, odd_rows):
    _check(odd_rows, _run(documents, odd_rows))
    assert _run(documents, []) == []


def test_random_texts_equal_plain_expressions(documents):
    draw = random.Random(7)
    pieces = ["a", "Z", "9", "0", "1", "25", "256", ".", "..", "@", "@", "_", "-", "+", " ", "  ", "(", ")", "é", "😀", "x@y.z", "1.2.3.4", "+49 89 1234567", "4111111111111111", "\n", "%", "GB29NWBK60161331926819"]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randrange(60)))) for i in range(3000)]
    rows += [(9000, "a@b.c_x@d.e"), (9001, "0300.1.002.3 999.1.1.1 1.2.3.4.5.6.7.8"), (9002, "4111 1111-1111 1111 4111 1111 1111 1111 1"), (9003, "++4 1234 567.. +1 (743) 555-3824")]
    _check(rows, _run(documents, rows))


def test_long_texts_need_no_square(documents):
    n = 300_000  # plain backtracking takes minutes for each of these
    domain = "x@" + "a." * n + "b"
    hosts = "10.0.0.1 é" * (n // 10)
    rows = [(1, "9" * n), (2, "a" * n), (3, domain), (4, "1-" * n), (5, "+1" + " (" * n), (6, "AA00" * n), (7, hosts), (8, "@" + "a" * n)]
    got = {r.doc_id: r.spans for r in _run(documents, rows)}
    assert got.pop(3) == f"email:0:{len(domain)}"
    assert got.pop(7) == ",".join(f"ip:{i}:{i + 8}" for i in range(0, n, 10))
    assert set(got.values()) == {""}


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", ["iban:7:34"]),
        ("GB29NWBK60161331926819", ["iban:0:22"]),
        ("GB29NWBK60161331926818", []),  # mod-97 fails
        ("xGB29NWBK60161331926819", []),  # not a word of its own
        ("GB29NWBK60161331926819x", []),
        ("DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["iban:0:27"]),
        ("ZZ89 3704 0044 0532 0130 00", []),  # no such country
        ("her SSN: 536-22-1234.", ["ssn:9:20"]),
        ("part 536-22-1234", []),  # nothing says that it is one
        ("ssn 666-22-1234 ssn 536-00-1234 ssn 536-22-0000 ssn 1536-22-1234", []),
    ],
)
def test_added_kinds(documents, text, added):
    (row,) = _run(documents, [(1, text)])
    assert [s for s in row.spans.split(",") if s.startswith(("iban", "ssn"))] == added


def test_words_near_a_span_change_its_score(documents):
    rows = [(1, "host 10.1.2.3"), (2, "x 10.1.2.3"), (3, "version 10.1.2.3"), (4, "VERSION 10.1.2.3"), (5, "versions 10.1.2.3"), (6, "host " + "z" * 50 + " 10.1.2.3")]
    got = {r.doc_id: (r.score, r.spans) for r in _run(documents, rows)}
    assert [got[i][0] for i in range(1, 7)] == [0.7, 0.5, 0.2, 0.2, 0.5, 0.5]
    assert got[3][1] == "ip:8:16"  # base spans stay whatever their score


def test_other_columns_do_not_matter(documents):
    clash = documents([(1, "a@b.cd")]).selectExpr("*", "1 AS spans", "2 AS email", "'x' AS _found", "3 AS _kept")
    assert pii.span_digests(pii.find_personal_data(clash)).first().spans == "email:0:6"


def test_plan_is_one_projection_without_python(spark, sf_dir):
    plan = pii.op13_pii(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_extract_all") == 6


def test_whole_table_equals_sql_and_plain_expressions(spark, sf_dir):
    query = pii.op13_pii(spark, sf_dir)
    assert compare(query, duckdb_connection(sf_dir), ORACLE["op13_pii"]) is None
    _check([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()], query.collect())
