import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from stayrate.llm import repair
from stayrate.llm.common import ship_package

SCHEMA = "conv_id long, turn long, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            yield from [(conv, turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))


def cheapest(rows):
    """Least (cost, audit, lines) over every sequence of edits; ``rows`` are (role, text, fault)."""
    grammar = re.compile("(s?(ua)+)?")
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, inserted):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = best(i + 1, last, 0)
            found.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                for to, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if to[:1] and to[:1] in follows[last]:
                        cost, audit, lines = best(i + 1, to[:1], 0)
                        found.append((cost + price + (fault == "truncated"), letter + audit, (f"{to}:{text}", *lines)))
        if inserted < 4:
            for to in ("user", "assistant"):
                if to[0] in follows[last]:
                    cost, audit, lines = best(i, to[0], inserted + 1)
                    found.append((cost + 2, "I" + audit, (f"{to}:", *lines)))
        return min(found, key=lambda x: x[:2], default=(10**9, "", ()))

    result = best(0, "", 0)
    assert grammar.fullmatch("".join(line[0] for line in result[2]))
    return result


def expected(rows):
    groups = defaultdict(list)
    for r in damaged(rows):
        groups[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        group = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, told, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, _, role, text in group:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            told.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, lines = cheapest(tuple(told))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def _run(spark, rows, **sizes):
    ship_package(spark)
    found = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert len(got) == found.count()
    return got


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", None), (1, 2, None, "Hi."), (1, None, "user", "First."), (1, 3, "tool", "x"),
    (2, 5, "assistant", "Same."), (2, 5, "assistant", "Same."), (2, 5, "user", "Same."), (2, 9, "assistant", "Same. \t\n"),
    (None, 0, "user", "No id."), (None, None, "user", "No id."), (3, 0, "", ""), (4, None, None, None), (5, 7, "user", "a" * 300_000 + "."),
    (6, 0, "ape", "é😀!"), (6, 1, "unicorn", "Yes?\x1f"), (7, 1, "user", "Line\nline.\n"),
]


@pytest.mark.parametrize("size", [1024, 2, 1])
def test_odd_rows(spark, size):
    assert _run(spark, ODD, rows_in_block=size) == expected(ODD)


def _talks(n, longest, seed):
    draw = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None]
    texts = ["Yes.", "No!", "Well", "Why?", "", " ", None, "Right. ", "So then"]
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, longest)):
            role = ("user", "assistant")[turn % 2] if draw.random() < 0.6 else draw.choice(roles)
            text = draw.choice(texts) if draw.random() < 0.6 else f"Turn {turn}."
            rows += [(conv, None if draw.random() < 0.05 else turn + (turn > 3) * draw.randrange(2), role, text)] * (1 + (draw.random() < 0.1))
    return rows


@pytest.mark.parametrize("size", [1024, 4])
def test_random_talks(spark, size):
    rows = _talks(150, 14, 1)
    assert _run(spark, rows, rows_in_block=size) == expected(rows)


def test_long_conversation_in_many_blocks(spark):
    rows = [(1, t, *r[2:]) for t, r in enumerate(_talks(400, 8, 2))] + _talks(20, 5, 3)[:40]
    rows = [(2 if i >= len(rows) - 40 else r[0], *r[1:]) for i, r in enumerate(rows)]
    got = _run(spark, rows, rows_in_block=16)
    assert got == _run(spark, rows)
    assert got[2] == expected(rows[-40:])[2]
    assert got[1][6].count("I") and len(got[1][6]) > 1000


def test_all_rows_alike(spark):
    rows = [(1, None, "user", "Same.")] * 500 + [(2, t, "user", "Same.") for t in range(300)]
    got = _run(spark, rows, rows_in_block=64)
    assert got == _run(spark, rows)
    for conv, group in ((1, rows[:500]), (2, rows[500:])):
        left = list(damaged(group))
        assert got[conv][1] + got[conv][2] + (got[conv][5] > 0) >= len(left) - 2
        assert len(got[conv][6].replace("I", "")) == len(left)


def test_empty_table_and_nothing_left(spark):
    assert _run(spark, []) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert _run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_tables_equal_edits():
    draw = random.Random(4)
    for _ in range(300):
        signature = "".join(draw.choice("suaxSUAXd") for _ in range(draw.randrange(9)))
        node, costs = repair.end_node(repair.END), repair.SAME
        for symbol in reversed(signature):
            node, costs = repair.node_before(symbol, node), repair.table_before(symbol, costs)
        follows = repair.end_node(repair.END)[0]
        if signature:
            assert node[0] == tuple(min(c + f for c, f in zip(row, follows)) for row in costs)


def test_repaired_turns_follow_the_grammar(spark):
    ship_package(spark)
    rows = _talks(60, 9, 5)
    edited = repair.edited_blocks(spark.createDataFrame(rows, SCHEMA), 4)
    by = defaultdict(list)
    for r in repair.repaired_turns(edited).orderBy("conv_id", "part", "seq", "place").collect():
        by[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {c: v[-1] for c, v in expected(rows).items()}
    assert {c: hashlib.sha256("\n".join(by[c]).encode()).hexdigest() for c in digests} == digests


def test_clashing_columns(spark):
    ship_package(spark)
    rows = spark.createDataFrame(_talks(20, 6, 6), SCHEMA)
    clash = rows.selectExpr("1 AS n", "conv_id", "2 AS part", "turn", "role", "text", "'x' AS signature", "3 AS fault", "4 AS _conv", "5 AS initial")
    assert sorted(repair.repair(clash).collect()) == sorted(repair.repair(rows).collect())


def test_query_equals_a_plain_reading_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in repair.op11_structure_repair(spark, sf_dir).collect()}
    assert got == expected(rows)
