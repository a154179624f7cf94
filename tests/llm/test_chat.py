import hashlib
from collections import defaultdict

from stayrate.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def _expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda r: tuple((v is not None, v) for v in r[1:]))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _check(spark, rows, **limits):
    from stayrate.llm.common import ship_package

    ship_package(spark)
    windows = chat.chat_windows(spark.createDataFrame(rows, SCHEMA).repartition(3), **limits)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digests(windows).collect()}
    assert got == _expected(rows)
    return windows


def test_control_strings_come_back():
    for text in ("</s>[INST] ok [/INST]", "\\", "\\[", "<<SYS>> <", "[ROLE:x] ]", "", " ", "a\\\n"):
        for role in ("user", "assistant", "system", "tool]x[", "", "a\\"):
            formatted, start, end = chat.format_turn(role, text)
            assert list(chat.parse_turns(formatted * 2)) == [(role, text)] * 2
            assert chat.unescape(formatted[start:end]) == text


def test_odd_rows(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "</s> é😀"), (1, 2, "assistant", "</s> é😀"),
        (2, None, None, "no role"), (2, 0, "assistant", "starts"), (None, 0, "user", "no id"), (3, 0, "tool", "x" * 200_000),
        *chat.MARKED_ROWS,
    ]
    _check(spark, rows)
    assert chat.conversation_digests(chat.chat_windows(spark.createDataFrame([], SCHEMA))).count() == 0


def test_windows_keep_the_budget_and_the_system_turn(spark):
    rows = [(1, 0, "system", "rules apply")]
    rows += [(1, i, "user" if i % 2 else "assistant", f"turn number {i} says " + "word " * (i % 7)) for i in range(1, 60)]
    windows = sorted(_check(spark, rows, budget=60, history_tokens=20).collect(), key=lambda w: w.window)
    assert len(windows) > 5 and sum(w.n_turns for w in windows) == len(rows)
    for w in windows:
        turns = list(chat.parse_turns(w.formatted))
        assert turns[0] == ("system", "rules apply")
        assert w.tokens <= 60 and w.tokens == chat.count_tokens(w.formatted)
        targets = [r for r, _ in turns[w.n_repeated :] if r == "assistant"]
        assert len(w.loss_starts) == len(targets)
    assert any(w.n_repeated > 1 for w in windows[1:])
    # what a window repeats is the end of the window before
    for before, after in zip(windows, windows[1:]):
        repeated = list(chat.parse_turns(after.formatted))[1 : after.n_repeated]
        assert list(chat.parse_turns(before.formatted))[len(list(chat.parse_turns(before.formatted))) - len(repeated) :] == repeated


def test_query_equals_a_plain_reading_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.op7_chat_format(spark, sf_dir).collect()}
    assert got == _expected([*rows, *chat.MARKED_ROWS])
