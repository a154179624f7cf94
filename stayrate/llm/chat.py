"""Chat formatting in budgeted windows.

Conversations are dealt out by id and read in turn order as a stream, so a conversation of any
length passes through a task without being held. Prefix sums of turn tokens choose the windows: a
window takes turns while the sum from its start stays within the budget, and always ends between
turns. Each later window starts with the conversation's opening system turn and the last turns of
the window before, as many as ``history_tokens`` allows; repeated assistant turns are masked, so
every assistant text is a target exactly once.

Template: a turn is an opening mark, the escaped text and a closing mark. Backslash, ``[`` and ``<``
(in role names ``]`` too) get a backslash before them inside texts, so a mark inside a text can
never be read as one, and removing the backslashes gives the text back.

A turn larger than the budget is a window's only new turn (and ``tokens`` is then over the budget);
texts are never cut. Null text is empty, a null role is the empty role, a null ``turn`` sorts first,
rows with a null ``conv_id`` form one conversation. Rows with equal turn numbers are ordered by role
and text, and repeated rows are turns like any other. Other columns are ignored. No rows give no
windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.common import table

BUDGET = 512
HISTORY = 128

#: Opening and closing mark by role; any other role is named in its mark.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("[ANSWER] ", " </s>\n"),
}
OTHER_CLOSE = " [/ROLE]\n"

_SPECIAL = re.compile(r"[\\\[<]")
_ROLE_SPECIAL = re.compile(r"[\\\[<\]]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TOKEN = re.compile(r"\w+|[^\w\s]")
_TURN = re.compile(
    r"(?:(?P<sys><<SYS>> )|(?P<user>\[INST\] )|(?P<asst>\[ANSWER\] )|\[ROLE:(?P<role>(?:[^\\\[<\]]|\\.)*)\] )"
    r"(?P<text>(?:[^\\\[<]|\\.)*)(?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])\n",
    re.DOTALL,
)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends in it."""
    if role in MARKS:
        opening, closing = MARKS[role]
    else:
        opening, closing = "[ROLE:" + _ROLE_SPECIAL.sub(lambda m: "\\" + m[0], role) + "] ", OTHER_CLOSE
    inner = escape(text)
    return opening + inner + closing, len(opening), len(opening) + len(inner)


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    for m in _TURN.finditer(formatted):
        role = "system" if m["sys"] else "user" if m["user"] else "assistant" if m["asst"] else unescape(m["role"])
        # the space before a closing mark belongs to the mark
        yield role, unescape(m["text"][:-1])


def count_tokens(formatted: str) -> int:
    return len(_TOKEN.findall(formatted))


class _Window:
    """The windows of one conversation, made turn by turn."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple | None = None
        self.number = 0
        self.parts: list[tuple] = []  # (formatted, start, end, tokens, target)
        self.repeated = 0
        self.sums = [0]  # prefix sums of the tokens of this window's turns
        self.first = True

    def close(self) -> dict:
        text, starts, ends, at = [], [], [], 0
        for i, (formatted, start, end, _, target) in enumerate(self.parts):
            text.append(formatted)
            if target and i >= self.repeated:
                starts.append(at + start)
                ends.append(at + end)
            at += len(formatted)
        row = {
            "conv_id": self.conv_id, "window": self.number, "formatted": "".join(text), "n_repeated": self.repeated,
            "n_turns": len(self.parts) - self.repeated, "tokens": self.sums[-1], "loss_starts": starts, "loss_ends": ends,
        }
        self.number += 1
        return row

    def add(self, role: str, text: str) -> dict | None:
        """Take a turn; gives the window that it closes, if it does."""
        formatted, start, end = format_turn(role, text)
        part = (formatted, start, end, count_tokens(formatted), role == "assistant")
        done = None
        if len(self.parts) > self.repeated and self.sums[-1] + part[3] > self.budget:
            done = self.close()
            fresh = self.parts[self.repeated :]
            head = [self.system] if self.system else []
            room = min(self.history, self.budget - part[3] - sum(p[3] for p in head))
            # the last turns whose prefix sums lie within the room for history
            take, used = 0, 0
            while take < len(fresh) and used + fresh[-1 - take][3] <= room and fresh[-1 - take] is not self.system:
                used += fresh[-1 - take][3]
                take += 1
            self.parts = head + fresh[len(fresh) - take :]
            self.repeated = len(self.parts)
            self.sums = [0]
            for p in self.parts:
                self.sums.append(self.sums[-1] + p[3])
        if self.first and role == "system":
            self.system = part
        self.first = False
        self.parts.append(part)
        self.sums.append(self.sums[-1] + part[3])
        return done


WINDOW_SCHEMA = (
    "conv_id long, window int, formatted string, n_repeated int, n_turns int, tokens int, "
    "loss_starts array<int>, loss_ends array<int>"
)
_WINDOW_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()), ("n_repeated", pa.int32()),
        ("n_turns", pa.int32()), ("tokens", pa.int32()), ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32())),
    ]
)


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY) -> DataFrame:
    """Formatted windows, in order of conversation and window within each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Window | None = None
        rows: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(rows, schema=_WINDOW_ARROW)
            rows.clear()
            return out

        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            for conv_id, role, text in zip(ids, roles, texts):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        rows.append(now.close())
                    now = _Window(conv_id, budget, history_tokens)
                done = now.add(role or "", text or "")
                size += len(text or "")
                if done:
                    rows.append(done)
                if size > 1 << 20:
                    yield flush()
                    size = 0
        if now is not None:
            rows.append(now.close())
        yield flush()

    ordered = (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, WINDOW_SCHEMA)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Read the windows of each conversation back, in order, and digest turns and targets.

    Expects the order that ``chat_windows`` gives. Repeated turns are left out, every other turn
    counts once.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def result(s: dict) -> tuple:
            return (s["id"], s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["formatted"], s["windows"])

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or state["id"] != row["conv_id"]:
                    if state is not None:
                        out.append(result(state))
                    state = {"id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "windows": 0}
                formatted = row["formatted"]
                for i, (role, text) in enumerate(parse_turns(formatted)):
                    if i >= row["n_repeated"]:
                        state["n"] += 1
                        state["turns"].update(f"{role}\n{text}\n".encode())
                for start, end in zip(row["loss_starts"], row["loss_ends"]):
                    target = unescape(formatted[start:end])
                    state["chars"] += len(target)
                    state["loss"].update(target.encode())
                state["formatted"] += len(formatted)
                state["windows"] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 7, types)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(result(state), types)], names=names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return windows.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long",
    )


#: Two rows whose texts consist of the template's own marks.
MARKED_ROWS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED_ROWS, "conv_id long, turn long, role string, text string")
    return conversation_digests(chat_windows(rows.unionByName(marked)))
