"""Structure repair of conversations over a suffix-shared automaton.

A conversation is reduced to a signature, one letter for each row: its role and whether it can stay.
Signatures are minimised from the end: two that end alike share the automaton nodes of that ending. Each
node holds, for each state of the grammar ``(s?(ua)+)?``, the least cost to go and the best audit suffix, and
these are worked out once for a node, whichever conversations pass through it. The nodes are the distinct suffixes: signatures
are sorted from their ends, range by range, so that a task walks its part of the automaton depth first and
holds one path of it at a time.

A conversation of any length is cut into blocks of at most ``BLOCK_ROWS`` rows, which many tasks work on.
What a block costs between two grammar states is a 4 x 4 table. Adding these up from the end gives each block the
costs that follow it (a node of the automaton ends in those costs, not in the end of text), and
following the chosen edits from the start gives each block the state it begins in. Only these tables
and the digest of the repaired text follow the order of a conversation.

Defined results:

* a null conv_id is a conversation like any other; null turns come first; rows of the same turn come in
  order of role, then text; equal rows of a turn stand side by side and all but the first count as duplicates;
* null role and text count as one space, so such a text is blank and such a role must be changed;
* no rows after damage: zeros, no edits, the digest of the empty text; an empty table gives no rows;
* texts of any length are kept whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.common import stored, table

#: Most rows and (but for one longer row) bytes of text of a block.
BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 18

#: Bytes of text that a task sends on at once.
_BATCH_BYTES = 1 << 20

# What counts as a character, the ends of a whole sentence, the costs of edits.
BLANK = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# Grammar states: nothing yet, after s, after u, after a. The text may end in the first and the last.
STATES = range(4)
FOLLOWS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The turn that an edit can put next in each state, and where it leads.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (2, 2, 3, 2)
_NEVER = 1 << 40

#: What follows a conversation's last block.
END = "."

Node = tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows left after the deterministic damage, with ``n`` copies each."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(plain("conv_id"), F.lit(":"), plain("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(plain("role")).alias("role"),
        text.alias("text"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("n"),
        fault.alias("fault"),
    ).where("fault <> 0").drop("fault")


def signed_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies ``n`` and ``sign``: what the first copy is; further ones are duplicates.

    ``sign`` is b for blank, d for a duplicate, else the role's initial (x for other ones), as a capital
    where the text is truncated. A row is a duplicate if its conversation has its role and text in an
    earlier turn. That turn is a minimum of groups, and rows find it by a key that holds their own turn, so
    one row that fills a conversation is not one task.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").cast("long").alias("n"))
    counted = counted.withColumn("_hash", F.sha2("text", 256))
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = (
        counted.groupBy("conv_id", "role", "_hash")
        .agg(F.min(order).alias("_first"))
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("_hash").alias("_same"), F.col("_first.turn").alias("_turn"), F.lit(True).alias("_new"))
    )
    met = (
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("role") == F.col("_role"))
        & (F.col("_hash") == F.col("_same"))
        & F.col("turn").eqNullSafe(F.col("_turn"))
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    whole = F.col("text").rlike(rf"[.!?][{BLANK}]*\z")
    sign = (
        F.when(~F.col("text").rlike(f"[^{BLANK}]"), "b")
        .when(F.col("_new").isNull(), "d")
        .when(whole, role)
        .otherwise(F.translate(role, "suax", "SUAX"))
    )
    joined = counted.join(firsts, met, "left")
    return joined.select("conv_id", "turn", "role", "text", "n", sign.alias("sign"), initial.alias("initial"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_LEGAL = ("su", "ua", "au")


class _Block:
    def __init__(self, conv_id, place: tuple[int, int]):
        self.conv_id, self.place = conv_id, place
        self.signature: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first: str | None = None
        self.last: str | None = None
        self.rows = self.size = 0

    def add(self, initial: str, sign: str, copies: int, role: str, text: str) -> None:
        """``copies`` equal rows, the first one with ``sign``."""
        if self.first is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in _LEGAL
        self.last = initial
        self.counts["illegal"] += copies - 1  # a role never follows itself
        if sign == "b":
            self.counts["blank"] += copies
            self.signature.append("d" * copies)
        elif sign == "d":
            self.counts["duplicate"] += copies
            self.signature.append("d" * copies)
        else:
            self.counts["duplicate"] += copies - 1
            self.counts["truncated"] += sign.isupper()
            self.signature.append(sign + "d" * (copies - 1))
            self.roles.append(role)
            self.texts.append(text)
        self.rows += copies
        self.size += len(text)


def blocks(signed: DataFrame, rows_in_block: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of consecutive rows: place (``part``, ``seq``), signature, counts, and the rows that may stay."""
    kind = signed.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "seq", "signature", "first", "last", *_COUNTS, "roles", "texts"]
    schema = f"conv_id {kind}, part int, seq long, signature string, first string, last string, {', '.join(f'{c} long' for c in _COUNTS)}, roles array<string>, texts array<string>"
    types = [None, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(_COUNTS), pa.list_(pa.string()), pa.list_(pa.string())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[_Block] = []
        now: _Block | None = None
        held, seq, id_type, part = 0, 0, None, 0

        def flush() -> pa.RecordBatch:
            cells = [(b.conv_id, *b.place, "".join(b.signature), b.first, b.last, *b.counts.values(), b.roles, b.texts) for b in done]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*cells), types)], names=names)

        for batch in batches:
            id_type = batch.column(0).type
            parts, *columns = (batch.column(i).to_pylist() for i in (6, 0, 1, 2, 3, 4, 5))
            part = parts[0] if parts else part
            for conv_id, role, text, copies, sign, initial in zip(*columns):
                while copies:
                    if now is None or now.conv_id != conv_id or now.rows >= rows_in_block or now.size >= BLOCK_BYTES:
                        if now is not None:
                            done.append(now)
                            held += now.size
                        now, seq = _Block(conv_id, (part, seq)), seq + 1
                        if held > _BATCH_BYTES or len(done) >= 4096:
                            yield flush()
                            held = 0
                    some = min(copies, rows_in_block - now.rows)
                    now.add(initial, sign, some, role, text)
                    copies -= some
                    sign = "b" if sign == "b" else "d"  # what is left of the copies
        if now is not None:
            done.append(now)
        if done:
            yield flush()

    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    # The start of a text sorts as the text does, and keeps whole texts out of the sampled borders.
    borders = [*order[:3], F.substring("text", 1, 32).asc_nulls_first()]
    ranged = signed.repartitionByRange(*borders).sortWithinPartitions(*order)
    return ranged.select("conv_id", "role", "text", "n", "sign", "initial", F.spark_partition_id().alias("part")).mapInArrow(cut, schema)


# --- the automaton ----------------------------------------------------------------------------


def _choices(symbol: str, state: int) -> list[tuple[int, str, int]]:
    """Edits of one row in a state: (cost, initial, state after)."""
    found = [(DELETE, "D", state)]
    if symbol != "d":
        truncated = TRUNCATED if symbol.isupper() else 0
        to = FOLLOWS.get((state, symbol.lower()))
        if to is not None:
            found.append((KEEP + truncated, "K", to))
        found.append((REROLE + truncated, "R", NEXT_STATE[state]))
    return found


CHOICES = {(symbol, state): _choices(symbol, state) for symbol in "suaxSUAXd" for state in STATES}


def _with_inserts(cost: list[int], audit: list[str], end: list[int]) -> Node:
    """Let inserted turns come first where that is cheaper, or as cheap and the audit smaller.

    Inserting leads on to the states after u and a only; two in a row never pay between those two.
    """
    plain = list(zip(cost, audit, end))
    best = list(plain)

    def better(state: int, source: tuple[int, str, int]) -> None:
        best[state] = min(best[state], (source[0] + INSERT, "I" + source[1], source[2]), key=lambda x: x[:2])

    better(2, plain[3])
    better(3, plain[2])
    for state in (0, 1):
        better(state, best[2])
    return tuple(b[0] for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best)


def end_node(after: str) -> Node:
    """The automaton's last node: the end of a conversation, or the costs that follow a block."""
    if after == END:
        return _with_inserts([0, _NEVER, _NEVER, 0], [""] * 4, list(STATES))
    return tuple(map(int, after.split(","))), ("",) * 4, tuple(STATES)


def node_before(symbol: str, node: Node) -> Node:
    """The node that reads ``symbol`` and goes on to ``node``: (costs, audits, final states) by state.

    The edits of one row have different initials, so the first one settles which audit is the smaller.
    """
    cost, audit, end = [], [], []
    for state in STATES:
        c, letter, to = min((c + node[0][to], letter, to) for c, letter, to in CHOICES[symbol, state])
        cost.append(c)
        audit.append(letter + node[1][to])
        end.append(node[2][to])
    return _with_inserts(cost, audit, end)


Table = tuple[tuple[int, ...], ...]
SAME: Table = tuple(tuple(0 if s == t else _NEVER for t in STATES) for s in STATES)


def table_before(symbol: str, after: Table) -> Table:
    """Least costs from each state before ``symbol`` to each state at the block's end."""
    plain = [tuple(min(c + after[to][t] for c, _, to in CHOICES[symbol, state]) for t in STATES) for state in STATES]

    def with_insert(state: int, source: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(min(a, b + INSERT) for a, b in zip(plain[state], source))

    second, third = with_insert(2, plain[3]), with_insert(3, plain[2])
    return with_insert(0, second), with_insert(1, second), second, third


def _walk(keys: DataFrame, begin, before, columns: str, result) -> DataFrame:
    """``result`` of the first node of each distinct (``after``, ``signature``).

    Keys are sorted by what follows and by their reversed signature; a task keeps the nodes of the current
    key from the end on, and goes back to the last one that the next key shares.
    """
    names = ["after", "signature", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, path, nodes = None, "", []
        for batch in batches:
            out = []
            for after, signature in zip(*(batch.column(i).to_pylist() for i in range(2))):
                from_end = signature[::-1]
                if after != now:
                    now, path, nodes = after, "", [begin(after)]
                shared, most = 0, min(len(path), len(from_end))
                while shared < most and path[shared] == from_end[shared]:
                    shared += 1
                del nodes[shared + 1 :]
                for symbol in from_end[shared:]:
                    nodes.append(before(symbol, nodes[-1]))
                path = from_end
                out.append((after, signature, *result(nodes[-1])))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=arrow)

    kinds = {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    arrow = pa.schema([("after", pa.string()), ("signature", pa.string()), *((c.split()[0], kinds[c.split()[1]]) for c in columns.split(", "))])
    sorted_keys = keys.select("after", "signature").distinct().withColumn("_from_end", F.reverse("signature"))
    sorted_keys = sorted_keys.repartitionByRange("after", "_from_end").sortWithinPartitions("after", "_from_end").drop("_from_end")
    return sorted_keys.mapInArrow(run, f"after string, signature string, {columns}")


def block_tables(keys: DataFrame) -> DataFrame:
    """(signature, costs): the 16 costs of each distinct block signature."""
    found = _walk(keys.withColumn("after", F.lit("")), lambda _: SAME, table_before, "costs array<long>", lambda t: ([c for row in t for c in row],))
    return found.drop("after")


def block_edits(keys: DataFrame) -> DataFrame:
    """(after, signature, costs, audits, ends): by first state, the best edits of each distinct block."""

    def result(node: Node) -> tuple:
        return [min(c, _NEVER) for c in node[0]], list(node[1]), list(node[2])

    return _walk(keys, end_node, node_before, "costs array<long>, audits array<string>, ends array<long>", result)


# --- blocks in the order of their conversation --------------------------------------------------


def _in_order(rows: DataFrame, *, falling: bool = False) -> DataFrame:
    place = [F.desc(c) if falling else F.asc(c) for c in ("part", "seq")]
    return rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *place)


def _stream(rows: DataFrame, schema: str, step) -> DataFrame:
    """Rows of ``step(state, row) -> (state, out)``; ``state`` is None at the start of a conversation.

    ``rows`` has conv_id, part, seq and more, in order; small values only, so rows are taken one by one.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != last:
                    last, state = row["conv_id"], None
                state, found = step(state, row)
                out.append(dict(zip(names, (row["part"], row["seq"], *found))))
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def costs_after(rows: DataFrame) -> DataFrame:
    """(part, seq, after): the costs that follow each block, less the least of them."""

    def step(after: tuple[int, ...] | None, row: dict) -> tuple:
        told = END if after is None else ",".join(map(str, after))
        follows = end_node(told)[0]
        costs = [min(row["costs"][4 * s + t] + follows[t] for t in STATES) for s in STATES]
        return tuple(c - min(costs) for c in costs), (told,)

    return _stream(_in_order(rows, falling=True), "part int, seq long, after string", step)


def states_before(rows: DataFrame) -> DataFrame:
    """(part, seq, state, crossed): each block's first state, and whether its first pair is illegal."""

    def step(before: tuple[int, str] | None, row: dict) -> tuple:
        state, last = before or (0, None)
        crossed = int(last is not None and last + row["first"] not in _LEGAL)
        return (row["ends"][state], row["last"]), (state, crossed)

    return _stream(_in_order(rows), "part int, seq long, state long, crossed long", step)


def edited_blocks(conversations: DataFrame, rows_in_block: int = BLOCK_ROWS) -> DataFrame:
    """All blocks with their edits (``audit``), their ``cost`` and the turns that they leave (``roles``, ``texts``).

    ``alone`` marks blocks that are a whole conversation.
    """
    cut = stored(blocks(signed_rows(damage(conversations)), rows_in_block), "blocks")
    small = cut.select("conv_id", "part", "seq", "signature", "first", "last")
    many = small.groupBy("conv_id").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    # Conversations of several blocks are few: each has a block's worth of rows or meets a range border.
    again = many.select(F.col("conv_id").alias("_conv"))
    parted = stored(small.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi"), "parted")
    after = stored(costs_after(parted.join(block_tables(parted), "signature").select("conv_id", "part", "seq", "costs")), "after")
    placed = small.join(after, ["part", "seq"], "left").withColumn("alone", F.col("after").isNull()).withColumn("after", F.coalesce("after", F.lit(END)))
    edits = stored(block_edits(placed), "edits")
    states = states_before(
        placed.where("NOT alone").join(edits, ["after", "signature"]).select("conv_id", "part", "seq", "first", "last", "ends")
    )
    known = stored(after.join(states, ["part", "seq"]), "states")
    joined = cut.join(known, ["part", "seq"], "left").select(
        "*", F.coalesce("state", F.lit(0).cast("long")).alias("_state"), F.coalesce("after", F.lit(END)).alias("_after"), F.col("after").isNull().alias("alone")
    )
    found = edits.select(F.col("after").alias("_after"), "signature", "costs", "audits", "ends")
    chosen = joined.join(found, ["_after", "signature"])
    at = F.col("_state").cast("int")
    end_cost = F.when(F.col("_after") == END, 0).otherwise(F.get(F.split("_after", ","), F.get("ends", at).cast("int")).cast("long"))
    narrow = chosen.select(
        "conv_id", "part", "seq", "alone", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.coalesce("crossed", F.lit(0))).alias("illegal"),
        (F.get("costs", at) - end_cost).alias("cost"),
        F.get("audits", at).alias("audit"),
        at.alias("state"), "signature", "roles", "texts",
    )
    return narrow.mapInArrow(_apply, narrow.drop("state", "signature").schema)


def repaired_lines(state: int, signature: str, audit: str, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The turns that ``audit`` leaves of a block that begins in ``state``."""
    out_roles: list[str] = []
    out_texts: list[str] = []
    row = given = 0
    for letter in audit:
        if letter == "I":
            out_roles.append(NEXT_ROLE[state])
            out_texts.append("")
            state = NEXT_STATE[state]
            continue
        symbol = signature[row]
        row += 1
        if letter != "D":
            out_roles.append(roles[given] if letter == "K" else NEXT_ROLE[state])
            out_texts.append(texts[given])
            state = FOLLOWS[state, symbol.lower()] if letter == "K" else NEXT_STATE[state]
        given += symbol != "d"
    return out_roles, out_texts


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("state", "signature", "audit", "roles", "texts")]
        lines = [repaired_lines(*row) for row in zip(*columns)]
        names = [n for n in batch.schema.names if n not in ("state", "signature", "roles", "texts")]
        turns = [pa.array([x[i] for x in lines], pa.list_(pa.string())) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *turns], names=[*names, "roles", "texts"])


def repaired_turns(edited: DataFrame) -> DataFrame:
    """(conv_id, part, seq, place, role, text): the turns of every repaired conversation, to be read in that order."""
    turns = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")
    return edited.select("conv_id", "part", "seq", turns).select("conv_id", "part", "seq", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


_SUMS = (*_COUNTS, "cost")


def conversation_reports(edited: DataFrame) -> DataFrame:
    """One row a conversation: sums, audit, and the digest of the repaired text.

    A conversation that is one block is done where it lies. The others' blocks are brought in order, and the
    digest reads them one after the other; nothing but the audit is held.
    """
    schema = f"conv_id {edited.schema['conv_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in _SUMS)}, audit string, repaired_sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums, audit, digest, begun = object(), None, None, None, False
        kinds: list = []

        def told() -> tuple:
            return (last, *sums, "".join(audit), digest.hexdigest())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            kinds = [batch.column("conv_id").type, *[pa.int64()] * len(_SUMS), pa.string(), pa.string()]
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != last or sums is None:
                    if sums is not None:
                        out.append(told())
                    last, sums, audit, digest, begun = row["conv_id"], [0] * len(_SUMS), [], hashlib.sha256(), False
                sums = [s + row[c] for s, c in zip(sums, _SUMS)]
                audit.append(row["audit"])
                for role, text in zip(row["roles"], row["texts"]):
                    digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
                    begun = True
            if out:
                yield batch_of(out)
        if sums is not None:
            yield batch_of([told()])

    wanted = ["conv_id", "part", "seq", *_SUMS, "audit", "roles", "texts"]
    alone = edited.where("alone").select(*wanted).mapInArrow(run, schema)
    return alone.unionByName(_in_order(edited.where("NOT alone").select(*wanted)).mapInArrow(run, schema))


def turn_gaps(rows: DataFrame) -> DataFrame:
    """Turns missing between the first and the last of each conversation; null turns are not looked at."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def repair(conversations: DataFrame, rows_in_block: int = BLOCK_ROWS) -> DataFrame:
    """The report of every conversation of the table, damaged and repaired."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    edited = stored(edited_blocks(rows, rows_in_block), "edited")

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnRenamed("conv_id", name)

    report, gaps = keyed(conversation_reports(edited), "_a"), keyed(turn_gaps(damage(rows)), "_b")
    joined = (
        rows.select("conv_id").distinct()
        .join(report, F.col("conv_id").eqNullSafe(F.col("_a")), "left")
        .join(gaps, F.col("conv_id").eqNullSafe(F.col("_b")), "left")
    )
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id",
        *(F.coalesce(c, zero).alias(c) for c in ("gaps", *_SUMS)),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
