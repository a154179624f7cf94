"""Personal data in texts, with Spark's own functions only.

Regular expressions propose spans, validators confirm them (number ranges, Luhn, mod-97), and words
near a span raise or lower its score. The whole operator is one projection: no shuffle, no Python.

A span's place is found without searching for it again: ``split`` by the pattern gives the stretches
between the hits of ``regexp_extract_all``, and the lengths of both add up to the places. The sums are
taken within blocks, so a text of a million hits costs no square of them.

Base kinds (email, ip, card, phone) are always reported. The added kinds are IBANs, confirmed by their
country's length and mod-97, and US social security numbers, which have no checksum and therefore need
a word near them that says so; both need a score of ``LEAST`` or more.

Defined results: a null text counts as empty; an empty text has no spans, and the digest of the empty
string; a null doc_id is returned as it is; repeated rows are answered one by one; other columns of the
table are not read. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,score:int>"

#: Hits whose lengths are added up one by one; whole blocks of them are added as one.
BLOCK = 256

#: Characters on each side of a span in which context words count. They do not reach past the next
#: proposal of the same kind.
CONTEXT = 40

#: Score in hundredths that spans of the added kinds need.
LEAST = 50
RAISE, LOWER = 20, -30

UPPER, PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "0123456789" + UPPER

# Lengths of international bank account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18,
    "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def mod97(account: Column) -> Column:
    """Remainder of an account number, its first four characters moved to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, symbol: Column) -> Column:
        value = F.instr(F.lit(SYMBOLS), symbol) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return let(moved, lambda m: F.aggregate(F.sequence(F.lit(1), F.length(m)), F.lit(0), lambda rest, i: step(rest, m.substr(i, F.lit(1)))))


@dataclass(frozen=True)
class Hit:
    """One proposal: its text and the stretches before and after it."""

    text: Column
    before: Column
    after: Column

    def near(self, words: tuple[str, ...]) -> Column:
        """Whether one of ``words`` stands within the context."""
        around = F.concat_ws(" ", F.right(self.before, F.lit(CONTEXT)), F.left(self.after, F.lit(CONTEXT)))
        return F.translate(around, UPPER, PLAIN).rlike(f"(^|[^a-z])({'|'.join(words)})([^a-z]|$)")


def _email(hit: Hit) -> Column:
    return F.length(hit.text)


def _ip(hit: Hit) -> Column:
    part = "0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return F.when(hit.text.rlike(rf"^{part}(\.{part}){{3}}$"), F.length(hit.text))


def _card(hit: Hit) -> Column:
    return let(digits_of(hit.text), lambda d: F.when(F.length(d).between(16, 19), F.when(luhn(d), F.length(hit.text))))


def _phone(hit: Hit) -> Column:
    return F.when(F.length(digits_of(hit.text)).between(8, 15), F.length(hit.text))


def _iban(hit: Hit) -> Column:
    """The hit goes on for as long as letters and digits do; the country says where the number ends."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))
    apart = ~F.right(hit.before, F.lit(1)).rlike("[A-Za-z0-9]")

    def checked(length: Column) -> Column:
        upto = F.concat(F.lit("^( ?[A-Z0-9]){"), length.cast("string"), F.lit("}"))
        cut = F.call_function("regexp_extract", hit.text, upto, F.lit(0))

        def confirmed(found: Column) -> Column:
            rest = F.concat(hit.text.substr(F.length(found) + 1, F.lit(1)), F.left(hit.after, F.lit(1)))
            ends = (F.length(found) > 0) & ~rest.rlike("^[A-Za-z0-9]")
            return F.when(ends, F.when(mod97(F.regexp_replace(found, " ", "")) == 1, F.length(found)))

        return F.when(length.isNotNull() & apart, let(cut, confirmed))

    return let(F.try_element_at(lengths, F.substring(hit.text, 1, 2)), checked)


def _ssn(hit: Hit) -> Column:
    given = ~hit.text.rlike("^(000|666|9)|-00-|-0000$")
    apart = ~F.right(hit.before, F.lit(1)).rlike("[A-Za-z0-9-]") & ~F.left(hit.after, F.lit(1)).rlike("[A-Za-z0-9-]")
    return F.when(given & apart, F.length(hit.text))


@dataclass(frozen=True)
class Kind:
    """What proposes a kind's spans, what confirms one (its length, or null), and how it is scored.

    ``needs`` is a character without which there can be no hit. Patterns are written so that a failed
    attempt is not repeated from the next character of the same run, and repeat possessively, which
    changes no match here: what follows a repeat never starts with what it repeats.
    """

    name: str
    pattern: str
    confirm: Callable[[Hit], Column]
    score: int
    raised_by: tuple[str, ...]
    lowered_by: tuple[str, ...] = ("example", "sample", "dummy")
    needs: str | None = None
    least: int = 0


# The base kinds and what they match.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _email, 80, ("email", "mail", "contact", "write"), needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 50, ("ip", "address", "host", "server", "login"), ("version", "release", "section", "chapter"), needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 70, ("card", "visa", "mastercard", "credit", "payment"), ("order", "invoice", "isbn", "tracking")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 60, ("phone", "tel", "call", "mobile", "fax"), ("order", "invoice", "isbn", "tracking"), needs="+"),
)

ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", _iban, 80, ("iban", "account", "bank", "transfer"), least=LEAST),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, 40, ("ssn", "social", "security"), ("order", "invoice", "part"), needs="-", least=LEAST),
)


def spans(text: Column, kind: Kind) -> Column:
    """The confirmed spans of a kind, in order: places in code points, end exclusive, and score."""
    none = F.array().cast(f"array<{SPAN}>")

    def located(hits: Column, gaps: Column) -> Column:
        steps = F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))

        def total(values: Column, count: Column) -> Column:
            return F.aggregate(F.slice(values, F.lit(1), count), F.lit(0), lambda a, b: a + b)

        def with_sums(step: Column) -> Column:
            # ``slice`` copies what it cuts from, so the long array is cut once a block, not once a hit.
            numbers = F.sequence(F.lit(0), F.floor((F.size(step) - 1) / BLOCK).cast("int"))
            blocks = F.transform(numbers, lambda b: F.slice(step, b * BLOCK + 1, F.lit(BLOCK)))
            return let(blocks, lambda cut: let(F.transform(cut, lambda c: total(c, F.lit(BLOCK))), lambda sums: offsets(cut, sums)))

        def offsets(cut: Column, sums: Column) -> Column:
            return let(F.transform(sums, lambda _, b: total(sums, b)), lambda starts: placed(cut, starts))

        def placed(cut: Column, starts: Column) -> Column:
            def one(text_: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                start = starts[block] + total(cut[block], i % BLOCK) + F.length(gaps[i])
                hit = Hit(text_, gaps[i], gaps[i + 1])
                score = F.lit(kind.score) + F.when(hit.near(kind.raised_by), RAISE).otherwise(0) + F.when(hit.near(kind.lowered_by), LOWER).otherwise(0)
                return let(
                    kind.confirm(hit),
                    lambda length: F.when(length.isNotNull(), let(start, lambda s: F.struct(s.alias("start"), (s + length).alias("end"), score.alias("score")))),
                )

            return F.filter(F.transform(hits, one), lambda s: s.isNotNull() & (s["score"] >= kind.least))

        return let(steps, with_sums)

    proposed = let(
        F.regexp_extract_all(text, F.lit(kind.pattern), 0),
        lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), lambda gaps: located(hits, gaps))),
    )
    return proposed if kind.needs is None else F.when(F.contains(text, F.lit(kind.needs)), proposed).otherwise(none)


def find_personal_data(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and, for each kind, an array of its spans named after it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.struct(*(spans(whole, kind).alias(kind.name) for kind in (*BASE, *ADDED)))
    named = docs.select(F.struct(*keep).alias("_kept"), found.alias("_found"))
    # Both are used several times, so the planner does not work them out again for each use.
    return named.select("_kept.*", "_found.*")


def listed(kinds: tuple[Kind, ...], part: Callable[[str, Column], Column]) -> Column:
    """``part`` of every span, by kind as listed, then by place, joined by commas."""

    def each(name: str) -> Column:
        return F.transform(F.col(name), lambda s: part(name, s))

    return F.array_join(F.flatten(F.array(*(each(k.name) for k in kinds))), ",")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans with their scores, and the best score."""

    def place(name: str, s: Column) -> Column:
        return F.concat_ws(":", F.lit(name), s["start"].cast("string"), s["end"].cast("string"))

    every = (*BASE, *ADDED)
    best = F.array_max(F.flatten(F.array(*(F.transform(F.col(k.name), lambda s: s["score"]) for k in every))))
    return found.select(
        "doc_id",
        *(F.size(k.name).cast("long").alias(f"n_{k.name}") for k in every),
        F.sha2(listed(BASE, place), 256).alias("base_sha256"),
        listed(every, place).alias("spans"),
        listed(every, lambda _, s: s["score"].cast("string")).alias("scores"),
        (F.coalesce(best, F.lit(0)) / 100).alias("score"),
    )


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def _sql_hits(kind: Kind, place: int, pattern: str, length: str, columns: str = "") -> str:
    """One kind's confirmed spans in SQL; ``length`` may be null where a hit is refused."""
    context = f"translate(concat_ws(' ', right(gap, {CONTEXT}), left(after, {CONTEXT})), '{UPPER}', '{PLAIN}')"

    def near(words: tuple[str, ...], change: int) -> str:
        return f"CASE WHEN regexp_matches({context}, '(^|[^a-z])({'|'.join(words)})([^a-z]|$)') THEN {change} ELSE 0 END"

    return f"""
SELECT rid, {place} AS k, '{kind.name}' AS kind, start, start + {length} AS stop,
       {kind.score} + {near(kind.raised_by, RAISE)} + {near(kind.lowered_by, LOWER)} AS score, {kind.least} AS least
FROM (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY i) - length(hit) AS start,
         regexp_replace(hit, '[^0-9]', '', 'g') AS digits, replace(hit, ' ', '') AS symbols
  FROM (
    SELECT rid, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(gaps[2:len(hits) + 1]) AS after,
           unnest(range(len(hits))) AS i
    FROM (SELECT rid, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS gaps FROM docs)
  )
){columns}"""


def _pii_sql() -> str:
    # The same kinds as in BASE, in the plain form of their definition.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    luhn_sum = """list_sum(list_transform(range(1, length(digits) + 1),
        lambda p: CASE WHEN p % 2 = 1 THEN CAST(digits[length(digits) - p + 1] AS INTEGER)
                  ELSE (2 * CAST(digits[length(digits) - p + 1] AS INTEGER)) // 10 + (2 * CAST(digits[length(digits) - p + 1] AS INTEGER)) % 10 END))"""
    parts = "list_transform(string_split(hit, '.'), lambda p: CASE WHEN ltrim(p, '0') = '' THEN 0 WHEN length(ltrim(p, '0')) > 3 THEN 999 ELSE CAST(ltrim(p, '0') AS INTEGER) END)"
    want = "CASE left(hit, 2) " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in IBAN_LENGTHS.items()) + " END"
    taken = f"list_transform(range(1, length(hit) + 1), lambda p: CASE WHEN length(replace(left(hit, p), ' ', '')) = {want} AND substr(hit, p, 1) <> ' ' THEN p END)"
    cut = f"list_min(list_filter({taken}, lambda p: p IS NOT NULL))"
    moved = f"(substr(left(symbols, {want}), 5) || left(symbols, 4))"
    number = f"""list_reduce(list_prepend(0, list_transform(range(1, length{moved} + 1), lambda p: strpos('{SYMBOLS}', substr({moved}, p, 1)) - 1)),
        lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97)"""
    lengths = {
        "email": "length(hit)",
        "ip": f"CASE WHEN list_max({parts}) <= 255 THEN length(hit) END",
        "card": f"CASE WHEN length(digits) BETWEEN 16 AND 19 THEN CASE WHEN {luhn_sum} % 10 = 0 THEN length(hit) END END",
        "phone": "CASE WHEN length(digits) BETWEEN 8 AND 15 THEN length(hit) END",
        "iban": f"""CASE WHEN length(symbols) >= {want} AND NOT regexp_matches(gap, '[A-Za-z0-9]$')
            AND NOT regexp_matches(substr(hit, {cut} + 1, 1) || left(after, 1), '^[A-Za-z0-9]') THEN CASE WHEN {number} = 1 THEN {cut} END END""",
        "ssn": """CASE WHEN NOT regexp_matches(hit, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(gap, '[A-Za-z0-9-]$')
            AND NOT regexp_matches(after, '^[A-Za-z0-9-]') THEN length(hit) END""",
    }
    every = (*BASE, *ADDED)
    hits = "\nUNION ALL\n".join(_sql_hits(kind, i, patterns[kind.name], lengths[kind.name]) for i, kind in enumerate(every))
    counts = ",\n       ".join(f"count(*) FILTER (WHERE kind = '{k.name}') AS n_{k.name}" for k in every)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT * FROM ({hits}) WHERE stop IS NOT NULL AND score >= least)
SELECT any_value(doc_id) AS doc_id,
       {counts},
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (WHERE k < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start), '') AS spans,
       coalesce(string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, start), '') AS scores,
       coalesce(max(score), 0) / 100.0 AS score
FROM docs LEFT JOIN found USING (rid)
GROUP BY rid"""


PII_SQL = _pii_sql()
