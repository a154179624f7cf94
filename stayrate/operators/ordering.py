"""Row numbers in a global order without a single-task step.

``place_rows`` sorts a table range by range and writes it with each row's place: the range it fell into and its
position there. Numbering is then arithmetic, since the driver knows how many rows each range has: one
number for each range, of which there are as many as partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.sources.storage import written

BLOCK = "_block"
PLACE = "_place"
_COPY = "_copy"
_COPIES = "_copies"
_PIECE = 1_000
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row in the partition below


def _by_range(df: DataFrame, order: Sequence[Column], blocks: int | None) -> DataFrame:
    """Range partitions in ``order``.

    Without a number Spark uses the session's shuffle partitions and adaptively merges small
    neighbours, so a small table gets few blocks; merging neighbours keeps the order.
    """
    return df.repartitionByRange(*order) if blocks is None else df.repartitionByRange(blocks, *order)


def place_rows(
    df: DataFrame, order: Sequence[Column], *, ties: Sequence[Column] = (), blocks: int | None = None, by: Sequence[str] = ()
) -> tuple[DataFrame, str]:
    """``df`` in ``order`` (then ``ties``) as a written table with ``_place``, and where it lies.

    Range borders come from a sample and may differ between runs, which moves rows between ranges but not
    in the order. The table makes one run's borders final. ``by`` also splits the folder.
    """
    placed = _by_range(df, order, blocks).sortWithinPartitions(*order, *ties).withColumn(PLACE, F.monotonically_increasing_id())
    return written(placed, "placed", by=by)


def block_of(place: Column) -> Column:
    return F.shiftright(place, _POSITION_BITS).cast("int")


def number_of(place: Column, starts: Mapping[int, int]) -> Column:
    """The row number of a place, from the number that each block starts with."""
    known = ", ".join(f"{starts.get(b, 0)}L" for b in range(max(starts, default=0) + 1))
    return F.get(F.expr(f"array({known})"), block_of(place)) + place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def block_starts(placed: DataFrame) -> dict[int, int]:
    """The number that each block starts with. At most one row a block reaches the driver."""
    starts, total = {}, 0
    for block, n in sorted(tuple(r) for r in placed.groupBy(block_of(F.col(PLACE)).alias(BLOCK)).count().collect()):
        starts[block], total = total, total + n
    return starts


def _copies(distinct: DataFrame) -> DataFrame:
    """Every copy as a row of its own, told apart by ``_copy``.

    Only rows with very many copies move: they are dealt out in pieces, so that not even their numbers are
    one long array or one task.
    """
    columns = [c for c in distinct.columns if c != _COPIES]
    few = distinct.filter(F.col(_COPIES) <= _PIECE).select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_COPIES) - 1)).alias(_COPY))
    firsts = F.sequence(F.lit(0).cast("long"), F.col(_COPIES) - 1, F.lit(_PIECE).cast("long"))
    many = distinct.filter(F.col(_COPIES) > _PIECE).select(*columns, _COPIES, F.explode(firsts).alias("_from"))
    upto = F.least(F.col("_from") + _PIECE, F.col(_COPIES)) - 1
    pieces = many.repartition(F.xxhash64(*columns), "_from")
    return few.unionByName(pieces.select(*columns, F.explode(F.sequence("_from", upto)).alias(_COPY)))


def number_rows(df: DataFrame, *keys: str, blocks: int | None = None, name: str = "row_index") -> DataFrame:
    """Consecutive row numbers from 0 in ``keys`` order; a written table, so the planner knows its size.

    Copies of one row are interchangeable. They are counted first and told apart by a number that takes
    part in the order, so a table in which a third of the rows are the same row sorts as evenly as any.
    """
    columns = df.columns
    told_apart = _copies(df.groupBy(*columns).agg(F.count("*").alias(_COPIES)))
    order = [*(F.col(k) for k in keys), F.xxhash64(*columns), F.col(_COPY)]
    placed = place_rows(told_apart, order, ties=[F.col(c) for c in columns], blocks=blocks)[0]
    return placed.select(*columns, number_of(F.col(PLACE), block_starts(placed)).alias(name))
