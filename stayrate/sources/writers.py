"""Table sinks. Every sink overwrites its target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stayrate.schemas import ROW_GROUP_ROWS

SCORE_FORMATS = ("parquet", "csv")


def write_parquet(df: DataFrame, path: str, *, by: Sequence[str] = (), **options: object) -> None:
    """Snappy-compressed Parquet, split into folders ``by`` columns, with as many files as ``df`` has partitions."""
    df.write.mode("overwrite").options(compression="snappy", **options).partitionBy(*by).parquet(path)


def write_row_bounded(df: DataFrame, path: str, *, rows: int = ROW_GROUP_ROWS) -> None:
    """Parquet whose row groups hold at most ``rows`` rows."""
    write_parquet(df, path, **{"parquet.block.row.count.limit": rows})


def sized(df: DataFrame, *by: str) -> DataFrame:
    """``df`` in partitions near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    Adaptive execution merges small partitions and splits large ones after the shuffle, by their bytes.
    With ``by``, rows of the same values come together first, however many partitions these then take.
    """
    return df.hint("rebalance", *by)


def write_file_count(df: DataFrame, path: str, *, files: int | None = None, by: Sequence[str] = ()) -> None:
    """Parquet in exactly ``files`` even files (in each folder); None sizes the files by bytes."""
    write_parquet(sized(df, *by) if files is None else df.repartition(files), path, by=by)


def check_score_format(output_format: str) -> str:
    name = output_format.lower()
    if name not in SCORE_FORMATS:
        raise ValueError(f"score format must be one of {', '.join(SCORE_FORMATS)}, got {output_format!r}")
    return name


def write_scores(scores: DataFrame, path: str, *, output_format: str = "parquet") -> None:
    """Scored rows as Parquet, or as CSV with a header."""
    if check_score_format(output_format) == "csv":
        scores.write.mode("overwrite").csv(path, header=True)
    else:
        write_parquet(scores, path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
