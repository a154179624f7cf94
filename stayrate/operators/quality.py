"""Schema, completeness, range, class-balance and partition checks.

The data checks are two aggregations: one over all columns, one over the class column. Of a stored table
the first one is read from the Parquet footers, which hold the rows, nulls, least and largest values of each row group.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.schemas import SUBSCRIBER_TYPES

# Checked columns.
RANGE_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]
# Checked columns.
NON_NEGATIVE_COLUMNS = ["tenure", "MonthlyCharges"]


def schema_issues(df: DataFrame, expected: dict[str, str] = SUBSCRIBER_TYPES) -> DataFrame:
    """Missing, mistyped and unexpected columns. Reads the schema only, no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    issues = []
    for name, kind in expected.items():
        if name not in actual:
            issues.append(("missing", name, kind, None))
        elif actual[name] != kind:
            issues.append(("mistyped", name, kind, actual[name]))
    issues += [("unexpected", name, None, actual[name]) for name in actual if name not in expected]
    return df.sparkSession.createDataFrame(issues, "issue string, column string, expected string, actual string")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _long(wide: DataFrame, entries: list[list[Column]]) -> DataFrame:
    """One row to one row per entry."""
    return wide.select(F.inline(F.array(*(F.struct(*entry) for entry in entries))))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass over the table."""
    wide = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return _long(wide, [[F.lit(c).alias("column"), F.col(c).alias("nulls")] for c in df.columns])


def range_profile(df: DataFrame, columns: list[str] = RANGE_COLUMNS) -> DataFrame:
    """Smallest and largest value per column."""
    wide = df.agg(
        *(F.min(c).cast("double").alias(f"{c}_min") for c in columns),
        *(F.max(c).cast("double").alias(f"{c}_max") for c in columns),
    )
    return _long(
        wide,
        [
            [F.lit(c).alias("column"), F.col(f"{c}_min").alias("min_value"), F.col(f"{c}_max").alias("max_value")]
            for c in columns
        ],
    )


def negative_counts(df: DataFrame, columns: list[str] = NON_NEGATIVE_COLUMNS) -> DataFrame:
    wide = df.agg(*(F.count_if(F.col(c) < 0).alias(c) for c in columns))
    return _long(wide, [[F.lit(c).alias("column"), F.col(c).alias("negatives")] for c in columns])


def class_distribution(df: DataFrame, label: str = "Churn") -> DataFrame:
    """Rows and percentage per class. The window runs over one row per class."""
    total = F.sum("count").over(Window.partitionBy())
    return df.groupBy(label).count().withColumn("pct", F.round(F.col("count") / total * 100, 2)).orderBy(label)


def stddev_profile(df: DataFrame, columns: list[str] = RANGE_COLUMNS) -> DataFrame:
    """Sample standard deviation per column."""
    wide = df.agg(*(F.stddev_samp(c).alias(c) for c in columns))
    return _long(wide, [[F.lit(c).alias("column"), F.col(c).alias("stddev")] for c in columns])


def partition_profile(df: DataFrame) -> DataFrame:
    """Non-empty partitions, their mean size and the measured skew (largest over mean)."""
    sizes = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
    return sizes.agg(
        F.count("*").alias("partitions"),
        F.sum("rows").alias("rows"),
        F.avg("rows").alias("mean_rows"),
        F.max("rows").alias("max_rows"),
        (F.max("rows") / F.avg("rows")).alias("skew"),
    )


def file_profile(df: DataFrame) -> DataFrame:
    """(file, bytes, splits, rows) of each file of a stored table, whatever way a session would read it.

    No column is read: rows come from the row groups, the rest from the scan's own file columns.
    """
    file = F.col("_metadata")
    return df.select(file["file_path"].alias("file"), file["file_size"].alias("bytes"), file["file_block_start"].alias("start")).groupBy("file").agg(
        F.max("bytes").alias("bytes"), F.count_distinct("start").alias("splits"), F.count("*").alias("rows")
    )


def file_skew(df: DataFrame) -> DataFrame:
    """Files, rows and bytes of a stored table and how far its largest file is above the mean. Files without rows do not show."""
    return file_profile(df).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("splits"), F.lit(0)).alias("splits"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.avg("bytes").alias("mean_bytes"),
        F.max("bytes").alias("max_bytes"),
        (F.max("bytes") / F.avg("bytes")).alias("bytes_skew"),
        (F.max("rows") / F.avg("rows")).alias("rows_skew"),
    )


def wide_profile(df: DataFrame) -> DataFrame:
    """One row: rows, and by column null_, min_, max_ and negative_."""
    return df.agg(
        F.count("*").alias("rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns),
        *(F.min(c).cast("double").alias(f"min_{c}") for c in RANGE_COLUMNS),
        *(F.max(c).cast("double").alias(f"max_{c}") for c in RANGE_COLUMNS),
        *(F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in NON_NEGATIVE_COLUMNS),
    )


# Spark's newer reader, the one that answers aggregates from footers.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose Parquet counts, minima and maxima come from footers."""
    session = spark.newSession()
    for name, value in _FOOTERS.items():
        session.conf.set(name, value)
    return session


def footer_aggregate(spark: SparkSession, path: str, ranges: Sequence[str] = ()) -> DataFrame:
    """One row: rows, filled_ of every column, min_ and max_ of ``ranges``, in a session of its own.

    The plan reads no column (``PushedAggregation``).
    """
    stored = footer_session(spark).read.parquet(path)
    return stored.agg(
        F.count("*").alias("rows"),
        *(F.count(c).alias(f"filled_{c}") for c in stored.columns),
        *(F.min(c).alias(f"min_{c}") for c in ranges),
        *(F.max(c).alias(f"max_{c}") for c in ranges),
    )


def footer_profile(spark: SparkSession, path: str, *, ranges: Sequence[str] = RANGE_COLUMNS, negatives: Sequence[str] = NON_NEGATIVE_COLUMNS) -> DataFrame:
    """The row of ``wide_profile`` for a stored table, from its footers.

    A column has no bounds in a footer where a row group is all NULL or holds NaN; then its values are read. Values are
    also read to count negative ones, but only of columns whose least value is one.
    """
    table = spark.read.parquet(path)
    try:
        found = footer_aggregate(spark, path, ranges).first().asDict()
    except (PySparkException, Py4JJavaError):  # bounds are missing: the counts still come from the footers
        found = footer_aggregate(spark, path).first().asDict()
        bounds = table.agg(*(F.min(c).alias(f"min_{c}") for c in ranges), *(F.max(c).alias(f"max_{c}") for c in ranges))
        found |= bounds.first().asDict()
    # Counts of no row group at all add up to NULL.
    found |= {c: 0 for c in found if found[c] is None and c.startswith(("rows", "filled_"))}
    below = [c for c in negatives if found[f"min_{c}"] is not None and not found[f"min_{c}"] >= 0]
    counted = table.agg(*(F.count_if(F.col(c) < 0).alias(c) for c in below)).first().asDict() if below else {}
    values = {"rows": found["rows"]}
    values |= {f"null_{c}": found["rows"] - found[f"filled_{c}"] for c in table.columns}
    # 0.0 is kept as -0.0 in a footer's minimum; adding zero takes the sign off.
    values |= {f"{side}_{c}": None if found[f"{side}_{c}"] is None else float(found[f"{side}_{c}"]) + 0.0 for side in ("min", "max") for c in ranges}
    values |= {f"negative_{c}": counted.get(c, 0) for c in negatives}
    kinds = [T.StructField(n, T.DoubleType() if n.startswith(("min_", "max_")) else T.LongType()) for n in values]
    return spark.createDataFrame([tuple(values.values())], T.StructType(kinds))


def quality_report(
    df: DataFrame, *, target_rows: int | None = None, label: str = "Churn", profile: DataFrame | None = None
) -> DataFrame:
    """Every check as rows of (check, column, value, ok). ``profile`` is a ``wide_profile`` taken before."""
    wide = wide_profile(df) if profile is None else profile

    def entry(check: str, column: str | Column, value: Column, ok: Column) -> list[Column]:
        return [
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),  # a Column passes through
            value.cast("double").alias("value"),
            ok.cast("boolean").alias("ok"),
        ]

    unchecked = F.lit(None)
    rows_ok = unchecked if target_rows is None else F.col("rows") == target_rows
    entries = [entry("row_count", "*", F.col("rows"), rows_ok)]
    entries += [entry("null_count", c, F.col(f"null_{c}"), F.col(f"null_{c}") == 0) for c in df.columns]
    for c in RANGE_COLUMNS:
        entries.append(entry("min", c, F.col(f"min_{c}"), unchecked))
        entries.append(entry("max", c, F.col(f"max_{c}"), unchecked))
    entries += [entry("negative_count", c, F.col(f"negative_{c}"), F.col(f"negative_{c}") == 0) for c in NON_NEGATIVE_COLUMNS]

    classes = class_distribution(df, label)
    named = F.concat_ws("=", F.lit(label), F.coalesce(F.col(label).cast("string"), F.lit("NULL")))
    per_class = [("class_count", "count"), ("class_pct", "pct")]
    shares = _long(classes.withColumn("_class", named), [entry(check, F.col("_class"), F.col(v), unchecked) for check, v in per_class])
    return _long(wide, entries).unionByName(shares)


def issue_rows(issues: DataFrame) -> DataFrame:
    """Schema issues in the shape of the quality report."""
    return issues.select(
        F.concat_ws("_", F.lit("schema"), "issue").alias("check"),
        "column",
        F.lit(1.0).alias("value"),
        F.lit(False).alias("ok"),
    )


def partition_rows(profile: DataFrame, check: str = "partition") -> DataFrame:
    """A one-row profile in the shape of the quality report."""
    named = [F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), F.lit(None).cast("boolean").alias("ok")) for c in profile.columns]
    return profile.select(F.inline(F.array(*named)))


def written_profile(stored: DataFrame) -> DataFrame:
    """Row, null, class and label-status counts of a feature store in one pass.

    ``null_labels`` counts rows that should have a label: those with the status used, or all where a table has no status.
    """
    status = F.col("label_status") if "label_status" in stored.columns else F.lit("used")
    return stored.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("features").isNull()).alias("null_features"),
        F.count_if((status == "used") & F.col("label").isNull()).alias("null_labels"),
        F.count_if(F.col("label") == 0).alias("label_0"),
        F.count_if(F.col("label") == 1).alias("label_1"),
        *(F.count_if(status == s).alias(s) for s in ("used", "missing", "quarantined")),
    )


def check_written(stored: DataFrame) -> DataFrame:
    """``written_profile``, failing when a vector or the label of a used row is missing."""
    profile = written_profile(stored)
    found = profile.first()
    if found["null_features"] or found["null_labels"]:
        raise ValueError(f"feature store has {found['null_features']} null vectors and {found['null_labels']} null labels")
    return stored.sparkSession.createDataFrame([found], profile.schema)


def check_row_count(df: DataFrame, target_rows: int) -> int:
    found = df.count()
    if found != target_rows:
        raise ValueError(f"expected {target_rows} rows, found {found}")
    return found
