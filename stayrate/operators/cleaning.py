"""Label resolution over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.columns import numeric_label


def resolve_label(df: DataFrame, *, strict: bool = False, drop_source: bool = True) -> DataFrame:
    """Add ``label`` as double, from ``label`` when the table has it and from ``Churn`` otherwise.

    ``strict`` fails on text that is neither a number nor Yes or No, instead of giving NULL.
    """
    if "label" in df.columns:
        source = "label"
    elif "Churn" in df.columns:
        source = "Churn"
    else:
        raise ValueError("the table needs a 'label' or a 'Churn' column")
    if isinstance(df.schema[source].dataType, T.NumericType):
        value = F.col(source).cast("double")
    else:
        value = numeric_label(F.col(source), strict=strict)
    labelled = df.withColumn("label", value)
    return labelled.drop("Churn") if drop_source else labelled


def usable_labels(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``label`` is 0 or 1, and the others, whose label is missing or means something else.

    Learning and measuring use the first; the second are put aside and counted, never taken for 0.
    """
    usable = F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False))
    return df.filter(usable), df.filter(~usable)


def label_report(df: DataFrame) -> DataFrame:
    """One row: rows used, rows without a label, rows whose label is not 0 or 1 (after ``resolve_label``)."""
    source = "label" if "label" in df.columns else "Churn"
    resolved = resolve_label(df.withColumn("_given", F.col(source).cast("string")))
    used = F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False))
    return resolved.agg(
        F.count_if(used).alias("used"),
        F.count_if(F.col("_given").isNull()).alias("missing"),
        F.count_if(~used & F.col("_given").isNotNull()).alias("quarantined"),
    )


def numeric_columns(df: DataFrame, *, exclude: tuple[str, ...] = ("label",)) -> list[str]:
    """Names of the numeric columns usable as features, in table order."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    if not names:
        raise ValueError("the table has no numeric feature column")
    return names
