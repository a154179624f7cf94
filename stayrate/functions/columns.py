"""Scalar expressions: cleaning, labels, derived features and score handling.

Spark's ANSI mode stays on. Mixed-type comparisons therefore go through strings and
casts of untrusted text through ``try_cast``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayrate.schemas import SERVICE_COLUMNS

# What counts as a set flag, compared as text.
TRUTHY = ("Yes", "1")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def coerce_number(c: Column) -> Column:
    """Text to double; blanks, NaN and anything that is not a number become 0.0."""
    text = F.trim(c.cast("string"))
    # Java's parser takes a type suffix ("1.5d"); a number in a CSV file does not have one.
    plain = F.when(~text.rlike("[0-9.][dDfF]$"), text)
    return F.coalesce(nan_to_null(plain.try_cast("double")), F.lit(0.0))


def yes_no_flag(c: Column) -> Column:
    """Yes -> 1, No -> 0, anything else -> NULL."""
    return F.when(c == "Yes", 1).when(c == "No", 0).cast("bigint")


def is_truthy(c: Column) -> Column:
    return c.cast("string").isin(*TRUTHY)


def binarize_label(c: Column) -> Column:
    """1.0 for a set flag, 0.0 for everything else including NULL."""
    return F.when(is_truthy(c), 1.0).otherwise(0.0)


def numeric_label(c: Column, *, strict: bool = False) -> Column:
    """Label as double, reading Yes/No as well as numbers.

    Text that is neither gives NULL, or fails the job when ``strict`` is set.
    """
    text = F.trim(c.cast("string"))
    value = F.coalesce(yes_no_flag(text).cast("double"), text.try_cast("double"))
    if not strict:
        return value
    unmapped = F.raise_error(F.format_string("label value %s is not a number, Yes or No", text)).cast("double")
    return F.when(value.isNull() & c.isNotNull(), unmapped).otherwise(value)


def label_status(given: Column, value: Column | None = None) -> Column:
    """used for 0 and 1 (or No and Yes), missing for NULL, quarantined for anything else.

    ``value`` is the label as a number where that is known already.
    """
    known = F.coalesce((numeric_label(given) if value is None else value).isin(0.0, 1.0), F.lit(False))
    return F.when(given.isNull(), "missing").when(known, "used").otherwise("quarantined")


def strict_label(given: Column, value: Column | None = None) -> Column:
    """0.0 or 1.0, and NULL for a label that is missing or means something else."""
    value = numeric_label(given) if value is None else value
    return F.when(value.isin(0.0, 1.0), value)


def tenure_bucket(c: Column) -> Column:
    """Life-cycle stage. NULL and negative months fall through to ``loyal``."""
    return F.when(c.between(0, 12), "new").when(c.between(13, 24), "growing").when(c.between(25, 48), "mature").otherwise("loyal")


def charge_ratio(monthly: Column, group_average: Column) -> Column:
    return F.round(monthly / (group_average + F.lit(1e-9)), 4)


def charge_per_month_raw(total: Column, tenure: Column) -> Column:
    """Lifetime charge per month of tenure; a first-month subscriber counts as one month."""
    return total / F.when(tenure == 0, 1).otherwise(tenure)


def charge_per_month(total: Column, tenure: Column) -> Column:
    return F.round(charge_per_month_raw(total, tenure), 2)


def complaint_proxy(tech_support: Column, online_security: Column) -> Column:
    return F.when((tech_support == "No") & (online_security == "No"), 1).otherwise(0)


def service_count(columns: list[str] = SERVICE_COLUMNS) -> Column:
    return reduce(add, [F.when(is_truthy(F.col(c)), 1).otherwise(0) for c in columns])


def clip_lower(c: Column, bound: float = 0.0) -> Column:
    """Raise values below ``bound`` to it and leave NULL alone."""
    return F.when(c < bound, F.lit(bound)).otherwise(c)


def round_half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("bigint")


def subscriber_id(row_id: Column, chunk_rows: int) -> Column:
    """CUST-<chunk>-<row in chunk>, zero padded."""
    chunk = F.call_function("div", row_id, F.lit(chunk_rows))
    return F.format_string("CUST-%04d-%06d", chunk, row_id % F.lit(chunk_rows))


def positive_probability(probability: Column) -> Column:
    """Probability of class 1 out of a classifier's probability vector."""
    return vector_to_array(probability)[1]


def at_threshold(score: Column, threshold: float) -> Column:
    """1 when the score reaches the threshold. A missing score never does."""
    return F.coalesce((nan_to_null(score) >= F.lit(float(threshold))).cast("int"), F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0.0 for an empty denominator."""
    return F.when(denominator == 0, 0.0).otherwise(numerator / F.nullif(denominator, F.lit(0)))
