"""Repeatable pseudo-random columns.

Each value depends only on (purpose, seed, key), never on partitioning or task order, so a
retried task or a different cluster size gives the same rows. MD5 is used because any SQL
engine can reproduce it. The purpose keeps draws apart: a 10% sample and an 80% split of the
same keys must not be correlated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HASH_BITS = 60  # 15 hexadecimal digits


def _digest(purpose: str, seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{purpose}:{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def _hex_to_bigint(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def hash_bigint(purpose: str, seed: int, key: Column) -> Column:
    """Uniform integer in [0, 2**60)."""
    return _hex_to_bigint(_digest(purpose, seed, key), 1, 15)


def hash_fraction_below(purpose: str, seed: int, key: Column, fraction: float) -> Column:
    """True for about ``fraction`` of the keys."""
    return hash_bigint(purpose, seed, key) < F.lit(int(fraction * (1 << _HASH_BITS)))


def hash_normal(purpose: str, seed: int, key: Column) -> Column:
    """Standard normal value by the Box-Muller transform of two 52-bit uniforms."""
    digest = _digest(purpose, seed, key)
    radius, angle = (
        (_hex_to_bigint(digest, start, 13) + F.lit(0.5)) / F.lit(float(2**52)) for start in (1, 17)
    )
    return F.sqrt(F.lit(-2.0) * F.log(radius)) * F.cos(F.lit(2.0) * F.pi() * angle)
