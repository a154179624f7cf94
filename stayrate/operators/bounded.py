"""Joins of a table to one row for each group."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayrate.sources.storage import checkpointed


def fixed(groups: DataFrame) -> DataFrame:
    """``groups`` as a written table: computed once, and of a size in bytes that the planner knows."""
    return checkpointed(groups, "groups")


def join_grouped(facts: DataFrame, groups: DataFrame, key: str, *, how: str = "inner") -> DataFrame:
    """Join a fact table to a table with one row per ``key``, as it is and unsalted.

    The planner decides by the groups' bytes: a small written table is broadcast and the facts do not
    move; otherwise both sides shuffle on the key and adaptive execution splits the partitions of a
    hot key, which the groups' single row of that key joins as often as needed.
    """
    return facts.join(groups, key, how)
