"""Set helpers. Joins carry no broadcast hint: adaptive execution broadcasts a
side whose size it has seen, and falls back to a sort-merge join otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION``: set semantics, by column name."""
    return a.unionByName(b).distinct()
