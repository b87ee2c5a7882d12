"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition, for a few unsplittable files that feed CPU-heavy
    per-row work such as JSON encoding or parsing. Inputs of more files than the
    cluster can run tasks at once (default parallelism) are returned unchanged;
    only the file listing is asked for, nothing runs."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    return df.repartition(target)
