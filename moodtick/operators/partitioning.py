"""Parallelism of the expensive per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cluster's cores when a batch input arrives in fewer
    splits than there are cores (a file with a single row group, a few
    unsplittable files), so the per-row work that follows is not done by a
    handful of tasks. A well-split input (the normal case at scale) and a
    stream are returned unchanged: no shuffle is added.

    Apply it to a source scan (the readers in ``sources`` do): counting the
    partitions of a plan that already contains a shuffle would run that
    shuffle."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
