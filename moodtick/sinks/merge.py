"""Keyed upsert as DataFrame operations (no driver collect).

``dedup_batch`` keeps one row per key deterministically (the greatest row
over the non-key columns, an algebraic max with map-side partial
aggregation). ``merge_frames`` = target rows whose key is not in the batch ∪
the batch. Applying the same batch twice gives the same result (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import METRICS_KEY


def dedup_batch(batch: DataFrame, key: Sequence[str] = METRICS_KEY) -> DataFrame:
    others = [c for c in batch.columns if c not in key]
    if not others:
        return batch.dropDuplicates(list(key))
    picked = batch.groupBy(*key).agg(F.max(F.struct(*others)).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*batch.columns)


def merge_frames(
    target: DataFrame, batch: DataFrame, key: Sequence[str] = METRICS_KEY, deduped: bool = False
) -> DataFrame:
    b = batch if deduped else dedup_batch(batch, key)
    kept = target.join(b.select(*key), list(key), "left_anti")
    return kept.unionByName(b.select(*target.columns))
