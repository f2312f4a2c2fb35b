"""Row shaping for the stored metrics table and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import utc_wall_clock
from ..schemas import METRICS, METRICS_KEY, TICKER_MAX_LEN
from .windows import WINDOW_COL


def shape_metrics(joined: DataFrame, sentiment_default: float | None = 0.0) -> DataFrame:
    """Joined rows → the 9 stored columns.

    Window bounds become zone-less UTC timestamps (whatever the session zone), counts
    narrow to int (ANSI cast: overflow fails instead of wrapping), a NULL
    average sentiment is stored as ``sentiment_default``. A NULL price stays
    NULL (the column is nullable).
    """
    sent = F.col("avg_sentiment").cast("double")
    if sentiment_default is not None:
        sent = F.coalesce(sent, F.lit(float(sentiment_default)))
    return joined.select(
        F.col("ticker"),
        utc_wall_clock(F.col(f"{WINDOW_COL}.start")).alias("window_start"),
        utc_wall_clock(F.col(f"{WINDOW_COL}.end")).alias("window_end"),
        F.col("avg_price").cast("double").alias("avg_price"),
        F.col("min_price").cast("double").alias("min_price"),
        F.col("max_price").cast("double").alias("max_price"),
        F.col("price_count").cast("int").alias("price_count"),
        sent.alias("avg_sentiment"),
        F.col("headline_count").cast("int").alias("headline_count"),
    )


def key_violations(metrics: DataFrame) -> DataFrame:
    """One row per offending key: NULL key parts, over-long ticker, or a key
    that occurs more than once. Empty when the frame may be merged."""
    k1, k2 = METRICS_KEY
    return (
        metrics.groupBy(k1, k2)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max(F.col("window_end").isNull().cast("int")).alias("null_end"),
        )
        .where(
            (F.col("n_rows") > 1)
            | F.col(k1).isNull()
            | F.col(k2).isNull()
            | (F.length(k1) > TICKER_MAX_LEN)
            | (F.col("null_end") > 0)
        )
    )


def conform(metrics: DataFrame) -> DataFrame:
    """Select/cast to the declared METRICS schema column order."""
    return metrics.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METRICS.fields])
