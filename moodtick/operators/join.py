"""Inner equi-join of the two windowed aggregates.

The join key is ``ticker`` plus the **whole** window struct. Keeping the struct
(rather than its start/end fields) lets the stream-stream join see the
watermarked window column, so its state is evicted once windows close, and
lets the planner reuse the aggregates' hash partitioning (no extra exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import WINDOW_COL


def join_price_sentiment(prices: DataFrame, sentiment: DataFrame) -> DataFrame:
    p, s = prices.alias("p"), sentiment.alias("s")
    return p.join(
        s,
        (F.col("p.ticker") == F.col("s.ticker")) & (F.col(f"p.{WINDOW_COL}") == F.col(f"s.{WINDOW_COL}")),
        "inner",
    ).select(
        F.col("p.ticker").alias("ticker"),
        F.col(f"p.{WINDOW_COL}").alias(WINDOW_COL),
        F.col("p.avg_price").alias("avg_price"),
        F.col("p.min_price").alias("min_price"),
        F.col("p.max_price").alias("max_price"),
        F.col("p.price_count").alias("price_count"),
        F.col("s.avg_sentiment").alias("avg_sentiment"),
        F.col("s.headline_count").alias("headline_count"),
    )
