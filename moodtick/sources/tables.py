"""Readers for the test tables and the views the pipeline runs on.

``ticks`` and ``headlines`` re-express the two event streams on the driver's
tables: ``events`` becomes price ticks (event_type as ticker, value as price),
``documents`` becomes headlines with a ticker and a minute-resolution event
time derived from ``doc_id``. Both are ordinary projections, so Catalyst prunes
columns down to the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import instant_from_utc
from ..operators.partitioning import spread

# Fixed values of the headline view: the five tickers and the minute spread.
TICKERS = ("click", "error", "purchase", "signup", "view")
HEADLINE_EPOCH = "2024-01-01 00:00:00"
HEADLINE_MINUTE_STEP = 43
HEADLINE_MINUTE_SPAN = 43200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; spread over the cores when it comes in fewer splits (the
    test files hold one row group each)."""
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, price, timestamp) from ``events``; ``ts`` (timestamp_ntz) read as UTC."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("value").alias("price"),
        instant_from_utc("ts").alias("timestamp"),
    )


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ticker, headline, source, timestamp) from ``documents``."""
    d = table(spark, sf_dir, "documents")
    minute = ((F.col("doc_id") * HEADLINE_MINUTE_STEP) % HEADLINE_MINUTE_SPAN).cast("int")
    return d.select(
        "doc_id",
        F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col("doc_id") % len(TICKERS) + 1).cast("int")).alias(
            "ticker"
        ),
        F.col("text").alias("headline"),
        "source",
        instant_from_utc(
            F.to_timestamp_ntz(F.lit(HEADLINE_EPOCH)) + F.make_dt_interval(F.lit(0), F.lit(0), minute, F.lit(0))
        ).alias("timestamp"),
    )
