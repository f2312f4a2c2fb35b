"""Schemas, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

# Price event {ticker, price, timestamp}; timestamp is an ISO-8601 string on the wire.
PRICE_EVENT = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Headline event {ticker, headline, source, timestamp}.
TEXT_EVENT = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Message envelope of a topic (same columns as Spark's Kafka source).
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Stored metrics table, key (ticker, window_start).
METRICS_KEY = ("ticker", "window_start")
METRICS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), False),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("price_count", T.IntegerType()),
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("headline_count", T.IntegerType()),
    ]
)
METRICS_COLUMNS = tuple(f.name for f in METRICS.fields)
TICKER_MAX_LEN = 10

# Lexicon table (token, valence) used by the scorer.
LEXICON = T.StructType(
    [
        T.StructField("token", T.StringType(), False),
        T.StructField("valence", T.DoubleType(), False),
    ]
)
