"""Event-time tumbling-window aggregates per ticker (batch and stream alike).

Grouping key is ``(ticker, time_window)`` with ``time_window`` the struct
produced by ``window()``; epoch-aligned ``[start, end)``. All aggregates are
algebraic, so Spark combines map-side before the shuffle and a hot ticker costs
one partial row per map task and window, not a third of the data in one task.
``withWatermark`` bounds the state of a stream and is ignored in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.sentiment import scorer, user_scorer
from ..functions.text import clean_text

WINDOW_COL = "time_window"


def _windowed(df: DataFrame, cfg: Config, ts_col: str = "timestamp"):
    if df.isStreaming:
        df = df.withWatermark(ts_col, cfg.watermark_delay)
    return df.groupBy(F.col("ticker"), F.window(F.col(ts_col), cfg.window).alias(WINDOW_COL))


def price_window_metrics(ticks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """ticker, time_window, avg/min/max price, price_count (non-NULL prices)."""
    return _windowed(ticks, cfg).agg(
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("price").alias("price_count"),
    )


def clean_and_score(headlines: DataFrame, lexicon, cfg: Config = DEFAULT, score=None) -> DataFrame:
    """Adds cleaned_headline and sentiment_score (both per-row projections; the
    scoring form is chosen by lexicon size, see ``functions.sentiment``).

    ``score`` replaces the lexicon by a user's own scorer: a function from the column of
    lower-cased texts to a double column, built-in expressions or an (iterator) pandas UDF
    such as ``functions.sentiment.model_scorer`` returns. It sees NULL texts as the
    lexicon scorers do (``cfg.null_policy``).

    The score reads ``lower(headline)``: tokens are runs of a-z, so collapsing
    whitespace cannot change them and the score equals the score of the cleaned
    text; when only the score is used downstream, Catalyst drops the
    whitespace rewrite of every text."""
    if score is None:
        score = scorer(headlines.sparkSession, lexicon, cfg)
    else:
        score = user_scorer(score, cfg)
    return headlines.withColumn("cleaned_headline", clean_text("headline")).withColumn(
        "sentiment_score", score(F.lower(F.col("headline")))
    )


def sentiment_window_metrics(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """ticker, time_window, avg_sentiment, headline_count (non-NULL headlines)."""
    return _windowed(scored, cfg).agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count("headline").alias("headline_count"),
    )
