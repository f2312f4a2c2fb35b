"""The correlation pipeline as one function of DataFrames.

parse → clean + score → window aggregates (both sides) → join → shape.
The same function serves a batch backfill and a streaming query: the inputs
decide (``DataFrame.isStreaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import DEFAULT, Config
from ..operators.join import join_price_sentiment
from ..operators.shape import shape_metrics
from ..operators.windows import clean_and_score, price_window_metrics, sentiment_window_metrics


def correlate(ticks: DataFrame, headlines: DataFrame, lexicon, cfg: Config = DEFAULT, score=None) -> DataFrame:
    """Joined windowed metrics, window still a struct (stream-safe form). ``score``: a user's
    scorer in place of the lexicon (see ``clean_and_score``)."""
    prices = price_window_metrics(ticks, cfg)
    sentiment = sentiment_window_metrics(clean_and_score(headlines, lexicon, cfg, score), cfg)
    return join_price_sentiment(prices, sentiment)


def metrics(ticks: DataFrame, headlines: DataFrame, lexicon, cfg: Config = DEFAULT, score=None) -> DataFrame:
    """The 9 stored columns (window flattened only here, after the join)."""
    return shape_metrics(correlate(ticks, headlines, lexicon, cfg, score))
