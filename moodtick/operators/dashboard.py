"""Dashboard analytics over the stored metrics table, as lazy DataFrames.

The original fetched the newest 50 rows into pandas and computed KPIs for one
selected ticker. Here every KPI is computed for *all* tickers in one
``groupBy``; the selection is an ordinary filter. Order-dependent values
(latest, first) use ``max_by`` / ``min_by`` on ``window_start``, which are
algebraic aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.labels import correlation_label, sentiment5
from ..functions.stats import safe_corr

# Display precision of the dashboard figures.
PRICE_DIGITS = 2
SENTIMENT_DIGITS = 3
CORRELATION_DIGITS = 3
VOLUME_DIGITS = 1
# The correlation is shown only for more than this many rows; the delta only for more than one.
MIN_ROWS_FOR_CORRELATION = 2

RECENT_COLUMNS = ("window_start", "avg_price", "min_price", "max_price", "avg_sentiment", "headline_count")


def latest(metrics: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Newest ``cfg.latest_limit`` rows.

    scope='global': across all tickers (the original ``ORDER BY window_start
    DESC LIMIT 50``), ties broken by ticker; a partial top-k per task, then
    one merge of at most tasks × N rows.
    scope='per_ticker': N per ticker, via ``row_number() <= N`` which Spark
    plans as a partial WindowGroupLimit before the shuffle.
    """
    n = cfg.latest_limit
    if cfg.scope == "global":
        return metrics.orderBy(F.col("window_start").desc(), F.col("ticker").asc()).limit(n)
    if cfg.scope == "per_ticker":
        w = Window.partitionBy("ticker").orderBy(F.col("window_start").desc())
        return metrics.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    raise ValueError(f"unknown scope {cfg.scope!r}")


def distinct_tickers(frame: DataFrame) -> DataFrame:
    return frame.select("ticker").distinct()


def select_ticker(frame: DataFrame, ticker: str) -> DataFrame:
    return frame.where(F.col("ticker") == F.lit(ticker))


def series(frame: DataFrame) -> DataFrame:
    """The two chart series, time ascending."""
    return frame.select("ticker", "window_start", "avg_price", "avg_sentiment").orderBy("ticker", "window_start")


def kpis(frame: DataFrame) -> DataFrame:
    """Per ticker: latest/first price, delta, latest sentiment + label, window
    count, mean headline volume, correlation (> 2 rows) + label."""
    agg = frame.groupBy("ticker").agg(
        F.max_by("avg_price", "window_start").alias("latest_price"),
        F.min_by("avg_price", "window_start").alias("first_price"),
        F.max_by("avg_sentiment", "window_start").alias("latest_sentiment"),
        F.count(F.lit(1)).alias("total_windows"),
        F.avg("headline_count").alias("avg_volume"),
        safe_corr("avg_price", "avg_sentiment").alias("_corr"),
    )
    corr = F.when(F.col("total_windows") > MIN_ROWS_FOR_CORRELATION, F.col("_corr"))
    return agg.select(
        "ticker",
        "latest_price",
        "first_price",
        F.when(F.col("total_windows") > 1, F.col("latest_price") - F.col("first_price"))
        .otherwise(F.lit(0.0))
        .alias("price_delta"),
        "latest_sentiment",
        sentiment5("latest_sentiment").alias("sentiment_label"),
        "total_windows",
        "avg_volume",
        corr.alias("correlation"),
        F.when(F.col("total_windows") > MIN_ROWS_FOR_CORRELATION, correlation_label(corr)).alias(
            "correlation_label"
        ),
    )


def kpis_display(k: DataFrame) -> DataFrame:
    """KPIs rounded as the dashboard shows them."""
    return k.select(
        "ticker",
        F.round("latest_price", PRICE_DIGITS).alias("latest_price"),
        F.round("price_delta", PRICE_DIGITS).alias("price_delta"),
        F.round("latest_sentiment", SENTIMENT_DIGITS).alias("latest_sentiment"),
        "sentiment_label",
        "total_windows",
        F.round("avg_volume", VOLUME_DIGITS).alias("avg_volume"),
        F.round("correlation", CORRELATION_DIGITS).alias("correlation"),
        "correlation_label",
    )


def kpis_for(frame: DataFrame, ticker: str) -> DataFrame:
    """KPIs of one selected ticker; exactly one row, zeros when the selection
    is empty (a global aggregate always yields one row)."""
    sel = select_ticker(frame, ticker)
    a = sel.agg(
        F.max_by("avg_price", "window_start").alias("latest_price"),
        F.max_by("avg_sentiment", "window_start").alias("latest_sentiment"),
        F.min_by("avg_price", "window_start").alias("first_price"),
        F.count(F.lit(1)).alias("total_windows"),
        F.avg("headline_count").alias("avg_volume"),
    )
    return a.select(
        F.lit(ticker).alias("ticker"),
        F.coalesce("latest_price", F.lit(0.0)).alias("latest_price"),
        F.coalesce("latest_sentiment", F.lit(0.0)).alias("latest_sentiment"),
        F.when(F.col("total_windows") > 1, F.col("latest_price") - F.col("first_price"))
        .otherwise(F.lit(0.0))
        .alias("price_delta"),
        "total_windows",
        "avg_volume",
    )


def recent(frame: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Last ``cfg.recent_rows`` windows per ticker, 6 display columns (+ ticker)."""
    w = Window.partitionBy("ticker").orderBy(F.col("window_start").desc())
    return (
        frame.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= cfg.recent_rows)
        .select("ticker", *RECENT_COLUMNS)
    )


def overlay(frame: DataFrame) -> DataFrame:
    """Sentiment scaled into the ticker's price range:
    s * (max - min) / 2 + (max + min) / 2, with min/max of avg_price per ticker
    (a grouped aggregate joined back on ticker, not a whole-ticker window)."""
    rng = frame.groupBy("ticker").agg(F.min("avg_price").alias("_lo"), F.max("avg_price").alias("_hi"))
    return frame.join(rng, "ticker").select(
        "ticker",
        "window_start",
        "avg_price",
        "avg_sentiment",
        (F.col("_hi") - F.col("_lo")).alias("price_range"),
        (F.col("avg_sentiment") * (F.col("_hi") - F.col("_lo")) / 2 + (F.col("_hi") + F.col("_lo")) / 2).alias(
            "sentiment_scaled"
        ),
    )


def correlation(frame: DataFrame) -> DataFrame:
    """Per ticker: n, price/sentiment correlation (NULL for <= 2 rows or a constant series),
    label (NULL for <= 2 rows, as in ``kpis``)."""
    a = frame.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_windows"), safe_corr("avg_price", "avg_sentiment").alias("_c")
    )
    enough = F.col("n_windows") > MIN_ROWS_FOR_CORRELATION
    c = F.when(enough, F.col("_c"))
    label = F.when(enough, correlation_label(c))
    return a.select("ticker", "n_windows", c.alias("correlation"), label.alias("correlation_label"))
